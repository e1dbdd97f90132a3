"""Hard negatives, the Merkle manifest and licence scans against brute force."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from plumbline.llm import hard_negatives, licences, merkle
from plumbline.llm.base import QUERIES, SQL, settle
from plumbline.llm.licence_texts import PHRASES, TEMPLATES


@pytest.fixture(scope="module")
def spark(spark):
    return settle(spark)


# ---------------------------------------------------------------- 11: hard negatives


def test_lookups_are_inner_products():
    rng = np.random.default_rng(3)
    for dim, size in ((1, 3), (8, 300), (13, 40_000), (64, 256), (70, 2**27)):
        anchors, rows = rng.integers(-size, size + 1, (300, dim)), rng.integers(-size, size + 1, (1_100, dim))
        rows[0], rows[1], anchors[0] = -size, size, -size
        bits = int(max(size, size - 1)).bit_length() + 1
        planes = hard_negatives.bit_planes(rows, bits)
        assert planes.shape == (1_100, bits, -(-dim // 8)) and planes.dtype == np.uint8
        found = np.concatenate([s for _, s in hard_negatives.scores(anchors, planes)])
        assert (found == anchors @ rows.T).all()


def brute_negatives(rows, anchors, least=50, most=95):
    out = []
    for aid, alabel, a in anchors:
        score = lambda r: sum(x * y for x, y in zip(a, r[2]))
        met = [r for r in rows if len(r[2]) == len(a)]
        near = sorted((-score(r), r[0]) for r in met if r[1] == alabel and r[0] != aid)[:5]
        for minus, pid in near:
            band = sorted((-score(r), r[0]) for r in met if r[1] != alabel and -least * minus <= 100 * score(r) <= -most * minus)
            out += [(aid, pid, i + 1, nid, -minus, -m) for i, (m, nid) in enumerate(band[:3])]
    return sorted(out)


def test_mining_is_brute_force_over_small_cells(spark):
    rng = random.Random(8)
    data = []
    for i in range(400):
        dim = 11 if i % 9 else 4
        data.append((i, [rng.choice([-0.5, -0.25, 0.0, 0.125, 0.3, 0.9]) + 0.4 for _ in range(dim)], rng.choice([1, 1, 1, 2, 3])))
    data += [(400, None, 1), (401, [0.5, None], 1), (402, [float("nan")] * 11, 1), (403, [float("inf")] * 11, 2), (404, [0.5] * 11, None), (None, [0.5] * 11, 1),
             (405, [], 1), (410, [0.9] * 7, 1), data[5], data[50], (60, [0.7] * 11, 2)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumn("score", F.lit("x")).withColumn("block", F.lit(1)).withColumn("q", F.lit(None))
    rows = hard_negatives.usable(frame, "vec_id", "embedding", "label")
    anchors = rows.where("vec_id % 10 = 0")
    got = sorted(map(tuple, hard_negatives.mine(rows, anchors, block_rows=37, chunk_rows=11).collect()))
    good = {(i, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v, label in data[:400] + data[406:] if i is not None and v is not None and label is not None}
    expected = brute_negatives(good, [r for r in good if r[0] % 10 == 0])
    assert got == expected and len(got) > 300
    assert hard_negatives.mine(rows.where("false"), anchors.where("false")).count() == 0


def test_components_too_large_for_a_long_are_refused(spark):
    frame = spark.createDataFrame([(0, [1e12] * 8, 1), (1, [1e12] * 8, 1)], "vec_id long, embedding array<double>, label int")
    rows = hard_negatives.usable(frame, "vec_id", "embedding", "label")
    with pytest.raises(ValueError):
        hard_negatives.mine(rows, rows)


# ---------------------------------------------------------------- 12: Merkle manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def brute_tree(nodes):
    """The root, and for every node its runs from bottom to top as (nodes of the run, place)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for i in range(len(paths)):
            paths[i].append((runs[at[i] // 8], at[i] % 8))
            at[i] //= 8
        nodes = [sha("".join(r)) for r in runs]
    return nodes[0], paths


def brute_manifest(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, kept = [], []
    for g in order:
        ordered = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
        top, paths = brute_tree([brute_leaf(r) for r in ordered])
        tops.append(top)
        kept.append(list(zip(ordered, paths)))
    root, above = brute_tree(tops)
    out = []
    for g, members in enumerate(kept):
        for row, path in members:
            path = path + above[g]
            proof = "".join("".join(run[:i] + run[i + 1 :]) for run, i in path)
            shown = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                shown = (*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))
            digest = brute_leaf(shown)
            for run, i in path:
                digest = sha("".join(run[:i]) + digest + "".join(run[i + 1 :]))
            out.append((row[0], brute_leaf(row), tops[g], root, sha(proof), digest, digest == root))
    return out


def odd_documents(n, langs):
    rng = random.Random(n)
    rows = [(i, rng.choice(["s", None, "ü"]), rng.choice(langs), rng.choice([3, None, 10**12]), rng.choice([None, "", "Ab c", "ÄÖ Z", "x" * 50])) for i in rng.sample(range(-9, 3 * n), n)]
    return rows + [rows[0], rows[0], (rows[-1][0], "other", rows[-1][2], 1, "Q"), (None, None, None, None, None), (None, "s", None, 1, "N")]


@pytest.mark.parametrize("n, langs", [(900, ["en"] * 8 + ["de", None, "é", "z"]), (200, [f"l{i}" for i in range(70)]), (1, ["en"])])
def test_manifest_is_brute_force(spark, monkeypatch, n, langs):
    # Small superblocks make several rounds of both trees.
    monkeypatch.setattr(merkle, "SPAN", 1)
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rows = odd_documents(n, langs)
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").withColumns({c: F.lit("clash") for c in ("grp", "pos", "root", "seq", "digest")})
    plain, shown = merkle.tampered_documents(frame)
    made = merkle.manifest(frame, "doc_id", "lang", plain, shown)
    got = made.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256), "folded_root", "verified").collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got), key=key) == sorted(brute_manifest(rows), key=key)


def test_manifest_of_no_rows_has_none(spark):
    frame = spark.createDataFrame([], "doc_id long, source string, lang string, n_chars long, text string")
    assert merkle.manifest(frame, "doc_id", "lang", *merkle.tampered_documents(frame)).count() == 0


def test_sql_of_the_manifest_is_brute_force():
    rows = odd_documents(700, ["en", "en", "en", "de", None])[:-2]
    ids = [r[0] for r in rows]
    rows = [r for r in rows if ids.count(r[0]) == 1]
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "source", "lang", "n_chars", "text"]).astype({"n_chars": "Int64"}))
    got = con.sql(SQL["op12_subtree_manifest"]).fetchall()
    assert sorted(got) == sorted(brute_manifest(rows))


# ---------------------------------------------------------------- 13: licence scans


def brute_matches(templates, words, least):
    runs = {}
    for t, x in enumerate(templates):
        for i in range(len(x)):
            for j in range(i + 1, len(x) + 1):
                runs.setdefault(tuple(x[i:j]), []).append((t, j))
    sizes = [max(k for k in range(e + 1) if not k or tuple(words[e - k : e]) in runs) for e in range(len(words) + 1)]
    last = len(words)
    return [(e, sizes[e], sorted(runs[tuple(words[e - sizes[e] : e])])) for e in range(1, last + 1) if sizes[e] >= least and (e == last or sizes[e + 1] <= sizes[e])]


def test_matching_statistics_are_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        templates = [[rng.choice([b"a", b"b", b"c"]) for _ in range(rng.randint(1, 9))] for _ in range(rng.randint(1, 5))]
        automaton = licences.Automaton(templates)
        words = [rng.choice([b"a", b"b", b"c", b"d"]) for _ in range(rng.randint(0, 40))]
        for least in (1, 3):
            got = [(e, n, automaton.ends[s]) for e, n, s in automaton.matches(list(map(automaton.ids.get, words)), least)]
            assert got == brute_matches(templates, words, least)


def test_places_are_brute_force(spark):
    rng = random.Random(5)
    pieces = ["MIT", "license", "License.", "apache", "general", "public", "mit-license", "É", "licenses", "\n", "GNU", "x" * 30, "the"]
    texts = [None, "", " . ", "MIT License", "MIT License" * 3, "general public license"] + [rng.choice([" ", ", ", "--"]).join(rng.choices(pieces, k=rng.randint(0, 60))) for _ in range(300)]
    texts.append("general public apache license " * 20_000)
    frame = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, places string, spans int")
    found = {r.doc_id: r for r in licences.scan(frame).collect()}
    for i, text in enumerate(texts):
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
        expected = sorted((k, label) for phrase, label in PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split())
        assert found[i].n_words == len(words)
        assert [(p.first, p.label) for p in found[i].places] == expected
    assert licences.scan(frame.where("false")).count() == 0


def test_spans_cover_templates_and_nothing_else(spark):
    rng = random.Random(6)
    prose = lambda n: " ".join(rng.choices(["the", "of", "software", "and", "license", "wend", "any", "to", "loam"], k=n))
    scanner = licences.Scanner(TEMPLATES, PHRASES)
    mit, bsd = TEMPLATES[3][1], next(t for label, t in TEMPLATES if label == "bsd-2-clause")
    spans = lambda text: scanner.spans(licences.words_of(text))
    for label, text in TEMPLATES:
        found, share = spans(f"{prose(30)}. xx {text} yy. {prose(30)}")
        n = len(licences.words_of(text))
        assert share == 1 and (label, 31, 31 + n, 1.0) in found, label
    # Words changed here and there leave a span; half a text does not, nor do its words in another order.
    words = mit.split()
    edited = " ".join(w if i % 25 else "changed" for i, w in enumerate(words))
    assert [s[0] for s in spans(f"{prose(20)} {edited} {prose(20)}")[0]] == ["mit"]
    assert 0.5 < spans(edited)[1] < 1
    assert spans(" ".join(words[: len(words) // 2]))[0] == []
    assert spans(" ".join(rng.sample(words, len(words))))[0] == []
    assert spans(prose(3_000)) == ([], 0.0) or spans(prose(3_000))[1] < 0.3
    assert [s[0] for s in spans("GNU General Public License, version 2 or so")[0]] == ["gpl-2.0"]
    assert spans("GNU General Public License, version 4")[0] == []
    # Texts apart are spans apart, in order.
    many = f" {prose(15)} ".join([mit, bsd, mit] * 40)
    assert [s[0] for s in spans(many)[0]] == ["mit", "bsd-2-clause", "mit"] * 40


@pytest.mark.parametrize("name", ["op11_lookup_negatives", "op12_subtree_manifest", "op13_licence_spans"])
def test_queries_read_whole_tables(spark, name):
    out = QUERIES[name](spark, "/root/testdata/sf0.001")
    assert out.count() > 0
    if name == "op13_licence_spans":
        docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
        assert out.count() == docs.count()
        assert out.where("n_base > 0 AND (score < 1 OR first_word > last_word OR base_labels = '')").count() == 0
        assert out.where("n_base = 0 AND (first_word IS NOT NULL OR base_labels <> '')").count() == 0
