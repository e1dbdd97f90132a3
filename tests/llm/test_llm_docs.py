"""Quality rules, toxicity, near-copies, neighbours, pages, chats and the pipeline against brute force."""

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from plumbline.llm import chats, html_text, near_copies, neighbours, quality, toxicity
from plumbline.llm.base import settle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")
WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def spark(spark):
    return settle(spark)


# ---------------------------------------------------------------- 2: quality rules

ODD = [None, "", "  \n ", "a", "x y z x y z", "a b c a b c a b c d", "one\ntwo\none\n\n \none", "#tag $5 <b> 50% a|b&c*", "é ü\x0b日本 語\x1f", "same words " * 40, "w " * 3_000]


def base_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_base_measures_are_brute_force(spark):
    rng = random.Random(1)
    texts = ODD + ["\n".join(" ".join(rng.choices("abcd", k=rng.randint(0, 9))) for _ in range(rng.randint(1, 6))) for _ in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string").select("i", quality.base_measures(F.coalesce("text", F.lit(""))).alias("b"))
    for r in rows.collect():
        assert tuple(r.b) == base_of(texts[r.i])


def test_scores_are_the_mean_ratio_of_hashed_grams(spark):
    import xxhash

    rng = random.Random(4)
    texts = [prose(rng, 60) for _ in range(30)] + [" | ".join(rng.choices(WORDS, k=60)) for _ in range(10)] + [None, "", "é ŵ!"]
    docs = spark.createDataFrame([(i, t, "x", 7.5) for i, t in enumerate(texts)] + [(None, "w1 w2", "x", 7.5)], "doc_id bigint, text string, key string, score double")
    labels = spark.createDataFrame([(i, 1 if i < 20 else 0) for i in range(0, 40, 2)] + [(None, 1), (3, None), (0, 1)], "doc_id bigint, quality int")
    buckets, prior = 64, 10.0

    def h(*words):
        seed = 42
        for w in words:
            seed = xxhash.xxh64_intdigest(w.encode(), seed=seed)
        return (seed - 2**64 if seed >= 2**63 else seed) % buckets

    def grams(text):
        t = re.findall(r"[^\W_]+|(?:[^\w\s]|_)+", (text or "").lower())
        return [h(x) for x in t] + [h(x, y) for x, y in zip(t, t[1:])]

    corpus, target = Counter(), Counter()
    for i, t in [*enumerate(texts), (None, "w1 w2")]:
        corpus.update(grams(t))
        if i in range(0, 20, 2):
            target.update(grams(t))
    n, m = sum(corpus.values()), sum(target.values())
    ratio = {b: math.log((target[b] + prior * c / n) / ((m + prior) * c / n)) for b, c in corpus.items()}
    got = quality.rate(docs, labels, buckets, prior, threshold=-0.1).collect()
    assert len(got) == len(texts) + 1 and got[0].score == 7.5
    for r in got:
        g = grams(r.text)
        want = sum(ratio[b] for b in g) / len(g) if g else 0.0
        q = r.quality_rules
        assert q.score == pytest.approx(want, abs=1e-9)
        assert q.base_failed == (q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words)
        assert q.kept == (not q.base_failed and q.score >= -0.1)
    assert quality.rate(docs.limit(0), labels).count() == 0
    assert quality.rate(docs, labels.limit(0)).where("abs(quality_rules.score) > 1e-9").count() == 0


def test_every_trusted_document_counts_in_the_target(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), (F.col("id") % 7).cast("string")).alias("text"))
    model = quality.fit(docs, docs.select("doc_id", F.lit(1).alias("quality")))
    # All documents are trusted, so the target is the corpus.
    assert all(abs(r.ratio) < 1e-12 for r in model.collect())


# ---------------------------------------------------------------- 5: toxicity

def test_held_out_toxicity(spark):
    rng = random.Random(8)
    bad = ["grobian", "grobiane", "lumpx", "lumpy"]

    def text(toxic):
        words = rng.choices(WORDS, k=rng.randint(20, 80))
        for _ in range(rng.randint(2, 6) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        return " ".join(words)

    rows = [(i, text(i % 4 == 0), i, "x") for i in range(900)] + [(None, None, 0, "x"), (900, "", 1, "x"), (0, text(True), 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, prediction int, features string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(900)] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    got = toxicity.score(docs, labels).collect()
    assert len(got) == len(rows)
    for part in (True, False):
        own = [r for r in got if r.toxicity.held_out == part and r.doc_id is not None and 0 < r.doc_id < 900]
        assert len(own) > 200
        assert sum(r.toxicity.predicted == (r.doc_id % 4 == 0) for r in own) / len(own) > 0.97
    assert all(0 <= r.toxicity.score <= 1 and r.toxicity.predicted == (r.toxicity.score >= 0.7) for r in got)
    shuffled = {(r.doc_id, r.text): r.toxicity.score for r in toxicity.score(docs.repartition(5), labels).collect()}
    assert shuffled == {(r.doc_id, r.text): r.toxicity.score for r in got}
    one_kind = toxicity.score(docs, labels.where("toxic = 1")).select("toxicity.score").distinct().collect()
    assert [r.score for r in one_kind] == [1.0]
    assert [r.score for r in toxicity.score(docs, labels.limit(0)).select("toxicity.score").distinct().collect()] == [0.0]
    assert toxicity.score(docs.limit(0), labels).count() == 0


def test_features_see_disguises_and_second_persons():
    words, stems = frozenset(["grobian"]), frozenset(["lump"])
    f = dict(zip(toxicity.FEATURES, toxicity.measure("You GR0BIAN! gr.o.bian lumpy grobian, aaaaah", words, stems)))
    assert f["lexicon"] == pytest.approx(1 / 6) and f["undone"] >= 1 / 6 and f["beginnings"] == pytest.approx(1 / 6)
    assert f["second_person"] == pytest.approx(1 / 6) and f["near_second_person"] == pytest.approx(2 / 6) and f["exclaimed"] > 0 and f["stretched"] > 0
    assert all(x == 0 for x in toxicity.measure("", words, stems))


# ---------------------------------------------------------------- 7: near-copies

def shingles(text, size):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def components(sets, percent):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(sets))]


@pytest.mark.parametrize(("size", "percent", "node", "depth"), [(3, 85, 512, 6), (3, 85, 8, 2), (5, 80, 6, 3), (3, 85, 4, 1)])
def test_components_are_brute_force(spark, size, percent, node, depth):
    rng = random.Random(node)
    texts = [None, "", " \n", "one", "ONE", "two words", "Two  words", "a b c", "a b c"]
    for _ in range(12):
        base = prose(rng, rng.randint(30, 90)).split()
        for _ in range(rng.choice([1, 2, 5, 30])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    rows = [(3 * i + 1, t, i, 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, key int, comp int")
    sets = [shingles(t, size) for t in texts]
    found = components(sets, percent)
    least = {}
    for i, root in enumerate(found):
        least[root] = min(least.get(root, i), i)
    got = {r.doc_id: r for r in near_copies.near_copies(docs, size, percent, node, depth).collect()}
    assert len(got) == len(rows)
    for i, root in enumerate(found):
        r = got[3 * i + 1]
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[i]), 3 * least[root] + 1, least[root] == i)


def test_near_copies_without_ids_and_of_repeated_rows(spark):
    long = " ".join(WORDS * 30)
    rows = [(None, "a b c d e"), (None, "A b c d e"), (7, "a b c d e"), (None, "x y z"), (None, "x y  z"), (9, long), (9, long), (8, long + " end"), (None, None), (4, None)]
    got = near_copies.near_copies(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), str(r.component_id), r.kept) for r in got) == sorted([
        ("None", "7", False), ("None", "7", False), ("7", "7", True), ("None", "None", True), ("None", "None", True),
        ("9", "8", False), ("9", "8", False), ("8", "8", True), ("None", "None", True), ("4", "4", True)])
    assert near_copies.near_copies(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_trees_follow_from_the_recall():
    assert near_copies.trees_for(0.85, 0.9999) == 3 and near_copies.trees_for(0.8, 0.9999) == 4 and near_copies.trees_for(1.0, 0.99) == 1


@pytest.mark.parametrize("percent", [80, 85, 95, 100])
def test_a_pair_at_the_threshold_is_found_and_kept_with_the_recall(percent):
    join, s = near_copies._Join(3, percent, 512, 6, 0.9999), percent / 100
    at = lambda n, m: math.comb(n, m) * s**m * (1 - s) ** (n - m)
    lost = sum(at(64, m) for m in range(join.least)) + sum(at(256, m) for m in range(join.least_fine))
    for m in range(join.least, 65):
        lost += at(64, m) * (1 - max(0, 2 * m / 64 - 1) / (m / 64) ** 2) ** join.trees
    assert lost <= 1e-4


# ---------------------------------------------------------------- 3: neighbours

def brute(ids, vectors, k):
    out = {}
    for i in range(len(ids)):
        if ids[i] % 20 == 0:
            scores = np.einsum("ij,j->i", vectors, vectors[i])
            order = [j for j in np.lexsort((ids, -scores)) if ids[j] != ids[i]][:k]
            out[int(ids[i])] = [(int(ids[j]), scores[j]) for j in order]
    return out


def test_neighbours_recall_ties_and_scores(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((1_500, 24)) * rng.uniform(0.2, 3, (1_500, 1))
    vectors[200:500] = vectors[200]
    ids = np.arange(1_500)
    rows = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(ids, vectors)], "vec_id bigint, vector array<double>, dim int")
    usable = neighbours.usable(rows, "vec_id", "vector")
    want = brute(ids, vectors, 20)
    for rows, chunk in ((8_192, 512), (150, 512), (40, 7)):
        got = neighbours.nearest(usable.where("vec_id % 20 = 0"), usable, 20, range_rows=rows, query_rows=chunk).collect()
        found = {}
        for r in sorted(got, key=lambda r: r["rank"]):
            found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert set(found) == set(want) and all(len(f) == 20 for f in found.values())
        hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
        assert hits >= 0.9 * 20 * len(want)
        # Three hundred equal vectors: all but the query itself tie, and the smallest ids are the nearest.
        for q in (200, 220, 480):
            assert [i for i, _ in found[q]] == [i for i in range(200, 500) if i != q][:20]
        assert all(s == pytest.approx(float(vectors[i] @ vectors[q]), abs=1e-9) for q in found for i, s in found[q])


def test_the_wanted_probability_finds_nearly_all(spark):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((300, 32))[rng.integers(0, 300, 3_000)] + 0.5 * rng.standard_normal((3_000, 32))
    ids = np.arange(3_000)
    want = brute(ids, vectors, 20)
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors)], "vec_id bigint, vector array<double>")
    found = {}
    for r in neighbours.nearest(rows.where("vec_id % 20 = 0"), rows, 20, range_rows=100).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len({i for i, _ in want[q]} & found[q]) for q in want)
    assert hits >= 0.95 * 20 * len(want)


def test_a_range_descends_and_ascends_by_prefix():
    rng = np.random.default_rng(5)
    codes = np.sort(rng.integers(0, 2**neighbours.BITS, 500) >> rng.integers(0, 60, 500))
    part = neighbours.Range(codes[::-1].copy(), np.arange(500)[::-1].copy(), np.zeros((500, 2)))
    bits = lambda c, n: f"{int(c):063b}"[:n]
    for code in [int(c) for c in codes[:50]] + [0, 2**neighbours.BITS - 1, 12345, 2**40 + 9]:
        longest = max(n for n in range(64) if any(bits(c, n) == bits(code, n) for c in codes))
        assert part.descend(code) == longest
        for level in {0, 1, longest // 2, longest}:
            low, high = part.sharing(code, level)
            assert sorted(part.ids[low:high].tolist()) == [i for i, c in enumerate(codes) if bits(c, level) == bits(code, level)]


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [1.0, None]), (100, [inf, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.5, 0.0]), (3, [2.0]), (None, [1.0, 1.0]), (120, [])]
    usable = neighbours.usable(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"), "vec_id", "embedding")
    got = neighbours.nearest(usable.where("vec_id % 20 = 0"), usable, 20).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(0, 1, 1, 1.0), (0, 2, 2, 0.5)]
    assert neighbours.nearest(usable.limit(0), usable, 20).count() == 0 and neighbours.nearest(usable, usable.limit(0), 20).count() == 0


# ---------------------------------------------------------------- 9: pages

def test_blocks_references_and_roles():
    page = html_text.Page(
        "<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var a='</p><p>no';</script></head><body><header>Top</header>"
        "<nav><ul><li><a href='/'>Home</a></ul></nav><div class='ad box'>Buy</div><main><h1>Big &lt;news&gt;</h1><p><b>First\n line<br>goes <i>o</i>n<p>Second&nbsp;&eacute; &#x41;"
        "<form><input value='x'>Sign</form><aside>Side</aside><section id='comments'><p>Nice!</p></section><table><tr><td>1<td>2</table><!-- <p>gone</p> --></main><footer>Foot</footer>")
    assert page.text(frozenset(), hash).split("\n") == ["Big <news>", "First line goes on", "Second é A", "1", "2"]
    assert html_text.Page("").text(frozenset(), hash) == "" and html_text.Page("plain <3 text").text(frozenset(), hash) == "plain <3 text"
    assert html_text.Page("<p>open <script>never closed").text(frozenset(), hash) == "open"
    assert html_text.Page("</div></p>a<p>b</div>c").text(frozenset(), hash).split("\n") == ["a", "b", "c"]


@pytest.mark.parametrize(("source", "want"), [
    ("<body><video src=x/><canvas/><article><p>one</p></article></body>", ["one"]),
    ("<article><p>one</p><div><button>Share</div><p>two</p><video src='x'><p>three</p></article>", ["one", "two", "three"]),
    ("<main><p>one <button>Share<p>two</p><button>Like</button> three</main>", ["one", "two", "three"]),
    ("<main><p>a<svg><title/><path/></svg>b <select><option>x<option>y</select>c</p><noscript><p>none</p></noscript><object><div>none</div></object><p>d</p></main>", ["a b c", "d"]),
    ("<p><canvas></p><p>far</p></canvas><p>below</p>", ["far", "below"]),
    ("<main><p>let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation encoding='t'>x=2</annotation></math></p></main>", ["let x=2"]),
    ("<body><form id=aspnet><nav>Home</nav><article><p>one</p><form>Sign</form></article></form></body>", ["one"]),
    ("<body><form><div><p>one</p><p>two</p></div></form><footer>Foot</footer></body>", ["one", "two"]),
    ("<head><title>T</title><body><p>one</p>", ["one"]),
])
def test_no_tag_swallows_the_article(source, want):
    assert html_text.Page(source).text(frozenset(), hash).split("\n") == want


def test_a_site_s_repeated_branches_go(spark):
    rng = random.Random(6)
    page = lambda i, host: (i, f"http://{host}/{i}", f"<body><div class='top'>Welcome to {host}</div><div class='story s{i}'><p>{prose(rng, 30)}</p><p>{prose(rng, 20)}</p></div><div class='end'>All rights</div></body>")
    pages = [page(i, "Big.example") for i in range(40)] + [page(100 + i, "small.example") for i in range(3)] + [(200, None, None), (201, "", ""), (202, "http://big.example/x", None), (0, *page(0, "Big.example")[1:])]
    df = spark.createDataFrame([(*p, 1, "z") for p in pages], "page_id bigint, url string, html string, host int, low string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    assert html_text.extract(df).count() == len(pages)
    assert all(len(got[i].split("\n")) == 2 and "Welcome" not in got[i] and "rights" not in got[i] for i in range(1, 40))
    assert all(len(got[100 + i].split("\n")) == 4 for i in range(3))  # too few pages to tell
    assert got[200] == got[201] == got[202] == ""
    assert html_text.extract(df.limit(0)).count() == 0


def test_branches_on_few_pages_of_a_large_site_go(spark):
    rng = random.Random(8)
    notice = "<div class='x'><p>The same unnamed words</p></div>"
    pages = [(i, f"http://large.example/{i}", f"<body>{notice if i < 9 else ''}<div class='story'><p>{prose(rng, 12)}</p></div></body>") for i in range(1_000)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert len(got) == 1_000 and not any("unnamed" in t for t in got.values()) and all(len(t.split()) == 12 for t in got.values())


# ---------------------------------------------------------------- 6: chats

def test_snapshots_collapse_into_maximal_conversations(spark):
    rng = random.Random(7)
    logs = {}
    for c in range(60):
        n = rng.randint(1, 6)
        logs[c] = [(rng.choice(["user", "assistant"]), rng.choice(["a", "b"])) for _ in range(n)]
    logs[100] = [("user", None), (None, "a")]
    logs[101] = [("user", None)]
    rows = [(c, t, r, x, 0) for c, turns in logs.items() for t, (r, x) in enumerate(turns)] + [(None, 0, "user", "a", 0), (100, 0, "user", None, 0), (102, None, "user", "q", 0)]
    logs[102] = [("user", "q")]
    got = chats.render(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, place int")).collect()
    want = {c for c, turns in logs.items() if not any(o != c and turns == other[: len(turns)] and (len(other) > len(turns) or o < c) for o, other in logs.items())}
    assert {r.conv_id for r in got} == want
    for c in want:
        end = 0
        for r, (role, text) in zip(sorted((r for r in got if r.conv_id == c), key=lambda r: r.place), logs[c], strict=True):
            assert (r.start, r.rendered, r.n_turns) == (end, f"<|im_start|>{role or ''}\n{text or ''}<|im_end|>\n", len(logs[c]))
            end += len(r.rendered)
    assert chats.render(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


# ---------------------------------------------------------------- the pipeline

def test_stages_take_effect(spark):
    rng = random.Random(12)
    good = [prose(rng, 80) for _ in range(120)]
    toxic = [prose(rng, 60) + " grobian lumpx " + prose(rng, 10) + " grobian" for _ in range(60)]
    junk = [" | ".join(rng.choices(WORDS, k=80)) for _ in range(60)] + ["short text", None, ""]
    texts = good + toxic + junk + good[:5] + [good[0] + " w1"]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    label = [(i, int(not 180 <= i < 240), int(120 <= i < 180)) for i in range(240)]
    spark.createDataFrame(label, "doc_id bigint, quality int, toxic int").write.mode("overwrite").parquet(folder := f"{spark.sparkContext.getCheckpointDir()}/pipe/labels.parquet")
    sf_dir = folder.rpartition("/")[0]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "near_dedup", "packing"]
    kept = corpus_pipeline.quality_rules(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & set(range(180, 243)) and ids >= {*range(120), *range(243, 248)}
    calm = corpus_pipeline.toxicity(spark, kept, sf_dir)
    ids = {r.doc_id for r in calm.collect()}
    assert calm.columns == docs.columns and not ids & set(range(120, 180)) and ids == {*range(120), *range(243, 249)}
    lone = corpus_pipeline.near_dedup(spark, calm, sf_dir)
    assert lone.columns == docs.columns and sorted(r.doc_id for r in lone.collect()) == list(range(120))
    packed = corpus_pipeline.packing(spark, lone, sf_dir)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(range(120))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_near_dedup_stage_keeps_one_row_of_each_group(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "A b c d e f"), (2, "q r s t u"), (2, "other words stand here now"), (None, None), (None, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = corpus_pipeline.near_dedup(spark, docs, "").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [(5, "a b c d e f"), (2, "q r s t u"), (2, "other words stand here now"), (None, None), (3, "")]))


@needs_data
def test_the_pipeline_query_runs_all_stages(spark):
    pieces = entry.queries()["pipeline"](spark, SF_DIR)
    assert pieces.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and pieces.count() > 0


def test_the_rest_does_without_this_package():
    source = open(os.path.join(os.path.dirname(entry.__file__), "__spark_entry__.py")).read()
    assert "except ImportError" in source
    root = os.path.join(os.path.dirname(entry.__file__), "plumbline")
    for top, _, names in os.walk(root):
        for name in names:
            if name.endswith(".py") and os.path.basename(top) != "llm":
                assert "plumbline.llm" not in open(os.path.join(top, name)).read()


CLASHING = ["quality_rules", "toxicity", "_row", "_copy", "_ratios", "_base", "_score", "_tox_features", "_tox_class", "_tox_raw", "_tox_share", "_tox_margin", "_tox_score", "Row", "component_id", "values", "key", "label"]


@needs_data
def test_stages_return_any_columns_as_they_came(spark):
    plain = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    docs = plain.select("*", *[F.concat(F.lit(f"{c}-"), "doc_id").alias(c) for c in CLASHING])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF_DIR)
        assert got.columns == docs.columns
        assert {r.doc_id for r in got.collect()} == {r.doc_id for r in stage(spark, plain, SF_DIR).collect()}, name
        assert all(r[c] == f"{c}-{r.doc_id}" for r in got.collect() for c in CLASHING)


def test_columns_of_the_quality_query(spark):
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert entry.queries()["op2_ngram_ratio_rules"](spark, SF_DIR).columns[:8] == names


def test_near_copies_far_from_every_pivot(spark):
    """A passage in all texts; most add much of their own, a few add little, and only these are copies of each other.

    The few agree on values of the passage alone, which all have, and are far from the pivots, which are most likely of the others.
    """
    passage = " ".join(f"p{i}" for i in range(852))
    own = lambda n, size: " ".join(f"w{n}x{i}" for i in range(size))
    rows = [(n, f"{passage} {own(n, 48 if n % 20 == 7 else 200)}") for n in range(300)]
    got = near_copies.near_copies(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), node=8).collect()
    assert {r.doc_id: r.component_id for r in got} == {n: 7 if n % 20 == 7 else n for n, _ in rows}


def test_edits_of_one_text_that_no_pivot_is_linked_with_are_not_compared_whole(spark, monkeypatch):
    """Texts with words of one base changed here and there, most too far from each other; what is compared grows as they do."""
    rng, rows, compared = random.Random(5), [], []
    base = [f"b{i}" for i in range(150)]
    for n in range(600):
        own = list(base) if n % 3 or not n else rows[n - 1][1].split()
        for _ in range(11 if n % 3 or not n else 2):
            own[rng.randrange(150)] = f"x{rng.random()}"
        rows.append((n, " ".join(own)))
    judged = near_copies._Join.candidates

    def candidates(self, groups, grams):
        compared[-1] += groups.count()
        return judged(self, groups, grams)

    monkeypatch.setattr(near_copies._Join, "candidates", candidates)
    for size in (300, 600):
        compared.append(0)
        docs = spark.createDataFrame(rows[:size], "doc_id bigint, text string").repartition(4)
        got = {r.doc_id: r.component_id for r in near_copies.near_copies(docs, node=16).collect()}
        found, least = components([shingles(t, 3) for _, t in rows[:size]], 85), {}
        for i, root in enumerate(found):
            least.setdefault(root, i)
        assert got == {i: least[root] for i, root in enumerate(found)}
    assert compared[1] < 3 * compared[0] and compared[1] < 40 * 600, compared
