"""Toxicity features, the assignment of packing, and shard sizes, each worked out a second and plainer way."""

import math
import random
import zlib

import pytest

from plumbline.llm import packing, sharding, toxicity  # noqa: F401
from plumbline.llm.base import QUERIES, settle


@pytest.fixture(scope="module")
def spark(spark):
    return settle(spark)


# ---------------------------------------------------------------- 5: toxicity

LETTERS = set("abcdefghijklmnopqrstuvwxyzäöüßéèñABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉ")
UPPER = set("ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉ")
SIGNS = dict(zip("0134578@$!|", "oieastbasil"))


def plain_features(text, words, stems):
    """Word by word and character by character, without patterns."""
    tokens = []
    for raw in text.lower().split():
        while raw and raw[0] in toxicity.EDGES:
            raw = raw[1:]
        while raw and raw[-1] in toxicity.EDGES:
            raw = raw[:-1]
        tokens.append(raw)
    n, chars = max(1, len(tokens)), max(1, len(text))
    hit = [t in words for t in tokens]
    begun = [any(t.startswith(s) for s in stems) for t in tokens]
    mixed = [any(t[i - 1] in LETTERS and t[i] in "0123456789@$!*|." and t[i + 1] in LETTERS for i in range(1, len(t) - 1)) for t in tokens]
    undone = 0
    for t, m in zip(tokens, mixed):
        clear = "".join(SIGNS.get(c, c) for c in t)
        undone += m and (clear in words or "".join(c for c in clear if c.isalpha()) in words)
    spoken = [t in toxicity.SECOND_PERSON for t in tokens]
    near = sum((hit[i] or begun[i]) and any(spoken[max(0, i - 5) : i + 6]) for i in range(len(tokens)))
    shouted = run = 0
    for k, c in enumerate(text + " "):
        if c in UPPER:
            run += 1
            continue
        whole = run >= 3 and not (c.isalnum() or c == "_") and (k - run == 0 or not (text[k - run - 1].isalnum() or text[k - run - 1] == "_"))
        shouted += whole
        run = 0
    stretched = i = 0
    while i < len(text):
        if text[i] in LETTERS and text[i : i + 4] == text[i] * 4:
            stretched += 1
            i += 4
        else:
            i += 1
    return [
        sum(hit) / n, math.log(1 + sum(hit)), sum(begun) / n, undone / n, sum(spoken) / n, near / n, sum(c in UPPER for c in text) / chars,
        shouted / n, text.count("!") / n, sum(c in ".,;:!?" for c in text) / n, sum(mixed) / n, stretched / n]


def test_features_are_worked_out_word_by_word(spark):
    rng = random.Random(4)
    pieces = ["you", "Your", "vous", "d0lt", "DOLT", "dolt!", "d*o*l*t", "(dolt)", "doltish", "f001", "fool,", "NO", "NOOOOO", "soooo", "a.b", "x1", "Ä", "ÄÖÜ", "plain", "\n", "--", "...", "ABCx", "word"]
    texts = ["", None, "!", "you " * 500, "dolt " * 2_000] + [" ".join(rng.choices(pieces, k=rng.randint(1, 40))) for _ in range(400)]
    lexicon = ["dolt", "fool", "doltis*", "foo*", "nooo*"]
    words, stems = {"dolt", "fool"}, ["doltis", "foo", "nooo"]
    # Beginnings have four to six letters.
    lexicon, stems = [e for e in lexicon if e != "foo*"], [s for s in stems if s != "foo"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    for r in rows.select("i", toxicity.features("text", lexicon).alias("v")).collect():
        assert r.v == pytest.approx(plain_features(texts[r.i] or "", words, stems), abs=1e-12), texts[r.i]


def test_scores_are_isotonic_in_the_margin(spark):
    """Pooled adjacent violators over the calibration part, worked out here, give the scores."""
    from pyspark.ml.regression import IsotonicRegression

    rng = random.Random(7)
    points = sorted((round(rng.uniform(-2, 2), 3), float(rng.random() < 0.5)) for _ in range(300))
    frame = spark.createDataFrame([(m, y) for m, y in points], "m double, label double")
    model = IsotonicRegression(featuresCol="m", labelCol="label", predictionCol="p").fit(frame)
    got = {r.m: r.p for r in model.transform(frame).collect()}
    merged = {}
    for m, y in points:
        s, n = merged.get(m, (0.0, 0))
        merged[m] = (s + y, n + 1)
    blocks = []
    for m in sorted(merged):
        blocks.append([merged[m][0], merged[m][1], [m]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            s, n, ms = blocks.pop()
            blocks[-1] = [blocks[-1][0] + s, blocks[-1][1] + n, blocks[-1][2] + ms]
    want = {m: s / n for s, n, ms in blocks for m in ms}
    assert got == pytest.approx(want, abs=1e-9)


# ---------------------------------------------------------------- 10: packing

def plain_assign(lengths, rooms, linear, quadratic):
    state = [[0.0, room] for room in rooms]
    out = [[] for _ in rooms]
    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        start = 0
        while start < lengths[doc]:
            left = lengths[doc] - start
            open_ones = [k for k, (_, room) in enumerate(state) if room >= left] or [k for k, (_, room) in enumerate(state) if room]
            k = min(open_ones, key=lambda k: (state[k][0], k))
            taken = min(left, state[k][1])
            out[k].append((doc, start, taken, rooms[k] - state[k][1]))
            state[k] = [state[k][0] + linear * taken + quadratic * taken**2, state[k][1] - taken]
            start += taken
    return out


def test_assignment_is_the_plain_loop():
    rng = random.Random(3)
    for _ in range(60):
        rooms = [64] * rng.randint(1, 12) + [1 << b for b in range(6) if rng.random() < 0.5]
        left, lengths = sum(rooms), []
        while left:
            lengths.append(min(left, rng.choice([1, 2, 3, 10, 40, 63])))
            left -= lengths[-1]
        for weights in ((1.0, 1 / 64), (0.0, 1.0), (1.0, 0.0)):
            assert packing.assign(lengths, rooms, *weights) == plain_assign(lengths, rooms, *weights)


def test_pieces_tile_each_document(spark):
    rng = random.Random(9)
    texts = [None, "", "a"] + [" ".join(rng.choices(["one", "two", "antidisestablishment", "é"], k=rng.choice([3, 50, 900, 3_000]))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    pieces = {}
    for r in packing.pack(docs, packing.public_path("byte_bpe_50k.json"), pool_tokens=4_096).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    assert set(pieces) == set(range(len(texts)))
    for own in pieces.values():
        at = 0
        for start, length, tokens in sorted(own):
            assert start == at and length > 0
            at += length
        assert {at} == {tokens for _, _, tokens in own}


# ---------------------------------------------------------------- 4: shards

def test_sizes_and_checksums_are_the_library_s(spark, tmp_path):
    texts = [None, "", "a", "é", "日本", "x" * 100_000, "a\x00b"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r["size"], r.text_crc32) for r in QUERIES["op4_feistel_shards"](spark, str(tmp_path)).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        assert got[i] == (len(raw) + 1, zlib.crc32(raw))
