"""Segmentation, token counts, packing and shards: round trips, the libraries, and invariants."""

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm import packing, pieces, sharding, token_counts
from plumbline.llm.base import settle
from plumbline.llm.vocab import encoder, public_path

ODD = [
    None, "", " ", "\n", "  two  spaces ", "a\n\nb\t c", "naïve Å b́ ΑΣ ς İ", "<|endoftext|>", "x <|endoftext|> y<|startoftext|>z",
    "it's 's 're don't", "日本 語 テ", "\x1c a \x1d", "a \x85b c", "1234 56 7a8", "y" * 3_000, "long " * 4_000, "same", "same", "▁ mark▁",
]


@pytest.fixture(scope="module")
def docs(spark):
    settle(spark)
    rows = [(i if i % 7 else None, t, "x", 1, "clash") for i, t in enumerate(ODD)] + [(1, "same", "x", 1, "clash"), (1, "same", "x", 1, "clash")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, key string, score int, n_tokens string")


def _ids(raw):
    return np.frombuffer(raw, dtype="<u4").tolist()


# ---------------------------------------------------------------- 1: pieces

TOY = [("<unk>", 0.0, "unknown"), *[(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)],
       *[(p, s, "normal") for p, s in (("▁", -3.0), ("a", -2.0), ("b", -2.5), ("ab", -4.0), ("▁a", -4.5), ("ba", -4.5), ("aba", -6.0), ("▁ab", -7.0), ("c", -1.0))]]


def _all_segmentations(model, segment):
    """Every segmentation of a segment in the order the module names."""
    n, found = len(segment), []
    for k in range(n):
        for cuts in combinations(range(1, n), k):
            ends = [0, *cuts, n]
            parts = [segment[a:b] for a, b in zip(ends, ends[1:])]
            known = [model.scores[p][0] if p in model.scores else (model.unknown if len(p) == 1 else None) for p in parts]
            if None not in known:
                found.append((-sum(known), [len(p) for p in parts][::-1]))
    return [(-s, lengths[::-1]) for s, lengths in sorted(found)]


def test_search_lists_all_segmentations_in_order():
    model = pieces.Pieces(vocabulary=TOY)
    for segment in ("▁a", "▁abab", "abaab", "▁xa", "▁▁aba", "c"):
        want = _all_segmentations(model, segment)
        assert model.search(segment, 1_000) == want
        ids, score, loss = model.solve(segment)
        assert (ids, score) == (model.ids(segment, want[0][1]), want[0][0])
        assert loss == (want[0][0] - want[1][0] if len(want) > 1 else float("inf"))


def test_texts_combine_their_segments():
    model = pieces.Pieces(vocabulary=TOY)
    rng = random.Random(5)
    for _ in range(60):
        text = "".join(rng.choice("abcx  ") for _ in range(rng.randint(1, 8)))
        segments = model.segments(text)
        combined = [(0.0, (), b"")]
        for s in segments:
            ranked = _all_segmentations(model, s)
            combined = [(t + score, (r, *ranks), ids + model.ids(s, lengths)) for t, ranks, ids in combined for r, (score, lengths) in enumerate(ranked)]
        want = [(t, ids) for t, _, ids in sorted(combined, key=lambda x: (-x[0], x[1]))]
        for best in (1, 3, 6):
            assert model.encode(text, best) == want[:best]


def test_scores_agree_with_the_library(tmp_path):
    """The same vocabulary marked as a unigram model lets the library list its own N best."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    model.ParseFromString(open(public_path("piece_bpe_32k.model"), "rb").read())
    model.trainer_spec.model_type = 1
    for p in model.pieces:
        p.score = max(p.score, -50_000.0)
    (tmp_path / "twin.model").write_bytes(model.SerializeToString())
    library, own = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "twin.model")), pieces.Pieces(str(tmp_path / "twin.model"))
    score = lambda ids: sum(own.unknown if library.is_byte(i) else own.scores[library.id_to_piece(i)][0] for i in ids)  # bytes here are characters
    for text in ("hello world", "a  b", "  lead", "the of rend, and threlyes.", "x\ty\n", "aaaaaaaaaa", "Öung tezu der."):
        theirs, ours = library.nbest_encode(text, nbest_size=6), own.encode(text, 6)
        assert [score(t) for t in theirs] == [s for s, _ in ours]
        assert all(library.decode(_ids(i)) == text for _, i in ours)


def test_encode_and_decode_round_trip(spark, docs):
    path = public_path("piece_bpe_32k.model")
    found = pieces.encode(docs, path, 3).collect()
    texts = {(r.doc_id, r.rank): r.text for r in pieces.decode(spark.createDataFrame(found), path).collect()}
    assert sum(r.rank == 1 for r in found) == docs.count()
    for i, text in enumerate(ODD):
        own = [r for r in found if r.doc_id == i]
        if i % 7 and "▁" not in (text or "") and i != 1:
            assert all(r.round_trip for r in own) and texts[i, 1] == (text or "")
            assert [r.score for r in sorted(own, key=lambda r: r.rank)] == sorted((r.score for r in own), reverse=True)
    assert pieces.encode(docs.limit(0), path).count() == 0


# ---------------------------------------------------------------- 8: token counts

def test_token_counts_are_the_library_s(spark, docs):
    path = public_path("word_bpe_49k.json")
    library = encoder(path).tokenizer
    want = sorted((t or "").__len__() and len(library.encode(t, add_special_tokens=False).ids) for t in [r.text for r in docs.collect()])
    for chunk, overlap in ((32_768, 256), (64, 8), (700, 4)):
        got = token_counts.count_tokens(docs, path, chunk=chunk, overlap=overlap)
        assert sorted(r.n_tokens for r in got.collect()) == want
    row = got.where("doc_id = 15").first()
    assert (row.n_bytes, row.over_limit) == (20_000, True)
    assert token_counts.count_tokens(docs.limit(0), path).count() == 0


def test_chunks_splice_at_words_wherever_they_fall():
    tokenizer = encoder(public_path("word_bpe_49k.json")).tokenizer

    def encode(text):
        e = tokenizer.encode(text, add_special_tokens=False)
        return e.ids, e.offsets

    rng = random.Random(9)
    for _ in range(80):
        text = "".join(rng.choice(["word ", "don't", " ", "\n", "é", "12", "unbelievable", ". ", "<|endoftext|>", "́"]) for _ in range(60))
        for chunk, overlap in ((20, 3), (33, 8), (90, 16)):
            assert token_counts.count_in_chunks(encode, text, chunk, overlap)[0] == len(encode(text)[0])


def test_both_tokenizers_encode_by_words_as_by_text():
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        e = encoder(public_path(name))
        texts = [t or "" for t in ODD]
        assert e.encode(texts) == e.library(texts)
        assert e.encode(texts[::-1]) == e.library(texts[::-1])


# ---------------------------------------------------------------- 10: packing

def test_pieces_cover_every_document_once(spark, docs):
    path = public_path("byte_bpe_50k.json")
    for capacity, pool in ((64, 256), (1_024, 1 << 18)):
        rows = packing.pack(docs.repartition(3), path, capacity=capacity, pool_tokens=pool).collect()
        encoded = [e + b"\0\0\0\0" for e in encoder(path).encode([r.text or "" for r in docs.collect()])]
        assert sum(r.length for r in rows) == sum(len(e) // 4 for e in encoded)
        crcs = {zlib.crc32(e[4 * r.start : 4 * (r.start + r.length)]) for r in rows for e in encoded if len(e) // 4 == r.doc_tokens}
        assert all(r.ids_crc32 in crcs for r in rows)
        sequences = {}
        for r in rows:
            sequences.setdefault(r.sequence_id, []).append(r)
        for members in sequences.values():
            end = 0
            for r in sorted(members, key=lambda r: r.offset):
                assert r.offset == end
                end += r.length
            assert end == capacity or end & (end - 1) == 0
    assert packing.pack(docs.limit(0), path).count() == 0


def test_assignment_balances_costs():
    rng = random.Random(2)
    lengths = [rng.randint(1, 1_023) for _ in range(400)]
    full, rest = divmod(sum(lengths), 1_024)
    packed = packing.assign(lengths, [1_024] * full + ([rest] if rest else []))
    covered = {}
    for sequence in packed:
        for doc, start, length, _ in sequence:
            covered.setdefault(doc, []).append((start, length))
    for doc, parts in covered.items():
        end = 0
        for start, length in sorted(parts):
            assert start == end
            end += length
        assert end == lengths[doc]
    even = packing.assign([512] * 4 + [128] * 16, [1_024] * 4)
    assert [sorted(n for _, _, n, _ in s) for s in even] == [[128] * 4 + [512]] * 4


# ---------------------------------------------------------------- 4: shards

def test_the_permutation_is_one_and_can_be_undone():
    for n in (1, 2, 3, 16, 17, 1_000, 4_097):
        for seed in (0, 9):
            out = sharding.permute(np.arange(n), n, seed)
            assert sorted(out.tolist()) == list(range(n))
            assert sharding.permute(out, n, seed, back=True).tolist() == list(range(n))
    shard, slot = sharding.place(123, 1_000, 16)
    assert sharding.row_at(shard, slot, 1_000, 16) == 123
    moved = sharding.permute(np.arange(10_000), 10_000)
    assert abs(np.corrcoef(np.arange(10_000), moved)[0, 1]) < 0.05 and (np.diff(moved) == 1).mean() < 0.01


def test_shards_are_even_gapless_and_independent_of_partitions(spark):
    rows = spark.range(1_000).selectExpr("CASE WHEN id % 50 = 0 THEN NULL ELSE id DIV 3 END AS doc_id", "CASE WHEN id % 9 = 0 THEN NULL ELSE 'a' END AS text", "1 AS slot")
    one, other = (sharding.shard(r, 16, buckets=8).collect() for r in (rows.coalesce(1), rows.repartition(7)))
    assert sorted(map(tuple, one), key=str) == sorted(map(tuple, other), key=str)
    assert sorted(r.row_number for r in one) == list(range(1_000))
    for s in range(16):
        slots = sorted(r.slot for r in one if r.shard == s)
        assert slots == list(range(len(slots))) and len(slots) in (62, 63)
    assert all(sharding.place(r.row_number, 1_000, 16) == (r.shard, r.slot) for r in one)
    assert sharding.shard(rows.limit(0), 16).count() == 0
