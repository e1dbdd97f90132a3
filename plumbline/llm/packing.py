"""Operator 10: cost-balanced packing of documents into sequences of bounded length.

Attention costs each piece its length times a linear weight plus its squared length times a
quadratic one. Within a pool of documents the number of sequences is fixed by the tokens; documents
go, longest first, to the sequence of least cost that has room for them, and a document that fits
nowhere is cut over the sequences of least cost. A pool is what one task has read, in parts of a
bounded number of tokens, so no token ids are shuffled and memory is bounded. What is left of a full
pool waits for the next one; the last rest of a task is cut into sequences whose lengths are powers
of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.base import query, table
from plumbline.llm.vocab import encoder, public_path

CAPACITY = 1_024
POOL_TOKENS = 1 << 18
LINEAR = 1.0
QUADRATIC = 1.0 / 1_024
#: Sequence numbers of one task lie in a range of their own.
TASK_SEQUENCES = 1 << 40

Piece = tuple[int, int, int, int]  # document, start, length, offset in its sequence


def assign(lengths: list[int], rooms: list[int], linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[list[Piece]]:
    """Pieces of documents (by index) for each sequence of the given room; rooms add up to the lengths."""
    room = np.array(rooms, dtype=np.int64)
    cost = np.zeros(len(rooms))
    out: list[list[Piece]] = [[] for _ in rooms]
    size = list(rooms)
    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        start, left = 0, lengths[doc]
        while left:
            fits = room >= left
            k = int(np.argmin(np.where(fits if fits.any() else room > 0, cost, np.inf)))
            taken = min(left, int(room[k]))
            out[k].append((doc, start, taken, size[k] - int(room[k])))
            room[k] -= taken
            cost[k] += linear * taken + quadratic * taken * taken
            start, left = start + taken, left - taken
    return out


def _powers(n: int) -> list[int]:
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


class Packer:
    """Packs the documents of one task; documents are (doc_id, ids, start, doc_tokens)."""

    def __init__(self, first_sequence: int, capacity: int, pool_tokens: int, linear: float, quadratic: float):
        self.sequence, self.capacity, self.pool_tokens = first_sequence, capacity, pool_tokens
        self.weights = linear, quadratic
        self.pool: list[tuple[int | None, np.ndarray, int, int]] = []
        self.held = 0
        self.rows: list[tuple] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            self._emit(doc_id, ids, start, self.capacity, len(ids), 0)
            self.sequence += 1
        if len(ids) > whole:
            self.pool.append((doc_id, ids[whole:].copy(), whole, len(ids)))
            self.held += len(ids) - whole
        if self.held >= self.pool_tokens:
            self.flush()

    def _emit(self, doc_id, ids, start, length, tokens, offset, base=0) -> None:
        crc = zlib.crc32(ids[start : start + length].tobytes())
        self.rows.append((doc_id, base + start, length, crc, tokens, self.sequence, offset))

    def flush(self, last: bool = False) -> None:
        """Pack the pool; a rest below the capacity stays unless it is the last."""
        full, rest = divmod(self.held, self.capacity)
        rooms = [self.capacity] * full + _powers(rest)
        packed = assign([len(p[1]) for p in self.pool], rooms, *self.weights)
        keep = [] if last else [piece for pieces in packed[full:] for piece in pieces]
        for pieces in packed if last else packed[:full]:
            for doc, start, length, offset in pieces:
                doc_id, ids, base, tokens = self.pool[doc]
                self._emit(doc_id, ids, start, length, tokens, offset, base)
            self.sequence += 1
        self.pool = [(self.pool[d][0], self.pool[d][1][s : s + n].copy(), self.pool[d][2] + s, self.pool[d][3]) for d, s, n, _ in keep]
        self.held = sum(len(p[1]) for p in self.pool)


OUT = [
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
    ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
]


def pack(docs: DataFrame, path: str, end_id: int = 0, capacity: int = CAPACITY, pool_tokens: int = POOL_TOKENS,
         linear: float = LINEAR, quadratic: float = QUADRATIC) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of all documents.

    A document is its ids and ``end_id``; a null text is empty and is that one id. Equal rows and
    null doc_ids are packed each for itself; other columns are ignored. ``capacity`` is a power of two.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        packer = Packer(TaskContext.get().partitionId() * TASK_SEQUENCES, capacity, pool_tokens, linear, quadratic)
        end = np.array([end_id], dtype="<u4").tobytes()

        def out() -> pa.RecordBatch:
            columns = list(zip(*packer.rows)) or [()] * len(OUT)
            packer.rows = []
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, (_, t) in zip(columns, OUT)], names=[n for n, _ in OUT])

        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for doc_id, encoded in zip(ids, words.encode([t or "" for t in texts])):
                packer.add(doc_id, np.frombuffer(encoded + end, dtype="<u4"))
            yield out()
        packer.flush(last=True)
        yield out()

    schema = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


@query("op10_cost_packing")
def op10_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack(table(spark, sf_dir, "documents"), public_path("byte_bpe_50k.json"))
