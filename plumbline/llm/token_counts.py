"""Operator 8: token counts of whole texts, huge ones chunk by chunk with overlap resynchronisation.

A text longer than a chunk is encoded in chunks that overlap, with offsets. Two neighbours are
spliced at the first token that begins at the same character in both, follows white space and leads
a word that is complete in both and has the same ids. No merge, normal form or pre-token of the
tokenizer crosses white space, so on either side of such a place the chunk's tokens are those of the
whole text. Where an overlap holds no such place it is doubled, and where it would cover the whole
chunk, the chunk itself grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.base import map_batches, query, table, text_of
from plumbline.llm.vocab import encoder, public_path

CHUNK = 32_768
OVERLAP = 256
LIMIT = 2_048
#: White space to both Python and the tokenizers.
SPACES = " \n\t\r"


def _splice(text: str, left: tuple[int, int, list, list], right: tuple[int, int, list, list]) -> tuple[int, int] | None:
    """Token indexes in two overlapping chunks (start, end, ids, offsets) from which both agree."""
    a, b, ids, offsets = left
    c, _, other, others = right
    # Several tokens can begin at one character; the first of them counts.
    at = {a + offsets[i][0]: i for i in range(len(offsets) - 1, -1, -1) if a + offsets[i][0] > c}
    for j, (s, _) in enumerate(others):
        p = c + s
        if p >= b:
            return None
        i = at.get(p)
        if i is None or text[p - 1] not in SPACES:
            continue
        # The tokens up to the next white space: the word has to be complete in both.
        k = 0
        while j + k < len(others) and i + k < len(ids) and others[j + k][0] + c == offsets[i + k][0] + a and other[j + k] == ids[i + k]:
            k += 1
            if j + k < len(others) and i + k < len(ids) and c + others[j + k][0] < b and text[c + others[j + k][0] - 1] in SPACES:
                return i, j
    return None


def count_in_chunks(encode, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[int, int]:
    """Tokens of a text, and the chunks it took. ``encode`` gives ids and offsets of a string."""
    n = len(text)

    def part(a: int, b: int) -> tuple[int, int, list, list]:
        return (a, b, *encode(text[a:b]))

    left, done, total, chunks = part(0, min(n, chunk)), 0, 0, 1
    while left[1] < n:
        a, b, ids, offsets = left
        first = next((i for i, (s, _) in enumerate(offsets) if a + s >= done), len(ids)) if done else 0
        width, found = overlap, None
        while not found and b - width > a:
            right = part(b - width, min(n, b - width + max(chunk, 2 * width)))
            found, width = _splice(text, left, right), width * 2
        chunks += 1
        if found:
            total += found[0] - first
            left, done = right, right[0] + right[3][found[1]][0]
        else:
            left = part(a, min(n, a + 2 * (b - a)))
    a, _, ids, offsets = left
    first = next((i for i, (s, _) in enumerate(offsets) if a + s >= done), len(ids)) if done else 0
    return total + len(ids) - first, chunks


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit and n_chunks of every row of ``docs`` (doc_id, text).

    A null text is empty: 0 bytes and tokens. Equal rows are counted each; other columns are ignored.
    ``path`` is a tokenizers file whose pre-tokenizer splits at white space.
    """

    def make():
        words = encoder(path)

        def encode(text: str) -> tuple[list, list]:
            e = words.tokenizer.encode(text, add_special_tokens=False)
            return e.ids, e.offsets

        def step(batch: dict[str, list]) -> dict[str, list]:
            texts = [t or "" for t in batch["text"]]
            counts = [(len(i) // 4, 1) for i in words.encode([t if len(t) <= chunk else "" for t in texts])]
            counts = [c if len(t) <= chunk else count_in_chunks(encode, t, chunk, overlap) for t, c in zip(texts, counts)]
            return {"doc_id": batch["doc_id"], "n_bytes": batch["n_bytes"], "n_tokens": [c[0] for c in counts], "n_chunks": [c[1] for c in counts]}

        return step

    rows = docs.select("doc_id", "text", F.octet_length(text_of()).cast("bigint").alias("n_bytes"))
    counted = map_batches(rows, make, "doc_id bigint, n_bytes bigint, n_tokens bigint, n_chunks int")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"), "n_chunks")


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return count_tokens(table(spark, sf_dir, "documents"), public_path("word_bpe_49k.json"))
