"""Operator 11: hard-negative mining by Four-Russians scoring.

Components are whole numbers. A candidate is kept as bit planes: for every bit of its components, two's
complement, a byte for each group of eight dimensions. For an anchor every group of eight dimensions has
a table of the sums of all 256 subsets of its eight components. A plane's bytes pick one sum per group;
they are added, shifted by the plane's place and added up, the sign plane negative: the full inner
product, exact, by lookups alone.

All anchors meet all candidates, in cells of bounded size: a chunk of anchors with a block of
candidates. First the positives of an anchor are found among blocks of its own label, then the blocks of
all rows are searched in the band below each positive's score. A cell hands on what may still be among
the first few of all cells, so the merge is a rank filter over a few rows per cell.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.base import map_batches, query, table
from plumbline.session import reliable_checkpoint

#: Dimensions whose subsets a table spans.
GROUP = 8
BLOCK_ROWS = 8_192
CHUNK_ROWS = 2_048
#: Anchors and candidates of one lookup, so that the tables and the scores stay in the processor's cache.
LANES, STEP = 256, 1_024

POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95
SCALE = 256


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for every group of eight components the sums of its subsets, bit j for the j-th."""
    n, dim = anchors.shape
    groups = -(-dim // GROUP)
    padded = np.zeros((n, groups * GROUP), dtype=anchors.dtype)
    padded[:, :dim] = anchors
    parts = padded.reshape(n, groups, GROUP)
    sums = np.zeros((groups, 1 << GROUP, n), dtype=anchors.dtype)
    for j in range(GROUP):
        sums[:, 1 << j : 2 << j] = sums[:, : 1 << j] + parts[:, :, j].T[:, None, :]
    return sums


def bit_planes(rows: np.ndarray, bits: int) -> np.ndarray:
    """(rows, bits, groups) as bytes: bit ``p`` of eight components each, in two's complement."""
    planes = (rows[:, None, :] >> np.arange(bits)[None, :, None]) & 1
    return np.packbits(planes.astype(bool), axis=2, bitorder="little")


def _narrowest(largest: int) -> type:
    """The smallest type that holds sums of this magnitude."""
    return next(t for t in (np.int16, np.int32, np.int64) if largest <= np.iinfo(t).max)


def scores(anchors: np.ndarray, planes: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first anchor, scores of some anchors with all candidates), a row an anchor."""
    n, bits, groups = planes.shape
    columns = np.ascontiguousarray(planes.transpose(1, 2, 0))
    largest = int(np.abs(anchors).sum(axis=1).max(initial=0))
    plane_type, total_type = _narrowest(largest), _narrowest(largest << bits)
    for first in range(0, len(anchors), LANES):
        tables = subset_sums(anchors[first : first + LANES].astype(plane_type))
        out = np.empty((tables.shape[2], n), dtype=np.int64)
        for at in range(0, n, STEP):
            part = columns[:, :, at : at + STEP]
            total = np.zeros((part.shape[2], tables.shape[2]), dtype=total_type)
            for p in range(bits):
                plane = np.zeros(total.shape, dtype=plane_type)
                for g in range(groups):
                    plane += np.take(tables[g], part[p, g], axis=0)
                shifted = plane.astype(total_type) << p
                total = total - shifted if p == bits - 1 else total + shifted
            out[:, at : at + STEP] = total.T
        yield first, out


def usable(rows: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """(vec_id, label, dim, q) of the rows that can take part, equal rows once."""
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taken = rows.select(F.col(id_column).cast("bigint").alias("vec_id"), F.col(label_column).cast("bigint").alias("label"), vector.alias("vector"))
    whole = F.transform("vector", lambda x: F.floor(x * SCALE).cast("bigint"))
    sound = taken.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    return sound.select("vec_id", "label", F.size("vector").alias("dim"), whole.alias("q")).distinct()


def packed(rows: DataFrame, bits: int) -> DataFrame:
    """(vec_id, label, dim, planes) with the bit planes of q as bytes."""

    def make():
        def step(batch: dict[str, list]) -> dict[str, list]:
            planes = [bit_planes(np.array([q], dtype=np.int64), bits).tobytes() for q in batch["q"]]
            return {"vec_id": batch["vec_id"], "label": batch["label"], "dim": batch["dim"], "planes": planes}

        return step

    return map_batches(rows, make, "vec_id bigint, label bigint, dim int, planes binary")


def _opened(data: pd.DataFrame, bits: int) -> np.ndarray:
    dim = int(data["dim"].iloc[0])
    return np.frombuffer(b"".join(data["planes"]), dtype=np.uint8).reshape(len(data), bits, -(-dim // GROUP))


def _first(ids: np.ndarray, own: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Of the candidates ``at``, the ``k`` of the highest scores, ties to the smaller id."""
    if len(at) > k:
        least = np.partition(own[at], len(at) - k)[len(at) - k]
        at = at[own[at] >= least]
    return at[np.lexsort((ids[at], -own[at]))][:k]


def _cells(anchors: DataFrame, rows: DataFrame, key: list[str], blocks: int, chunks: int) -> tuple[DataFrame, DataFrame]:
    """Every anchor in every block and every row in every chunk, within equal ``key``."""
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    left = rows.withColumn("block", own(blocks)).select("*", upto(chunks).alias("chunk"))
    right = anchors.withColumn("chunk", own(chunks)).select("*", upto(blocks).alias("block"))
    return left, right


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, most: int = MOST,
         block_rows: int = BLOCK_ROWS, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` and ``anchors`` are (vec_id, label, dim, q) as ``usable`` gives them. An anchor's positives are
    the first other rows of its label; a positive's negatives the first rows of other labels whose score is
    between ``least`` and ``most`` hundredths of the positive's. Higher scores come first, ties go to the
    smaller vec_id. Vectors meet those of their own number of components only; rows that share a vec_id but
    differ are rows of their own, and an anchor is no positive of its own vec_id. An anchor without
    positives, or a positive without rows in its band (such as one of a negative score), gives no rows.
    Scores have to fit a long: components too large for that are refused.
    """
    rows, anchors = reliable_checkpoint(rows), reliable_checkpoint(anchors)
    largest = F.array_max(F.transform("q", lambda x: F.greatest(x, -1 - x)))
    seen = rows.agg(F.count("*").alias("n"), F.max(largest).alias("top"), F.max("dim").alias("dim"), F.max(F.abs(F.array_max(F.transform("q", F.abs)))).alias("size")).first()
    bits = int(seen["top"] or 0).bit_length() + 1
    if int(seen["size"] or 0) * (int(seen["dim"] or 0) << bits) >= 2**63:
        raise ValueError("components are too large for whole scores")
    n, asked = seen["n"], anchors.count()
    blocks, chunks = max(1, -(-n // block_rows)), max(1, -(-asked // chunk_rows))
    planes = reliable_checkpoint(packed(rows, bits))

    def near(data: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame(columns=["anchor_id", "label", "dim", "q", "positive_id", "score"], dtype=object)
        if data.empty or asking.empty:
            return none
        ids, out = data["vec_id"].to_numpy(), []
        for first, found in scores(np.stack(asking["q"].to_numpy()), _opened(data, bits)):
            for i, own in enumerate(found):
                a = asking.iloc[first + i]
                for at in _first(ids, own, np.flatnonzero(ids != a["vec_id"]), positives):
                    out.append((a["vec_id"], a["label"], a["dim"], a["q"], ids[at], own[at]))
        return pd.DataFrame(out, columns=none.columns) if out else none

    # Blocks of one label: as many as its rows need.
    per_label = rows.groupBy("label", "dim").agg(F.count("*").alias("_rows")).withColumn("_blocks", F.ceil(F.col("_rows") / block_rows).cast("int"))
    per_label = reliable_checkpoint(per_label.drop("_rows"))
    chunk_of = F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int")
    left = planes.join(per_label, ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), "_blocks").cast("int")).drop("_blocks")
    left = left.select("*", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    right = anchors.join(per_label, ["label", "dim"]).withColumn("chunk", chunk_of)
    right = right.select("*", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("block")).drop("_blocks")
    cell = ["label", "dim", "block", "chunk"]
    met = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(
        near, "anchor_id bigint, label bigint, dim int, q array<bigint>, positive_id bigint, score bigint")
    # Rows that share a vec_id but differ are told apart by label and components.
    own = ["anchor_id", "label", "dim", "q"]
    order = Window.partitionBy(*own).orderBy(F.desc("score"), "positive_id")
    best = met.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= positives)
    wanted = reliable_checkpoint(best.groupBy(*own).agg(F.array_sort(F.collect_list(F.struct("_rank", "positive_id", "score"))).alias("found")))

    def below(data: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame(columns=["anchor", "anchor_id", "place", "positive_id", "positive_score", "negative_id", "negative_score"], dtype=object)
        if data.empty or asking.empty:
            return none
        ids, labels, out = data["vec_id"].to_numpy(), data["label"].to_numpy(), []
        for first, found in scores(np.stack(asking["q"].to_numpy()), _opened(data, bits)):
            for i, score in enumerate(found):
                a = asking.iloc[first + i]
                other = np.flatnonzero(labels != a["label"])
                theirs = score[other]
                for p in a["found"]:
                    low, high = -(-least * int(p["score"]) // 100), most * int(p["score"]) // 100
                    for at in _first(ids, score, other[(theirs >= low) & (theirs <= high)], negatives):
                        out.append((a["anchor"], a["anchor_id"], p["_rank"], p["positive_id"], p["score"], ids[at], score[at]))
        return pd.DataFrame(out, columns=none.columns) if out else none

    asking = wanted.withColumn("vec_id", F.col("anchor_id")).withColumn("anchor", F.xxhash64(*own))
    left, right = _cells(asking, planes, ["dim"], blocks, chunks)
    cell = ["dim", "block", "chunk"]
    schema = "anchor bigint, anchor_id bigint, place int, positive_id bigint, positive_score bigint, negative_id bigint, negative_score bigint"
    hard = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(below, schema)
    rank = F.row_number().over(Window.partitionBy("anchor", "anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id"))
    ranked = hard.withColumn("rank", rank).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL_OP11 = """
WITH good AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
  FROM good a JOIN good b ON a.vec_id % 50 = 0 AND (a.vec_id <> b.vec_id OR a.label <> b.label)),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 3
"""


@query("op11_lookup_negatives", SQL_OP11)
def op11_lookup_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 50, labels as the query changes them."""
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(vectors.withColumn("label", label), "vec_id", "embedding", "label")
    return mine(rows, rows.where(F.col("vec_id") % 50 == 0))
