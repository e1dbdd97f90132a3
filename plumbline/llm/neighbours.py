"""Operator 3: approximate nearest neighbours by a forest of hash prefixes.

Every vector has one long hash string a tree, the signs of random projections. A tree is the array of all
strings in order; it lies in ranges, one for each prefix of the length that leaves a range some thousand
strings, and each range is sorted where it lies. A query descends every tree to the range its own string
falls into, and there to its longest matching prefix. Then all trees ascend together, one bit at a time: a
step up adds to each tree the range, or ranges, that share the shorter prefix and were not met yet, and the
vectors in them become candidates. A query stops when a vector as near as its k-th best would have been met
with the wanted probability, which follows from the angle, the level and the number of trees; only the
queries that go on ask for further ranges. At the root every vector has been met.

Inner products of vectors of different lengths become angles through one more coordinate that brings all
candidates of a band to one length; bands hold lengths within a factor of two. A range that one prefix
fills, as copies of one vector do, is cut into parts, and the queries of a range into chunks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.base import map_batches, query, table
from plumbline.session import reliable_checkpoint

TREES = 16
#: Length of a hash string; whole numbers that are not negative keep the order of the strings.
BITS = 63
RANGE_ROWS = 2_048
QUERY_ROWS = 2_048
RECALL = 0.95


def planes_of(dim: int, trees: int, seed: int = 11) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim + 1, trees * BITS))


def strings(points: np.ndarray, trees: int) -> np.ndarray:
    """Hash strings as whole numbers, the first bit highest; one column a tree."""
    signs = (points @ planes_of(points.shape[1] - 1, trees) > 0).reshape(len(points), trees, BITS)
    return (signs * (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))).sum(axis=2)


class Range:
    """One range of a tree: its strings in order, with the vectors they belong to."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(codes, kind="stable")
        self.codes, self.ids, self.vectors = codes[order], ids[order], vectors[order]

    def descend(self, code: int) -> int:
        """The length of the longest prefix that a string shares with one of the range."""
        at = int(np.searchsorted(self.codes, code))
        near = self.codes[max(at - 1, 0) : at + 1]
        return max(BITS - int(int(c) ^ code).bit_length() for c in near.tolist())

    def sharing(self, code: int, level: int) -> tuple[int, int]:
        """The stretch of strings that share ``level`` bits."""
        low = (code >> (BITS - level)) << (BITS - level)
        return int(np.searchsorted(self.codes, low)), int(np.searchsorted(self.codes, low + (1 << (BITS - level)) - 1, side="right"))

    def nearest(self, asked: np.ndarray, own: np.ndarray, codes: np.ndarray, levels: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and scores of the nearest ``k`` among the strings that share its level's bits, ties to the smaller id."""
        rough = asked @ self.vectors.T
        spare = 1e-9 * (1 + np.abs(rough).max(axis=1, initial=0.0))
        out = []
        for q, vector in enumerate(asked):
            low, high = self.sharing(int(codes[q]), min(int(levels[q]), self.descend(int(codes[q]))))
            at = low + np.flatnonzero(self.ids[low:high] != own[q])
            if len(at) > k:
                # The product of matrices may round equal vectors apart: what is within rounding of the last is looked at again.
                scores = rough[q, at]
                at = at[scores >= np.partition(scores, len(at) - k)[len(at) - k] - spare[q]]
            exact = np.einsum("ij,j->i", self.vectors[at], vector)
            best = np.lexsort((self.ids[at], -exact))[:k]
            out.append((self.ids[at][best], exact[best]))
        return out


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, vector) as doubles, once each, of the rows that can take part."""
    vector = F.transform(F.col(vector_column), lambda x: x.cast("double"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("vec_id"), vector.alias("vector")).where(F.col("vec_id").isNotNull())
    return rows.where(F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)).dropDuplicates(["vec_id", "vector"])


def _coded(rows: DataFrame, trees: int, is_query: bool) -> DataFrame:
    """(vec_id, dim, band, size, vec, codes) of (vec_id, vector): its length's band, its components as bytes, its string in every tree."""

    def make():
        def step(batch: dict[str, list]) -> dict[str, list]:
            out = {"vec_id": [], "dim": [], "band": [], "size": [], "vec": [], "codes": []}
            dims = [len(v) for v in batch["vector"]]
            for dim in set(dims):
                at = [i for i, n in enumerate(dims) if n == dim]
                vectors = np.array([batch["vector"][i] for i in at], dtype=np.float64)
                sizes = np.sqrt((vectors**2).sum(axis=1))
                band = np.ceil(np.log2(np.maximum(sizes, 1e-300)))
                unit = vectors / (sizes if is_query else 2.0**band)[:, None]
                rest = np.zeros(len(at)) if is_query else np.sqrt(np.maximum(0.0, 1.0 - (unit**2).sum(axis=1)))
                out["vec_id"] += [batch["vec_id"][i] for i in at]
                out["dim"] += [dim] * len(at)
                out["band"] += band.astype(int).tolist()
                out["size"] += sizes.tolist()
                out["vec"] += [v.tobytes() for v in vectors]
                out["codes"] += strings(np.column_stack([unit, rest]), trees).tolist()
            return out

        return step

    return map_batches(rows.select("vec_id", "vector"), make, "vec_id bigint, dim int, band int, size double, vec binary, codes array<bigint>")


_RANGE = ["dim", "band", "tree", "prefix"]


def _in_trees(rows: DataFrame, bands: DataFrame) -> DataFrame:
    """A row for every tree; bands that are one range need one tree only."""
    return rows.join(bands, "dim" if "band" not in rows.columns else ["dim", "band"]).select(
        *rows.drop("codes").columns, *[c for c in ("band", "level") if c not in rows.columns], F.posexplode("codes").alias("tree", "code")).where((F.col("level") > 0) | (F.col("tree") == 0))


def _asked_ranges(asking: DataFrame, step: int) -> DataFrame:
    """The ranges that a query meets for the first time ``step`` levels above its own, with that level as ``at``."""
    own = F.expr(f"shiftright(code, cast({BITS} - level as int))")
    if step == 0:
        return asking.withColumns({"prefix": own, "at": F.col("level")})
    # The sibling of the branch it came from, and all ranges below that.
    first = F.shiftleft(F.shiftright(own, step - 1).bitwiseXOR(F.lit(1).cast("bigint")), step - 1)
    higher = asking.where(F.col("level") >= step).withColumn("at", F.col("level") - step)
    return higher.withColumn("prefix", F.explode(F.sequence(first, first + (1 << (step - 1)) - 1)))


def _met(ranges: DataFrame, forest: DataFrame, k: int, range_rows: int, query_rows: int) -> DataFrame:
    """(query_id, vec_id, score): the nearest ``k`` of every query in every range it asks for."""
    chunks = ranges.groupBy(*_RANGE).agg(F.ceil(F.count("*") / query_rows).alias("chunks"))
    parts = forest.groupBy(*_RANGE).agg(F.ceil(F.count("*") / range_rows).alias("parts"))
    both = reliable_checkpoint(parts.join(chunks, _RANGE))
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = forest.join(both, _RANGE).withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts")).withColumn("chunk", upto("chunks"))
    right = ranges.join(both, _RANGE).withColumn("chunk", F.pmod(F.xxhash64("query_id"), "chunks")).withColumn("part", upto("parts"))
    cell = [*_RANGE, "part", "chunk"]

    def search(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if data.empty or asked.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        dim = int(data["dim"].iloc[0])
        opened = lambda column: np.frombuffer(b"".join(column), dtype=np.float64).reshape(-1, dim)
        own = asked["query_id"].to_numpy()
        found = Range(data["code"].to_numpy(), data["vec_id"].to_numpy(), opened(data["vec"])).nearest(
            opened(asked["vec"]), own, asked["code"].to_numpy(), asked["at"].to_numpy(), k)
        return pd.DataFrame({
            "query_id": np.repeat(own, [len(f[0]) for f in found]),
            "vec_id": np.concatenate([f[0] for f in found]), "score": np.concatenate([f[1] for f in found]),
        })

    met = left.select(*cell, "vec_id", "code", "vec").groupBy(*cell).cogroup(right.select(*cell, "query_id", "code", "vec", "at").groupBy(*cell))
    return met.applyInPandas(search, "query_id bigint, vec_id bigint, score double")


def _unsure(best: DataFrame, asked: DataFrame, bands: DataFrame, step: int, k: int, recall: float, trees: int) -> DataFrame:
    """The queries for which some band may still hold a nearer vector with more than the allowed probability."""
    last = best.groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
    levels = asked.select(F.col("vec_id").alias("query_id"), "dim", "size").join(bands.where(F.col("level") > step), "dim").join(last, "query_id", "left")
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("kth") / F.col("size") / F.pow(F.lit(2.0), F.col("band"))))
    together = 1 - F.acos(cosine) / math.pi
    met = 1 - F.pow(1 - F.pow(together, F.col("level") - step), F.lit(float(trees)))
    return levels.where(F.col("n").isNull() | (F.col("n") < k) | (met < recall)).select("query_id").distinct()


def nearest(queries: DataFrame, vectors: DataFrame, k: int, recall: float = RECALL, trees: int = TREES,
            range_rows: int = RANGE_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score: the nearest ``k`` of ``vectors`` for each of ``queries``.

    Both are (vec_id, vector) as ``usable`` gives them. A query does not meet vectors of its own id, and
    meets vectors of its own number of components only; rows of one query_id are one query. A query without
    candidates gives no rows.
    """
    coded, asked = reliable_checkpoint(_coded(vectors, trees, False)), reliable_checkpoint(_coded(queries, trees, True).drop("band"))
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / range_rows))).cast("int")
    bands = reliable_checkpoint(coded.groupBy("dim", "band").agg(F.count("*").alias("n")).select("dim", "band", level.alias("level")))
    top = bands.agg(F.max("level")).first()[0]
    forest = _in_trees(coded.drop("size"), bands).withColumn("prefix", F.expr(f"shiftright(code, cast({BITS} - level as int))"))
    asking = _in_trees(asked.withColumnRenamed("vec_id", "query_id").drop("size"), bands)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best, active = None, None
    for step in range((top or 0) + 1):
        ranges = _asked_ranges(asking if active is None else asking.join(active, "query_id", "left_semi"), step)
        met = _met(reliable_checkpoint(ranges), forest, k, range_rows, query_rows)
        every = (met if best is None else met.unionByName(best)).distinct()
        best = reliable_checkpoint(every.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank"))
        if step < (top or 0):
            active = reliable_checkpoint(_unsure(best, asked, bands, step, k, recall, trees))
            if active.isEmpty():
                break
    return best.withColumn("rank", rank).select("query_id", "rank", "vec_id", "score")


@query("op3_prefix_forest")
def op3_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    vectors = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return nearest(vectors.where(F.col("vec_id") % 20 == 0), vectors, 20)
