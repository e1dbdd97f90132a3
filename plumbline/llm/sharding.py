"""Operator 4: a reproducible shuffle into shards by a Feistel permutation of global row numbers.

Every row gets a dense global row number; a Feistel network on two unequal halves permutes the
numbers, and numbers that leave the range walk the cycle until they are inside. The place of a row
is its permuted number: shard is the remainder by the shard count, slot the quotient, so counts
differ by one at most, slots have no gaps, and both directions can be computed without a table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.base import query, table, text_of
from plumbline.session import reliable_checkpoint

ROUNDS = 6
BUCKETS = 4_096
#: Copies of one row that one step of the expansion makes.
COPIES = 65_536


def _mixed(value: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit hash of numbers under a key."""
    with np.errstate(over="ignore"):
        x = value.astype(np.uint64) + np.uint64((key * 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _halves(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(n - 1, 0)) + 1)
    return a, max(1, -(-n // a))


def _network(x: np.ndarray, a: int, b: int, seed: int, back: bool) -> np.ndarray:
    """One pass over numbers below a * b: each round adds a hash of one half to the other."""
    left, right = x % a, x // a
    for r in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
        half, other, size = (left, right, a) if r % 2 == 0 else (right, left, b)
        step = (_mixed(other, seed * ROUNDS + r) % np.uint64(size)).astype(np.int64)
        moved = (half - step if back else half + step) % size
        left, right = (moved, right) if r % 2 == 0 else (left, moved)
    return right * a + left


def permute(x: np.ndarray, n: int, seed: int = 0, back: bool = False) -> np.ndarray:
    """The place of each row number below ``n``; ``back`` gives the row number of each place."""
    a, b = _halves(n)
    out = _network(np.asarray(x, dtype=np.int64), a, b, seed, back)
    while (outside := out >= n).any():
        out[outside] = _network(out[outside], a, b, seed, back)
    return out


def place(row: int, n: int, shards: int, seed: int = 0) -> tuple[int, int]:
    """Shard and slot of a global row number."""
    p = int(permute(np.array([row]), n, seed)[0])
    return p % shards, p // shards


def row_at(shard: int, slot: int, n: int, shards: int, seed: int = 0) -> int:
    """The global row number that lies in a slot of a shard."""
    return int(permute(np.array([slot * shards + shard]), n, seed, back=True)[0])


def number_rows(rows: DataFrame, out: str = "row_number", buckets: int = BUCKETS) -> DataFrame:
    """Dense global numbers 0, 1, ... in the order of a digest of the whole row.

    Equal rows are counted first and numbered as a run, so a row that is repeated millions of times
    is one row until the last step. Digest buckets are numbered apart and shifted by the rows before
    them: at most ``buckets`` counts meet in one place. The numbers depend on the rows alone, not on
    their order or partitions.
    """
    columns = rows.columns
    counted = reliable_checkpoint(rows.groupBy(*columns).agg(F.count("*").alias("_copies")))
    # Nulls are hashed as a flag of their own, since a hash skips them.
    digest = F.xxhash64(*[x for c in columns for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())])
    keyed = counted.withColumn("_bucket", F.pmod(digest, F.lit(buckets)))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = keyed.groupBy("_bucket").agg(F.sum("_copies").alias("_rows")).select(
        "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift")
    )
    inside = Window.partitionBy("_bucket").orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in columns]).rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("_copies").over(inside), F.lit(0)) + F.col("_shift")
    numbered = keyed.join(F.broadcast(shifts), "_bucket").withColumn("_first", first)
    runs = numbered.withColumn("_run", F.explode(F.sequence(F.lit(0), F.expr(f"(_copies - 1) DIV {COPIES}"))))
    last = F.least(F.col("_copies") - 1, (F.col("_run") + 1) * COPIES - 1)
    each = runs.withColumn("_copy", F.explode(F.sequence(F.col("_run") * COPIES, last)))
    return each.select(*columns, (F.col("_first") + F.col("_copy")).alias(out))


def shard(rows: DataFrame, shards: int, seed: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """``rows`` with global ``row_number``, ``shard`` and ``slot``.

    Nulls are values like any other; equal rows take places of their own; an empty table stays empty.
    Columns of these three names that ``rows`` has already are replaced.
    """
    numbered = reliable_checkpoint(number_rows(rows.drop("row_number", "shard", "slot"), buckets=buckets))
    n = numbered.count()

    @F.pandas_udf("bigint")
    def placed(number: pd.Series) -> pd.Series:
        return pd.Series(permute(number.to_numpy(), n, seed))

    return numbered.withColumn("_place", placed("row_number")).select(
        *numbered.columns, (F.col("_place") % shards).cast("int").alias("shard"), F.expr(f"_place DIV {shards}").alias("slot")
    )


@query("op4_feistel_shards")
def op4_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal row counts."""
    text = text_of()
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    return shard(rows, 16).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row_number"
    )
