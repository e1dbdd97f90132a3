"""Incremental batches, upserts and snapshot differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_shipments(left: DataFrame, right: DataFrame, key: str, row_no: str) -> tuple[DataFrame, DataFrame]:
    """Lines with the last right row of their id, and the count of lines without one."""
    cols = [c for c in right.columns if c not in (key, row_no)]
    last = right.where(F.trim(key) != "").groupBy(key).agg(F.max_by(F.struct(*cols), F.col(row_no)).alias("r")).select(key, "r.*")
    return left.join(last, key), left.join(last, key, "left_anti").agg(F.count("*").alias("unmatched"))


def high_water(history: DataFrame, moment: str) -> DataFrame:
    """The latest moment on record, as one row."""
    return history.agg(F.max(moment).alias("cutoff"))


def after_cutoff(batch: DataFrame, history: DataFrame, moment: str) -> DataFrame:
    """Each batch row marked new, old (at or before the cutoff) or bad (no date)."""
    cutoff = high_water(history, moment).scalar()
    state = F.when(F.col(moment).isNull(), "bad_date").when(cutoff.isNotNull() & (F.col(moment) <= cutoff), "before_cutoff").otherwise("new")
    return batch.withColumn("batch_state", state)


def batch_summary(new_rows: DataFrame, kind: str, moment: str) -> DataFrame:
    """Rows per kind with the first and last moment."""
    return new_rows.groupBy(kind).agg(F.count("*").alias("rows"), F.min(moment).alias("first"), F.max(moment).alias("last"))


def in_target_order(rows: DataFrame, target_columns: list[str]) -> DataFrame:
    """Exactly the target's columns, in its order; what a row lacks is ''."""
    return rows.select(*[F.col(c) if c in rows.columns else F.lit("").alias(c) for c in target_columns])


def latest(rows: DataFrame, keys: list[str], value: str, stamp: str) -> DataFrame:
    """K05, ST02: the row of the latest stamp per key; rows without a value set nothing.

    Of one stamp the greatest value counts, so the outcome does not depend on the order in which rows came.
    """
    cols = [c for c in rows.columns if c not in keys]
    found = rows.where(F.trim(F.col(value)) != "").groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(stamp, value)).alias("r"))
    return found.select(*[F.col(c) if c in keys else F.col(f"r.{c}").alias(c) for c in rows.columns])


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], value: str, stamp: str) -> DataFrame:
    """The row of the latest stamp per key, whichever batch brought it; rows without a value change nothing."""
    given = incoming.where(F.trim(F.col(value)) != "")
    both = existing.withColumn("_new", F.lit(0)).unionByName(given.withColumn("_new", F.lit(1)))
    cols = [c for c in existing.columns if c not in keys]
    newest = both.groupBy(*keys).agg(F.max_by(F.struct(*cols), F.struct(stamp, "_new", value)).alias("r"))
    return newest.select(*keys, "r.*")


def difference(before: DataFrame, after: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows that are new, and rows that are gone."""
    return after.join(before.select(key), key, "left_anti"), before.join(after.select(key), key, "left_anti")


def metrics(pieces: DataFrame, cls: str, classes: list[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """One row - pieces, pieces per class and further counts."""
    return pieces.agg(F.count("*").alias("pieces"), *[F.count_if(F.col(cls) == c).alias(c.replace("-", "_")) for c in classes],
                      *[c.alias(n) for n, c in (extra or {}).items()])


def metric_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Each metric before, after and the change."""
    def long(df, name):
        cols = df.columns
        items = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("bigint").alias(name)) for c in cols])
        return df.select(F.inline(items))

    joined = long(before, "previous").join(long(after, "current"), "metric", "full")
    zero = F.lit(0).cast("bigint")
    return joined.select("metric", F.coalesce("previous", zero).alias("previous"), F.coalesce("current", zero).alias("current")).withColumn(
        "delta", F.col("current") - F.col("previous"))
