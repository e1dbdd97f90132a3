"""Row admission and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_reject_reason(rows: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """The first rule a row breaks, NULL for rows to keep."""
    reason = F.coalesce(*[F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules])
    return rows.withColumn("reject_reason", reason)


def admitted(judged: DataFrame) -> DataFrame:
    return judged.where(F.col("reject_reason").isNull()).drop("reject_reason")


def reject_counts(judged: DataFrame) -> DataFrame:
    """rows by reason, kept rows included."""
    return judged.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("rows"))


def baseline_check(actual: DataFrame, expected: DataFrame, key: str, value: str) -> DataFrame:
    """Q02: actual against expected per key; more than expected fails."""
    joined = expected.select(key, F.col(value).alias("baseline")).join(actual.select(key, F.col(value).alias("actual")), key, "left")
    joined = joined.withColumn("actual", F.coalesce("actual", F.lit(0).cast("bigint")))
    return joined.withColumn("ok", F.col("actual") <= F.col("baseline"))


def populated_share(rows: DataFrame, *columns: str) -> DataFrame:
    """Q06: part of the rows in which each column holds something."""
    return rows.agg(*[F.round(F.avg((F.coalesce(F.col(c).cast("string"), F.lit("")) != "").cast("int")), 4).alias(c) for c in columns])


def sample_rows(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows picked by a digest of their key, the same ones on every run."""
    return rows.orderBy(F.md5(F.concat_ws("|", F.lit(seed), F.col(key))), key).limit(n)


def column_widths(rows: DataFrame) -> DataFrame:
    """Longest text of every column."""
    return rows.agg(*[F.max(F.length(F.col(c).cast("string"))).alias(c) for c in rows.columns])


def require_inputs(spark, paths: list[str]) -> None:
    """Q03: stop before a run when an input is missing."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    absent = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        if not p.getFileSystem(conf).globStatus(p):
            absent.append(path)
    if absent:
        raise FileNotFoundError(", ".join(absent))
