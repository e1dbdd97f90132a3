"""Writers (K01-K08)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.snapshots import difference, in_target_order, latest
from plumbline.session import reliable_checkpoint, tune
from plumbline.sources.tabular import CSV_FORMAT, exists


def write_csv(df: DataFrame, path: str, columns: list[str], mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Header CSV with a fixed column order."""
    writer = df.select(*columns).write.mode(mode).options(**CSV_FORMAT)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def write_report(sheets: dict[str, DataFrame], path: str) -> None:
    """Each named table of a report in a folder of its own."""
    for name, df in sheets.items():
        df.write.mode("overwrite").options(**CSV_FORMAT).csv(f"{path}/{name}")


def write_json(df: DataFrame, path: str) -> None:
    """One record per line."""
    df.write.mode("overwrite").json(path)


def write_bundle(parts: dict[str, DataFrame], path: str) -> None:
    """The parts of a bundle (meta, places, customers, jobs, counts) side by side.

    A bundle of any size stays distributed: every part is a folder of JSON lines, not one cell.
    """
    for name, df in parts.items():
        write_json(df, f"{path}/{name}")


def write_sheet_xml(df: DataFrame, path: str, columns: list[str], order: list[str]) -> None:
    """Rows as spreadsheet XML, a workbook for each part of a range partition; every one has the header row.

    Each column's cell is text; null is a cell left out, so the next one carries its own position.
    """
    def cell(i: int, text: Column) -> Column:
        safe = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
        return F.when(text.isNull(), F.lit("")).otherwise(F.concat(F.lit(f'<Cell ss:Index="{i}"><Data ss:Type="String">'), safe, F.lit("</Data></Cell>")))

    row = lambda texts: F.concat(F.lit("<Row>"), *[cell(i, t) for i, t in enumerate(texts, 1)], F.lit("</Row>"))
    names = row([F.lit(c) for c in columns])
    space = 'urn:schemas-microsoft-com:office:spreadsheet'
    opening = F.concat(F.lit(f'<?xml version="1.0"?><Workbook xmlns="{space}" xmlns:ss="{space}"><Worksheet ss:Name="Rows"><Table>'), names)
    closing = F.concat(F.lit("</Table></Worksheet><Worksheet ss:Name=\"Notes\"><Table>"), row([F.lit("end of rows")]), F.lit("</Table></Worksheet></Workbook>"))
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_no"), row([F.col(c).cast("string") for c in columns]).alias("value"))
    placed = reliable_checkpoint(placed)
    frames = placed.select("_part").distinct().select("_part", F.inline(F.array(
        F.struct(F.lit(-1).cast("bigint").alias("_no"), opening.alias("value")), F.struct(F.lit((1 << 63) - 1).alias("_no"), closing.alias("value")))))
    # A part is one file: all of its rows in one task, in order.
    placed.unionByName(frames).repartition("_part").sortWithinPartitions("_part", "_no").select("_part", "value").write.mode("overwrite").partitionBy("_part").text(path)


def append_log(df: DataFrame, path: str, columns: list[str]) -> None:
    """Add rows in the log's column order."""
    in_target_order(df, columns).write.mode("append").options(**CSV_FORMAT).csv(path)


def write_changes(df: DataFrame, path: str, batch: str | int, keys: list[str], value: str, stamp: str) -> None:
    """What a batch sets, one row per key, in a folder of its own; writing the batch again replaces it.

    Nothing that other batches wrote is read, moved or written again, so writers of different batches do
    not meet, and a batch that was broken off and comes again leaves no trace of the first attempt.
    """
    latest(df, keys, value, stamp).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def read_latest(spark: SparkSession, path: str, schema: str, keys: list[str], value: str, stamp: str) -> DataFrame:
    """The row of the latest stamp per key over all batches written, in whatever order; empty when there are none."""
    if not exists(spark, f"{path}/batch=*/_SUCCESS"):
        return spark.createDataFrame([], schema)
    return latest(spark.read.schema(schema).parquet(f"{path}/batch=*"), keys, value, stamp)


def fold_changes(spark: SparkSession, path: str, out: str, schema: str, keys: list[str], value: str, stamp: str) -> None:
    """The batches of ``path`` as one batch of the new table ``out``, for when they have become many."""
    write_changes(read_latest(spark, path, schema, keys, value, stamp), out, 0, keys, value, stamp)


#: Parts of a snapshot that have a digest of their own, and bytes of a row group: what a lookup reads at least.
BUCKETS = 1_024
GROUP_BYTES = 1 << 20


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def write_snapshot(df: DataFrame, path: str, label: str, value: str) -> None:
    """One partition per label; writing a label again replaces only that label."""
    df.withColumn(label, F.lit(value)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(label).parquet(path)


def digests(df: DataFrame, keys: list[str]) -> DataFrame:
    """(bucket, n, low, high, mixed): a digest of the rows of each key bucket that does not depend on their order.

    The rows' hashes are added up in halves and combined bit by bit, next to their number.
    """
    row = F.xxhash64(*[x for c in sorted(df.columns) for x in (F.col(c).isNull(), F.col(c))])
    low, high = F.col("_h").bitwiseAND(F.lit(0xFFFFFFFF).cast("bigint")), F.shiftrightunsigned("_h", 32)
    return df.select(_bucket(keys).alias("bucket"), row.alias("_h")).groupBy("bucket").agg(
        F.count("*").alias("n"), F.sum(low).alias("low"), F.sum(high).alias("high"), F.bit_xor("_h").alias("mixed"))


def write_digested(df: DataFrame, path: str, value: str, keys: list[str]) -> None:
    """A snapshot clustered by key bucket, and beside it the buckets' digests (at most ``BUCKETS`` rows)."""
    parts, placed = f"{path}/label={value}", df.withColumn("bucket", _bucket(keys))
    placed.repartitionByRange("bucket").sortWithinPartitions("bucket").write.mode("overwrite").option("parquet.block.size", GROUP_BYTES).parquet(f"{parts}/rows")
    written = df.sparkSession.read.schema(placed.schema).parquet(f"{parts}/rows").drop("bucket")
    digests(written, keys).coalesce(1).write.mode("overwrite").parquet(f"{parts}/digests")


def changed_buckets(spark: SparkSession, path: str, before: str, after: str) -> list[int]:
    """The key buckets whose digests differ between two snapshots; no row of the snapshots is read."""
    own = lambda v: spark.read.parquet(f"{path}/label={v}/digests").select("bucket", F.struct("n", "low", "high", "mixed").alias("d"))
    both = own(before).join(own(after).withColumnRenamed("d", "e"), "bucket", "full").where(~F.col("d").eqNullSafe(F.col("e")))
    return sorted(r["bucket"] for r in both.select("bucket").collect())


def read_buckets(spark: SparkSession, path: str, value: str, schema: str, buckets: list[int]) -> DataFrame:
    """The rows of a snapshot in some of its key buckets; files and row groups of the others are passed over."""
    return spark.read.schema(f"{schema}, bucket int").parquet(f"{path}/label={value}/rows").where(F.col("bucket").isin(buckets)).drop("bucket")


def snapshot_difference(spark: SparkSession, path: str, before: str, after: str, schema: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is new, and rows whose key is gone, from the buckets that changed alone."""
    buckets = changed_buckets(spark, path, before, after)
    return difference(*[read_buckets(spark, path, v, schema, buckets) for v in (before, after)], key)


def write_clustered(df: DataFrame, path: str, keys: list[str], indexed: list[str] | None = None, distinct: int = 100_000, group_bytes: int = GROUP_BYTES) -> None:
    """A table whose files are clustered by the lookup keys, so key filters skip files, row groups and pages.

    Columns ``indexed`` are other keys to look up by: every row group has a Bloom filter of their values, made
    for ``distinct`` values. Both indexes are Parquet's own; any reader with a filter on the column uses them.
    """
    writer = df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").option("parquet.block.size", group_bytes)
    for c in indexed or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true").option(f"parquet.bloom.filter.expected.ndv#{c}", distinct)
    writer.parquet(path)


_NEVER = -(1 << 63)


def append_history(df: DataFrame, path: str, moment: str) -> None:
    """Add rows to a history whose latest moment can be told from the files' footers.

    ``moment`` is kept a second time as whole microseconds, since footers answer for numbers but not for times,
    and a file of nulls has no greatest value: a missing moment is the least number.
    """
    df.withColumn("_micros", F.coalesce(F.unix_micros(F.col(moment).cast("timestamp")), F.lit(_NEVER))).write.mode("append").parquet(path)


def high_water_of(spark: SparkSession, path: str) -> DataFrame:
    """The latest moment of a history as one row, from the files' footers; no column is read.

    Only Spark's newer file reader answers aggregates from footers; it is chosen for this one read.
    """
    held = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    try:
        history = tune(spark).read.parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", held)
    return history.agg(F.max("_micros").alias("m")).select(F.timestamp_micros(F.nullif("m", F.lit(_NEVER))).alias("cutoff"))
