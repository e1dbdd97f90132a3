"""Structured Streaming forms of the incremental jobs (ST01-ST03)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators.geocode import suspect_rows
from plumbline.operators.snapshots import latest


def read_stream(spark: SparkSession, path: str, schema: str, file_format: str = "parquet", files_per_trigger: int = 1000, **options) -> DataFrame:
    return spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_per_trigger).options(**options).load(path)


def new_rows(stream: DataFrame, key: str, moment: str, lateness: str) -> DataFrame:
    """ST01: each id once; rows later than the watermark are dropped, and so is their state."""
    timed = stream.withColumn(moment, F.col(moment).cast("timestamp")).withWatermark(moment, lateness)
    return timed.dropDuplicatesWithinWatermark([key])


def append_stream(rows: DataFrame, path: str, checkpoint: str, file_format: str = "parquet") -> StreamingQuery:
    """ST01: run over what has arrived and append it; a rerun continues from the checkpoint."""
    return (
        rows.writeStream.format(file_format).option("path", path).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start())


def _each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def upsert_stream(stream: DataFrame, path: str, keys: list[str], value: str, stamp: str, checkpoint: str) -> StreamingQuery:
    """ST02: latest value per key, kept as the stream's own state.

    The state holds one row per key and is checkpointed with the offsets; a batch puts out the keys it
    touched with what is latest for them now, and writes them to a folder of its own (``tables.read_latest``
    reads them). Repeating a batch after a failure replaces its folder. State lies in an embedded store on
    disk, so it may outgrow the executors' memory.
    """
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)

    def work(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    kept = latest(stream, keys, value, stamp)
    return kept.writeStream.outputMode("update").foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_with_anomalies(stream: DataFrame, gazetteer: DataFrame, city: str, state: str, rows_path: str, anomalies_path: str,
                          checkpoint: str) -> StreamingQuery:
    """ST03: each batch's rows, and apart from them the rows whose place contradicts the gazetteer.

    A batch writes its own folder, so repeating it replaces its rows instead of doubling them.
    """

    def work(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        try:
            held.write.mode("overwrite").parquet(f"{rows_path}/batch={number}")
            suspect_rows(held, gazetteer, city, state).write.mode("overwrite").parquet(f"{anomalies_path}/batch={number}")
        finally:
            held.unpersist()

    return _each_batch(stream, work, checkpoint)
