"""Session helpers: runtime settings and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job wants; all can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join keys even where that costs one more exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Small tables are heavy to work on here (texts, decoding, joins of texts): they too go to several tasks.
    "spark.sql.files.openCostInBytes": "512k",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    # Least and greatest values from file footers, where the reader can.
    "spark.sql.parquet.aggregatePushdown": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("plumbline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster. On one machine a scratch folder, gone at the end, serves instead."""
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="plumbline-ckpt-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_RUNS: dict[str, str] = {}


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _run_folder(spark: SparkSession) -> str:
    """The folder of this application's kept tables, removed when its driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _RUNS:
        _RUNS[app] = f"{checkpoint_dir(spark)}/kept-{app}-{uuid.uuid4().hex}"

        def clean() -> None:
            with contextlib.suppress(Exception):  # the gateway may be gone
                _remove(spark, _RUNS[app])

        atexit.register(clean)
    return _RUNS[app]


def sweep_kept(spark: SparkSession, hours: float) -> int:
    """Remove what drivers that were killed have left in the shared folder: kept tables not written to for ``hours``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark)}/kept-*")
    own = _RUNS.get(spark.sparkContext.applicationId, "").rpartition("/")[2]
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    old = [s for s in found if s.getModificationTime() < (time.time() - hours * 3600) * 1000 and s.getPath().getName() != own]
    for status in old:
        _remove(spark, status.getPath().toString())
    return len(old)


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage through a table in the shared folder, so a lost executor costs no recomputation.

    A table rather than ``checkpoint()``: it keeps its columns and its size, so later joins can
    still prune columns and pick a side to broadcast. It lasts as long as the driver.
    """
    folder = f"{_run_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
