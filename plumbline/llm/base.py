"""Registration and small helpers shared by the operators of this package."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Rows of one Arrow batch: long texts make a batch large, so few rows go into one.
BATCH_ROWS = 256


def ship(spark: SparkSession) -> None:
    """Send this library's code to the executors' Python, once a Spark context."""
    context = spark.sparkContext
    if any(name.startswith("plumbline-code-") for name in context._python_includes):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = os.path.realpath(tempfile.mkdtemp(prefix="plumbline-code-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/plumbline-code-{uuid.uuid4().hex}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for top, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    out.write(f"{top}/{name}", os.path.relpath(f"{top}/{name}", os.path.dirname(package)))
    context.addPyFile(archive)


def settle(spark: SparkSession) -> SparkSession:
    """Settings and code that the operators need in a session."""
    ship(spark)
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    # Joins that want few of a table's texts drop the others by a Bloom filter before the shuffle.
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "16MB")
    return spark


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result in DuckDB's dialect."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(settle(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: Column | str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores before it until no column of ``df`` has it; names ignore case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def map_batches(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list] | None]], schema: str) -> DataFrame:
    """Apply Python to Arrow batches as lists by column name.

    ``make`` runs once a task and returns the function for its batches.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    parsed = StructType.fromDDL(schema)
    arrow = to_arrow_schema(parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            out = step(batch.to_pydict())
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, parsed)
