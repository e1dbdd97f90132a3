"""Registration of the queries over the driver tables, and the views several of them share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession

from plumbline.functions.clean import int_to_code
from plumbline.session import checkpoint_dir, tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result in DuckDB's dialect."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__, run.__doc__ = name, fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run, in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- shared views

# A customer's three-letter job code.
CODE_SQL = "chr(65 + CAST((c_custkey // 676) % 26 AS INT)) || chr(65 + CAST((c_custkey // 26) % 26 AS INT)) || chr(65 + CAST(c_custkey % 26 AS INT))"


def customer_code(c: str = "c_custkey") -> Column:
    return int_to_code(c)


# Return flags stand for the systems a line is reported by.
FLAG_SOURCE = {"A": "bom_union", "N": "dispatch", "R": "registry"}
FLAG_SYSTEM = {"A": "erp_fb", "N": "erp_ns", "R": "erp_qb"}


def case(c: str, table_: dict) -> str:
    """SQL text of a value map."""
    return f"CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in table_.items()) + " END"
