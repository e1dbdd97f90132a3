"""Queries against their SQL on tables that are larger, or whose keys are, than those of the smallest scale."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, compare, duck  # noqa: E402

from plumbline.operators import scale  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables are absent")


@pytest.fixture
def with_table(spark, tmp_path):
    """The small tables with one of them replaced."""

    def run(name, rows):
        for t in TABLES:
            if t != name:
                os.symlink(f"{SF_DIR}/{t}.parquet", tmp_path / f"{t}.parquet")
        rows.coalesce(1).toPandas().to_parquet(tmp_path / f"{name}.parquet", index=False)
        return str(tmp_path)

    return run


def test_zips_of_customers_with_five_digits(spark, with_table):
    """Kind 2 is no ZIP code, also where the customer's number has five digits."""
    rows = spark.read.parquet(f"{SF_DIR}/customer.parquet").selectExpr("* except (c_custkey)", "c_custkey + 9950 AS c_custkey")
    sf_dir = with_table("customer", rows)
    note, _, ok, _ = compare(spark, duck(sf_dir), sf_dir, "n09_zips", entry.queries()["n09_zips"], entry.oracle_sql()["n09_zips"])
    assert ok, note


@pytest.mark.parametrize("name", ["s09_front_matter", "t07_export_header", "t07_structure_export", "t08_header_fields", "t08_quote_header"])
def test_rows_of_one_file_are_worked_on_by_many_tasks(spark, name):
    """A file may be one row group: its rows are spread before lines, cells or pages are made of them."""
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan


@pytest.mark.parametrize("name", ["r06_vote_resolution", "w03_best_per_source", "a30_provenance", "a02_entity_sources"])
def test_a_vote_deals_the_lines_once(spark, name):
    """Lines are dealt by order, one row each, before fields are made of them; nothing is dealt again."""
    plan = entry.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning(entity_key" in line]
    assert len(dealt) == 1 and "REPARTITION_BY_NUM" in dealt[0]


@pytest.mark.parametrize("name", ["r06_vote_resolution", "w03_best_per_source", "a02_entity_sources", "a33_source_matrix", "r07_registry_status", "v04_apply_corrections", "v04_rebuilt_downstream"])
def test_an_order_with_a_third_of_all_lines(spark, with_table, monkeypatch, name):
    """Orders that are too long for one task are reduced ahead of the shuffles, with the same results."""
    monkeypatch.setattr(scale, "WHOLE", 100)
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    sf_dir = with_table("lineitem", lines.withColumn("l_orderkey", F.when(F.col("l_partkey") % 3 == 0, F.lit(3).cast("bigint")).otherwise(F.col("l_orderkey"))).withColumn("l_shipdate", F.to_date("l_shipdate")))
    assert len(scale.whole_keys(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_orderkey")) == 2
    note, _, ok, _ = compare(spark, duck(sf_dir), sf_dir, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, note
