"""Building blocks against plain Python, with hot keys and many blocks."""

import random

import pytest
from pyspark.sql import functions as F

from plumbline.operators import ledger, scale
from plumbline.session import checkpoint_dir, reliable_checkpoint, sweep_kept


def _rows(n=400, seed=3):
    rng = random.Random(seed)
    # One key holds most rows.
    return [("hot" if rng.random() < 0.7 else rng.choice("abc"), i * 7, rng.choice([None, None, None, "x", "y"]), rng.randint(0, 1)) for i in range(n)]


def _expected(rows):
    state, want = {}, {}
    for k, o, v, f in sorted(rows, key=lambda r: (r[1] is not None, r[1])):
        last, total = state.get(k, (None, 0))
        state[k] = (v if v is not None else last, total + f)
        want[(k, o)] = state[k]
    return want


@pytest.mark.parametrize("cut", [{"width": 1}, {"width": 333}, {"rows": 1}, {"rows": 37}, {"rows": 399}, {"rows": 10_000}])
def test_running_values_do_not_depend_on_blocks(spark, cut):
    rows = _rows() + [(None, i * 11, "z" if i % 9 == 0 else None, i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, o bigint, v string, f int").repartition(7)
    got = scale.in_blocks(df, ["k"], "o", fills={"fill": F.col("v")}, sums={"total": F.col("f")}, mins={"least": F.col("v")}, **cut)
    got = {(r.k, r.o): (r.fill, r.total) for r in got.collect()}
    assert got == _expected(rows)


def test_sparse_numbers_of_one_key_cross_ranges_in_few_rows(spark):
    n = 100_000
    df = spark.range(n).select(F.lit("one").alias("k"), (F.col("id") * 1_000_000 - 7).alias("o"), F.when(F.col("id") % 1_000 == 0, F.col("id")).alias("v"))
    ranged = df.withColumn("_block", scale.range_of(df, "o", rows=1_000))
    sizes = [r["count"] for r in ranged.groupBy("_block").count().collect()]
    assert 50 <= len(sizes) <= 200 and max(sizes) <= 3_000
    carried = scale.carry(ranged.withColumn("_v_f", F.col("v")), ["k"], "o", {"f": F.col("v")}, {}, {})
    assert carried.count() == len(sizes)
    out = scale.in_blocks(df, ["k"], "o", fills={"f": F.col("v")}, sums={"s": F.lit(1)}, rows=1_000)
    assert out.where("f <> floor((o + 7) / 1000000 / 1000) * 1000 OR s <> (o + 7) / 1000000 + 1").count() == 0 and out.count() == n


def test_ranges_follow_rows_not_values(spark):
    # Half of the rows share a handful of values, the others are far apart.
    df = spark.range(40_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 20).otherwise(F.col("id") ** 2 * 1_000).cast("bigint").alias("o"))
    sizes = sorted(r["count"] for r in df.groupBy(scale.range_of(df, "o", rows=500)).count().collect())
    assert sizes[-1] <= 20_500 and sizes[len(sizes) // 2] <= 1_500 and len(sizes) >= 30
    assert scale.range_of(df.where("false"), "o") is None and scale.range_of(df, "o", rows=40_000) is None


def test_rank_in_blocks(spark):
    df = spark.createDataFrame(_rows(), "k string, o bigint, v string, f int")
    got = scale.rank_in_blocks(df, ["k"], "o", "n", rows=50)
    for key in ("hot", "a"):
        assert [r.n for r in got.where(F.col("k") == key).orderBy("o").collect()] == list(range(1, df.where(F.col("k") == key).count() + 1))


def test_dense_index_is_dense_and_stable(spark):
    values = spark.createDataFrame([(f"v{i % 700}", i % 7 if i % 5 else None) for i in range(3000)], "a string, b int")
    n = values.distinct().count()
    ids = lambda df, rows: {(r.a, r.b): r.id for r in scale.dense_index(df, ["a", "b"], "id", rows).collect()}
    first = ids(values, n // 2 + 1)
    assert sorted(first.values()) == list(range(n))
    # Two buckets, two hundred, one.
    assert first == ids(values.repartition(13), n // 200) == ids(values, 10 * n)
    assert scale.dense_index(values.where("false"), ["a", "b"], "id").count() == 0


def test_buckets_of_dense_ids_grow_in_number_not_in_size(spark):
    for n in (4_000, 40_000):
        sizes = scale.digest_buckets(spark.range(n), ["id"], 500).groupBy("_bucket").count()
        assert sizes.agg(F.max("count")).first()[0] < 650


def test_shifts_are_sums_before(spark):
    counts = [(i, (i * 37) % 11) for i in range(0, 500, 3)]
    got = {r.b: r.s for r in scale.shifts(spark.createDataFrame(counts, "b bigint, n bigint"), "b", "n", "s", group=16).collect()}
    assert got == {b: sum(n for c, n in counts if c < b) for b, _ in counts}


def test_null_keys_survive_spread_joins(spark):
    left = spark.createDataFrame([(None, i) for i in range(100)] + [("a", 1), ("b", 2)], "k string, n int")
    right = spark.createDataFrame([("a", "A")], "k string, name string")
    assert scale.join_spreading_nulls(left, right, ["k"]).where(F.col("k").isNull()).count() == 100
    assert ledger.only_in(left, right, "k").count() == 101
    joined = scale.join_null_safe(left, spark.createDataFrame([(None, "none"), ("a", "A")], "k string, name string"), ["k"])
    assert joined.where(F.col("name") == "none").count() == 100


def test_large_groups_explode_in_chunks(spark):
    groups = spark.createDataFrame([("big", 25_003), ("one", 1), ("zero", 0)], "k string, n bigint")
    pieces = ledger.explode_pieces(groups, "n", ["k"], chunk=1000)
    got = {r.k: (r.c, r.d, r.m) for r in pieces.groupBy("k").agg(F.count("*").alias("c"), F.countDistinct("piece_id").alias("d"), F.max("seq").alias("m")).collect()}
    assert got == {"big": (25_003, 25_003, 25_002), "one": (1, 1, 0)}
    ledger.require_unique(pieces, "piece_id")
    with pytest.raises(ValueError):
        ledger.require_unique(groups.unionAll(groups), "k")


def test_overlap_counts_add_up(spark):
    erp = spark.createDataFrame([("a", 2020), ("a", 2021), (None, 2020), ("b", 2010)], "job_code string, year int")
    dispatch = spark.createDataFrame([("a", 2020), ("c", 2020), ("c", 2022), (None, 2021)], "job_code string, year int")
    only = ledger.only_in(dispatch, erp, "job_code").count()
    assert only == 3  # both c pieces and the one without a job
    assert ledger.apply_overlap(erp, dispatch, "union").count() == erp.count() + only
    assert ledger.apply_overlap(erp, dispatch, "erp").count() == 4
    assert ledger.apply_overlap(erp, dispatch, "dispatch").count() == 5
    with pytest.raises(ValueError):
        ledger.apply_overlap(erp, dispatch, "both")


def test_spread_joins_keep_the_salt_among_the_join_keys(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = spark.createDataFrame([(None, i) for i in range(100)] + [("a", 1)], "k string, n int")
        right = spark.createDataFrame([("a", "A"), (None, "x")], "k string, name string")
        for joined in (scale.join_spreading_nulls(left, right, ["k"]), ledger.only_in(left, right, "k")):
            plan = joined._jdf.queryExecution().toString()
            assert "hashpartitioning(k#" in plan and ", _salt#" in plan.split("hashpartitioning(k#")[1].split(")")[0]
            assert joined.where(F.col("k").isNull()).count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_kept_tables_of_dead_drivers_are_swept(spark, tmp_path):
    folder = checkpoint_dir(spark)
    kept = reliable_checkpoint(spark.range(5))
    spark.range(3).write.parquet(f"{folder}/kept-dead-1/x")
    assert sweep_kept(spark, 1) == 0
    assert sweep_kept(spark, -1) == 1 and kept.count() == 5


def test_short_keys_are_not_cut_into_ranges(spark):
    """Many keys of few rows: as many summaries as rows would be joined, and small when compressed, be sent to the driver."""
    df = spark.range(30_000).select(F.floor(F.col("id") / 12).alias("k"), (F.col("id") % 12).alias("o"))
    every = lambda part: scale.in_blocks(part, ["k"], "o", mins={"m": F.when(F.col("o") > 3, F.col("o"))}, sums={"s": F.lit(1)}, rows=1_000)
    got = every(df)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.count() == 30_000 and got.where("s <> o + 1 OR NOT m <=> if(o > 3, 4, null)").count() == 0
    # One long key among them: only its rows, and those in its bucket, meet summaries.
    hot = df.unionByName(spark.range(5_000).select(F.lit(-1).cast("bigint").alias("k"), F.col("id").alias("o")))
    short, long = scale.by_length(hot, ["k"], 1_000)
    assert 5_000 <= long.count() <= 6_000 and short.count() + long.count() == 35_000 and long.where("k = -1").count() == 5_000
    got = every(hot)
    assert got.count() == 35_000 and got.where("s <> o + 1 OR NOT m <=> if(o > 3, 4, null)").count() == 0
