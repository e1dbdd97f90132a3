"""Conflict resolution on literal rows."""

import pytest
from pyspark.sql import functions as F

from plumbline.operators import report, resolve
from plumbline.operators import registry as reg


@pytest.fixture
def settle(spark):
    names = ["BOM", "Dispatch", "NetSuite", "Notion", "Shipping", "Markdown"]

    def run(*values):
        df = spark.createDataFrame([values], ", ".join(f"{n} string" for n in names))
        return tuple(resolve.with_precedence(df, {n: F.col(n) for n in names}, "r").select("r.*").first())

    return run


def test_precedence_rules(settle):
    n = None
    assert settle(n, n, n, n, n, " ") == (None, None, "NO_DATA", None)
    assert settle(n, n, n, "x", n, n) == ("x", "Notion", "SINGLE_SOURCE", None)
    assert settle(n, "x", n, n, "x", n) == ("x", "Dispatch", "MATCH", None)
    assert settle("a", "x", n, n, "x", "x") == ("x", "Dispatch+Markdown+Shipping", "CONSENSUS_OVERRIDE", "BOM='a'; Dispatch+Markdown+Shipping all say 'x'")
    # Two independent sources are not enough, and neither is a third that is not independent.
    assert settle("a", "x", "x", "x", "x", n)[0:3] == ("a", "BOM", "CONFLICT")
    # Equal tiers keep the order in which the sources are listed.
    assert settle(n, n, "q", "b", "a", n) == ("q", "NetSuite", "CONFLICT", "NetSuite='q'; Notion='b'; Shipping='a'")


def test_vote_breaks_ties_by_value_and_survives_repartition(spark):
    rows = [("A", "city", "s1", "RENO", 0.5, 2), ("A", "city", "s2", "ELKO", 0.5, 2), ("B", "city", "s1", "ELY", 0.2, 1), ("B", "city", "s2", "ELY", 0.2, 1), ("B", "city", "s3", "AUSTIN", 0.3, 9)]
    obs = spark.createDataFrame(rows, "entity_key string, field string, source string, value_norm string, trust double, n_pieces int")
    for parts in (1, 5):
        got = {r.entity_key: (r.winner, r.status, r.winner_sources, r.winner_trust) for r in resolve.vote(obs.repartition(parts)).collect()}
        assert got == {"A": ("ELKO", "CONFLICT", "s2", 0.5), "B": ("ELY", "CONFLICT", "s1,s2", 0.4)}


def test_vote_with_named_sources(spark):
    rows = [("A", "city", "s1", "RENO", 0.5, 2), ("A", "city", "s3", "ELKO", 0.3, 2), ("A", "city", "s2", "ELKO", 0.3, 2), ("A", "city", None, "ELKO", 0.1, 1), ("B", "city", None, "ELY", 0.2, 1)]
    obs = spark.createDataFrame(rows, "entity_key string, field string, source string, value_norm string, trust double, n_pieces int")
    plain, named = resolve.vote_with_sources(obs), resolve.vote_with_sources(obs, ["s3", "s1", "s2"])
    assert plain.schema.simpleString() == named.schema.simpleString() and sorted(plain.collect()) == sorted(named.collect())
    assert {r.entity_key: (r.winner, r.winner_sources, r.winner_trust, r.field_sources) for r in named.collect()} == {"A": ("ELKO", "s2,s3", 0.7, ["s1", "s2", "s3"]), "B": ("ELY", "", 0.2, [])}
    with pytest.raises(Exception, match="not among the named sources: s3"):
        resolve.vote(obs, ["s1", "s2"]).collect()


def test_trust_learning_and_ranking(spark):
    history = spark.createDataFrame([
        ("city", "CONFLICT", "BOM", "BOM='NC'; Shipping='NO'; Markdown='NC'"), ("city", "CONFLICT", "Dispatch+Shipping", "BOM = 'a'; Dispatch='b'"),
        ("city", "MATCH", "BOM", None), ("city", "CONFLICT", None, "BOM='x'")], "field string, resolution string, source string, conflict string")
    trust = resolve.learn_trust(history)
    got = {r.source: (r.wins, r.losses, round(r.trust, 4)) for r in trust.collect()}
    assert got == {"bom_union": (1, 1, 0.5), "erp_ns": (0, 1, 0.3333), "markdown": (0, 1, 0.3333), "dispatch": (1, 0, 0.6667)}
    ranks = {r.source: r["rank"] for r in resolve.source_ranking(trust, ["city"]).collect()}
    assert [s for s, _ in sorted(ranks.items(), key=lambda kv: kv[1])][:6] == ["dispatch", "bom_union", "erp_ns", "markdown", "erp_qb", "erp_fb"]
    scores = spark.createDataFrame([(0.8, 0, "CONFLICT"), (None, 4, None), (None, None, "x")], "t double, r int, g string").select(resolve.score(F.col("t"), F.col("r"), F.col("g")).alias("s"))
    assert [r.s for r in scores.collect()] == [0.56, 0.38, 0.3]


def test_a_field_of_any_size_has_one_review_row(spark):
    obs = spark.range(5_000).select(
        F.lit("A").alias("entity_key"), F.lit("city").alias("field"), F.lit("s").alias("source"), F.concat(F.lit("v"), F.col("id")).alias("value_norm"),
        (F.col("id") / 5_000).alias("trust"), F.lit(1).alias("n_pieces"))
    values = report.observed_values(obs)
    assert values.count() == 5_000
    assert values.orderBy(F.desc("trust")).first().shown == "v4999 [s·t1.00·n1]"
    winners = spark.createDataFrame([("A", "city", "v4999", "CONFLICT")], "entity_key string, field string, winner string, status string")
    none = spark.createDataFrame([], "entity_key string, field string")
    rows = report.review_list(winners, obs, none, "city", ["CONFLICT"], ["s"]).collect()
    assert [(r.winner, r.s_city, r.n_observed) for r in rows] == [("v4999", "v4999", 5_000)]


def test_code_sequence_fills_gaps(spark):
    used = spark.createDataFrame([("AAC",), ("AAA",), ("ABA",)], "code string")
    got = reg.code_sequence(used, "code").orderBy("code_no").collect()
    assert len(got) == 27 and [r.code for r in got if not r.is_placeholder] == ["AAA", "AAC", "ABA"]


def test_location_matrix_and_extras(spark):
    rows = [("A", "city", "s1", "RENO", "Reno, NV", 0.5, 1, 0), ("A", "city", "s2", "ELKO", "Elko", 0.4, 1, 1), ("A", "zip", "s1", "89501", "89501", 0.5, 1, 2), ("A", "street_address", "s1", "1 Main", "1 Main", 0.5, 1, 3),
            ("B", "city", "s2", "CLARK COUNTY", "x", 0.4, 1, 4)]
    obs = spark.createDataFrame(rows, "entity_key string, field string, source string, value_norm string, value_raw string, trust double, n_pieces int, first_row int")
    won = resolve.vote(obs)
    places = spark.createDataFrame([("89501", "RENO", "NV", "WASHOE")], "zip string, city string, state string, county string")
    matrix = {r.entity_key: r for r in report.location_matrix(obs, won, places, ["city", "state"], ["s1", "s2"]).collect()}
    assert (matrix["A"].confirmed_city, matrix["A"].city_status, matrix["A"].state_status, matrix["A"].zip_county, matrix["A"].street_address, matrix["A"].s2_city) == ("RENO", "CONFLICT", "GAP", "WASHOE", "1 Main", "ELKO")
    extras = {r.entity_key: (r.raw_bom, r.zip_county, r.county_flag) for r in report.city_extras(won.where("field = 'city'"), obs, places, won, "s1").collect()}
    assert extras == {"A": ("Reno, NV", "WASHOE", ""), "B": (None, None, "CLARK COUNTY")}
