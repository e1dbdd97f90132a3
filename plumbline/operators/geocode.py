"""Gazetteer lookups and the geocode cascade."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.clean import city_variants

from .match import closest_text
from .scale import join_null_safe, join_spreading_nulls, literal_rows

PRECISION = {"zip": 0, "city": 1, "state": 2, "suspect": 3}


def zip_points(gazetteer: DataFrame, keep: str = "last") -> DataFrame:
    """One gazetteer row per zip, the first or the last one by ``row_no``."""
    pick = F.max_by if keep == "last" else F.min_by
    best = gazetteer.groupBy("zip").agg(pick(F.struct("city", "state", "county", "lat", "lng"), F.col("row_no")).alias("p"))
    return best.select("zip", "p.*")


def city_points(gazetteer: DataFrame) -> DataFrame:
    """Centre of every (city, state)."""
    return gazetteer.groupBy("city", "state").agg(F.avg("lat").alias("lat"), F.avg("lng").alias("lng"))


def city_states(gazetteer: DataFrame) -> DataFrame:
    """The states a city name occurs in (a small domain)."""
    return gazetteer.groupBy("city").agg(F.array_sort(F.collect_set("state")).alias("valid_states"))


def state_centroids(spark) -> DataFrame:
    rows = [(s, lat, lng) for s, (lat, lng) in K.STATE_CENTROIDS.items()]
    return literal_rows(spark, rows, "state string, lat double, lng double")


def lookup_places(triples: DataFrame, gazetteer: DataFrame, centroids: DataFrame, cutoff: float = 0.85) -> DataFrame:
    """Distinct (city, state, zip) with lat, lng and precision: zip, city, near city, state.

    Each step only sees what the step before it could not place.
    """
    asked = triples.select("city", "state", "zip").distinct()
    zips = zip_points(gazetteer, "last").select("zip", F.struct("lat", "lng").alias("_zip_point"))
    asked = join_spreading_nulls(asked, zips, ["zip"])
    cities = city_points(gazetteer)
    spelled = (
        asked.where(F.col("_zip_point").isNull() & F.col("city").isNotNull() & F.col("state").isNotNull())
        .select("city", "state").distinct().select("city", "state", F.posexplode(city_variants("city")).alias("pos", "form"))
    )
    forms = cities.select(F.col("city").alias("form"), "state", F.struct("lat", "lng").alias("point"))
    exact = spelled.join(forms, ["form", "state"]).groupBy("city", "state").agg(F.min_by("point", "pos").alias("_city_point"))
    unplaced = spelled.select("city", "state").distinct().join(exact, ["city", "state"], "left_anti")
    near = closest_text(
        unplaced.select("state", F.col("city").alias("left_text")), cities.select("state", F.col("city").alias("right_text")), ["state"], cutoff
    )
    fuzzy = near.join(forms.withColumnRenamed("form", "match"), ["match", "state"]).select(
        F.col("left_text").alias("city"), "state", F.col("point").alias("_city_point"))
    placed = join_spreading_nulls(asked, exact.unionByName(fuzzy), ["city", "state"])
    middle = centroids.select("state", F.struct("lat", "lng").alias("_state_point"))
    placed = join_spreading_nulls(placed, middle, ["state"])
    point = F.coalesce("_zip_point", "_city_point", "_state_point")
    precision = F.when(F.col("_zip_point").isNotNull(), 0).when(F.col("_city_point").isNotNull(), 1).when(F.col("_state_point").isNotNull(), 2)
    return placed.select("city", "state", "zip", F.round(point["lat"], 4).alias("lat"), F.round(point["lng"], 4).alias("lng"),
                         precision.alias("prec"))


def geocode(triples: DataFrame, gazetteer: DataFrame, centroids: DataFrame, cutoff: float = 0.85) -> DataFrame:
    """Every distinct triple placed, wrong states corrected where only one state is possible.

    Adds ``placed_state`` (the corrected state or the listed one), ``corrected``, ``suspect``,
    ``valid_states``. A zip that belongs to the listed state keeps that state. Whether a state is wrong
    does not depend on where the place is found, so it is settled first and one lookup is enough.
    """
    asked = triples.select("city", "state", "zip").distinct()
    zip_state = zip_points(gazetteer, "last").select("zip", F.col("state").alias("zip_state"))
    known = join_spreading_nulls(join_spreading_nulls(asked, city_states(gazetteer), ["city"]), zip_state, ["zip"])
    known = join_spreading_nulls(known, centroids.select("state", F.lit(True).alias("known_state")), ["state"])
    can_place = F.col("zip_state").isNotNull() | F.col("known_state")
    suspect = F.coalesce(
        can_place & F.col("state").isNotNull() & (F.size("valid_states") > 0) & ~F.array_contains("valid_states", F.col("state")), F.lit(False))
    judged = known.withColumn("suspect", suspect)
    judged = judged.withColumn("corrected", F.col("suspect") & (F.size("valid_states") == 1) & ~F.col("zip_state").eqNullSafe(F.col("state")))
    judged = judged.withColumn("placed_state", F.when(F.col("corrected"), F.get("valid_states", F.lit(0))).otherwise(F.col("state")))
    found = lookup_places(judged.select("city", F.col("placed_state").alias("state"), "zip"), gazetteer, centroids, cutoff)
    placed = join_null_safe(judged, found.withColumnRenamed("state", "placed_state"), ["city", "placed_state", "zip"])
    prec = F.when(F.col("suspect") & ~F.col("corrected"), PRECISION["suspect"]).otherwise(F.col("prec"))
    return placed.withColumn("prec", prec).select("city", "state", "zip", "placed_state", "lat", "lng", "prec", "suspect", "corrected", "valid_states")


def place_rows(rows: DataFrame, placed: DataFrame) -> DataFrame:
    """Rows with the place of their (city, state, zip); X02 location key included."""
    return join_null_safe(rows, placed, ["city", "state", "zip"]).withColumn(
        "loc_key", F.concat_ws(",", F.format_number("lat", 4), F.format_number("lng", 4)))


def anomalies(placed_rows: DataFrame, columns: list[str]) -> DataFrame:
    """Places that contradict the gazetteer and could not be corrected, with the states possible."""
    return placed_rows.where(F.col("suspect") & ~F.col("corrected")).select(
        *columns, F.array_join("valid_states", "|").alias("valid_states"))


def suspect_rows(rows: DataFrame, gazetteer: DataFrame, city: str, state: str) -> DataFrame:
    """Rows whose city is known but never in the listed state."""
    valid = city_states(gazetteer).withColumnRenamed("city", "_city")
    joined = rows.where(F.col(city).isNotNull() & F.col(state).isNotNull()).join(valid, F.upper(F.trim(city)) == F.col("_city"))
    return joined.where(~F.array_contains("valid_states", F.col(state))).drop("_city").withColumn(
        "valid_states", F.array_join("valid_states", "|"))


def precision_counts(placed_rows: DataFrame) -> DataFrame:
    """Rows by precision, unplaced ones included."""
    return placed_rows.groupBy(F.coalesce(F.col("prec").cast("string"), F.lit("unmapped")).alias("prec")).agg(F.count("*").alias("rows"))


def enrich(rows: DataFrame, records: DataFrame, key: str, fields: list[str], extra: list[str] | None = None) -> DataFrame:
    """Fill what a row lacks from the record of its key; ``filled_<field>`` marks each fill."""
    named = records.select(key, *[F.col(f).alias(f"_r_{f}") for f in fields], *(extra or []))
    joined = join_spreading_nulls(rows, named, [key], "left")
    marks = {f"filled_{f}": F.col(f).isNull() & F.col(f"_r_{f}").isNotNull() for f in fields}
    return joined.withColumns(marks).withColumns({f: F.coalesce(f, f"_r_{f}") for f in fields}).drop(*[f"_r_{f}" for f in fields])


def fill_counts(enriched: DataFrame, fields: list[str]) -> DataFrame:
    """How many rows each field was filled in."""
    return enriched.agg(*[F.count_if(F.col(f"filled_{f}")).alias(f) for f in fields])
