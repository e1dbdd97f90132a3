"""Reports, review lists and dashboard queries (A08, A09, A13, A30, A33, A34, J21, J22, L*, V*, D*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.classify import document_depth
from plumbline.functions.clean import blank_to_null, is_blank, is_county
from plumbline.session import reliable_checkpoint

from . import resolve
from .ledger import only_in
from .resolve import settle
from .scale import first_per_key, join_spreading_nulls, share
from .snapshots import upsert


# ---------------------------------------------------------------- class counts

def class_pivot(pieces: DataFrame, key: Column, name: str, cls: str = "structure_class", classes: list[str] | None = None) -> DataFrame:
    """Pieces per key and class with their total, largest first."""
    classes = classes or K.CLASSES
    counted = pieces.groupBy(F.coalesce(key.cast("string"), F.lit("?")).alias(name)).agg(
        *[F.count_if(F.col(cls) == c).alias(c.replace("-", "_")) for c in classes], F.count("*").alias("total"))
    return counted.orderBy(F.desc("total"), name)


def class_totals(pieces: DataFrame, cls: str = "structure_class") -> DataFrame:
    """Pieces per class and in all."""
    return pieces.rollup(cls).agg(F.count("*").alias("pieces")).select(
        F.coalesce(F.col(cls), F.lit("TOTAL")).alias("class"), "pieces")


def with_dimension(rows: DataFrame, dimension: DataFrame, key: str, value: str) -> DataFrame:
    """A value looked up by key, '?' where there is none."""
    return join_spreading_nulls(rows, dimension.select(key, value), [key], "left").withColumn(value, F.coalesce(value, F.lit("?")))


# ---------------------------------------------------------------- completeness

def completeness(bom: DataFrame, shipped: DataFrame, job: str, structure: str, document: str, cls: str) -> DataFrame:
    """Per structure the best document depth, class counts and what to do next.

    Jobs that shipped without any structure on file follow as rows of their own.
    """
    rows = bom.where(F.col(job).isNotNull() & ~is_blank(structure))
    best = rows.groupBy(job, structure).agg(
        F.max(document_depth(document)).alias("d"), F.count_if(F.col(cls) == "base").alias("base"),
        F.count_if(F.col(cls) == "non-base").alias("non_base"), F.count_if(F.col(cls) == "rehab").alias("rehab"),
        F.count("*").alias("bom_part_count"))
    jobs = shipped.select(job).where(F.col(job).isNotNull()).distinct()
    flagged = best.join(jobs.withColumn("_s", F.lit("Y")), job, "left")
    detailed = F.col("d.tier").isin("DIAGRAM", "PER_STRUCTURE_BOM")
    action = (
        F.when(detailed & (F.col("base") == 0) & (F.col("rehab") == 0), "no base in BOM - verify (rehab or missing base?)")
        .when(detailed, "complete detail on file")
        .otherwise("summary only - pull BOM by Structure / Shop Drawing from job release folder")
    )
    yes = lambda c: F.when(c, "Y").otherwise("")
    listed = flagged.select(
        job, structure, F.col("d.tier").alias("data_depth"), yes(F.col("base") > 0).alias("has_base"),
        yes(F.col("non_base") > 0).alias("has_nonbase"), "bom_part_count", F.coalesce("_s", F.lit("")).alias("shipped_in_job"),
        action.alias("next_action"))
    lonely = only_in(jobs, rows, job).select(
        job, F.lit("(no structure detail)").alias(structure), F.lit("SHIPPING_ONLY").alias("data_depth"), F.lit("").alias("has_base"),
        F.lit("").alias("has_nonbase"), F.lit(0).cast("bigint").alias("bom_part_count"), F.lit("Y").alias("shipped_in_job"),
        F.lit("shipped but no BOM/diagram found - pull BOM by Structure / Shop Drawing").alias("next_action"))
    return listed.unionByName(lonely)


# ---------------------------------------------------------------- provenance and review

def provenance(winners: DataFrame) -> DataFrame:
    """Sources and conflicts per entity, from the winners of ``vote_with_sources`` alone."""
    found = winners.groupBy("entity_key").agg(resolve.sources_of().alias("sources"), F.count_if(F.col("status") == "CONFLICT").alias("conflicts"))
    return found.withColumn("n_sources", F.when(F.col("sources") == "", 0).otherwise(F.size(F.split("sources", ","))))


def observed_values(observations: DataFrame) -> DataFrame:
    """Every observed value, one row each, shown as ``value [source·t0.00·n]``.

    The grain is the observation at every size; a reader orders a field's rows by trust, pieces, value, source.
    """
    shown = F.format_string("%s [%s·t%.2f·n%d]", F.col("value_norm"), F.col("source"), F.col("trust"), F.col("n_pieces"))
    return observations.select("entity_key", "field", "trust", "n_pieces", F.col("value_norm").alias("value"), "source", shown.alias("shown"))


def source_matrix(observations: DataFrame, fields: list[str], sources: list[str]) -> DataFrame:
    """Each source's best value of each field, side by side per entity, in one aggregation."""
    kept = observations.where(F.col("field").isin(fields) & F.col("source").isin(sources))
    entry = F.struct((-F.col("trust")).alias("t"), (-F.col("n_pieces")).alias("n"), F.col("value_norm").alias("v"))
    best = lambda s, f: F.min(F.when((F.col("field") == f) & (F.col("source") == s), entry))["v"]
    return kept.groupBy("entity_key").agg(*[best(s, f).alias(f"{s}_{f}") for s in sources for f in fields])


def winners_wide(winners: DataFrame, fields: list[str]) -> DataFrame:
    """Winner and status of each field side by side, GAP where a field has none."""
    at = lambda f, c: F.max(F.when(F.col("field") == f, F.col(c)))
    return winners.groupBy("entity_key").agg(
        *[at(f, "winner").alias(f"confirmed_{f}") for f in fields],
        *[F.coalesce(at(f, "status"), F.lit("GAP")).alias(f"{f}_status") for f in fields])


def location_matrix(observations: DataFrame, winners: DataFrame, zip_places: DataFrame, fields: list[str], sources: list[str]) -> DataFrame:
    """One wide row per entity - statuses, winners, the zip's own place, every source's values."""
    wide = winners_wide(winners, [*fields, "zip", "project_name"]).drop("zip_status", "project_name_status")
    matrix = source_matrix(observations, fields, sources)
    located = observations.where(F.col("field").isin(*fields, "zip")).select("entity_key").distinct()
    street = first_per_key(observations.where(F.col("field") == "street_address"), ["entity_key"], [F.desc("trust"), F.desc("n_pieces"), F.asc("value_norm")])
    places = zip_places.select(F.col("zip").alias("confirmed_zip"), F.col("city").alias("zip_city"), F.col("county").alias("zip_county"))
    joined = (
        located.join(wide, "entity_key", "left").join(matrix, "entity_key", "left")
        .join(street.select("entity_key", F.col("value_norm").alias("street_address")), "entity_key", "left"))
    return join_spreading_nulls(joined, places, ["confirmed_zip"])


def review_list(winners: DataFrame, observations: DataFrame, confirmed: DataFrame, field: str, statuses: list[str], sources: list[str],
                names: DataFrame | None = None) -> DataFrame:
    """What a person should look at for one field, one row per entity at every size.

    Every source's best value stands beside it, and the number of its rows in ``observed_values``.
    """
    open_rows = winners.where((F.col("field") == field) & F.col("status").isin(statuses))
    open_rows = open_rows.join(confirmed.select("entity_key", "field"), ["entity_key", "field"], "left_anti")
    matrix = source_matrix(observations.where(F.col("field") == field), [field], sources)
    counts = observations.where(F.col("field") == field).groupBy("entity_key").agg(F.count("*").alias("n_observed"))
    listed = open_rows.join(matrix, "entity_key", "left").join(counts, "entity_key", "left")
    listed = listed.withColumn("n_observed", F.coalesce("n_observed", F.lit(0).cast("bigint")))
    if names is not None:
        listed = listed.join(names.select("entity_key", "project_name"), "entity_key", "left")
    return listed


def city_extras(rows: DataFrame, observations: DataFrame, zip_places: DataFrame, winners: DataFrame, raw_source: str) -> DataFrame:
    """The raw text behind a city, the county of the winning zip, and a flag for counties."""
    raw = first_per_key(observations.where((F.col("field") == "city") & (F.col("source") == raw_source)), ["entity_key"], [F.asc("first_row")])
    zips = winners.where(F.col("field") == "zip").select("entity_key", F.col("winner").alias("zip"))
    joined = rows.join(raw.select("entity_key", F.col("value_raw").alias("raw_bom")), "entity_key", "left").join(zips, "entity_key", "left")
    return (
        join_spreading_nulls(joined, zip_places.select("zip", F.col("county").alias("zip_county")), ["zip"]).drop("zip")
        .withColumn("county_flag", F.when(is_county("winner"), F.col("winner")).otherwise("")))


def zip_check(zips: DataFrame, zip_places: DataFrame) -> DataFrame:
    """Does the winning zip fit the winning city and state? Needs zip, confirmed_city, confirmed_state."""
    places = zip_places.select("zip", F.col("city").alias("geo_city"), F.col("state").alias("geo_state"))
    verdict = (
        F.when(F.col("geo_city").isNull(), "UNKNOWN_ZIP")
        .when(~F.col("geo_state").eqNullSafe(F.col("confirmed_state")), "STATE_MISMATCH")
        .when(F.col("confirmed_city").isNotNull() & (F.col("geo_city") != F.col("confirmed_city")), "CITY_MISMATCH")
        .otherwise("✓")
    )
    return join_spreading_nulls(zips, places, ["zip"]).withColumn("zip_ok", verdict)


def ranked_conflicts(winners: DataFrame, confirmed: DataFrame, leave_out: list[str]) -> DataFrame:
    """Open conflicts, the ones with most competing values first."""
    rows = winners.where((F.col("status") == "CONFLICT") & ~F.col("field").isin(leave_out))
    rows = rows.join(confirmed.select("entity_key", "field"), ["entity_key", "field"], "left_anti")
    return rows.orderBy(F.desc("n_values"), "field", "entity_key")


def confirmations(review: DataFrame, value: str) -> DataFrame:
    """The rows a person filled in."""
    return review.where(F.trim(value) != "").select(
        F.trim("entity_key").alias("entity_key"), F.trim("field").alias("field"), F.trim(value).alias("chosen_value"))


def corrections_log(confirmed: DataFrame, winners: DataFrame) -> DataFrame:
    """The value before and after each confirmation."""
    old = winners.select("entity_key", "field", F.col("winner").alias("old_value"))
    return confirmed.join(old, ["entity_key", "field"], "left").withColumnRenamed("chosen_value", "new_value")


def apply_corrections(review: DataFrame, value: str, resolutions: DataFrame, winners: DataFrame, stamp: Column, top_source: dict[str, str],
                      extras: DataFrame, pieces: DataFrame, fields: list[str], review_fields: list[str]) -> dict[str, DataFrame]:
    """A filled-in review list taken over in one step, and everything that stands on it built again.

    Confirmations are upserted into ``resolutions`` (entity_key, field, chosen_value, stamp) and kept; the
    log holds each new value with the one it replaces. From the kept resolutions follow the settled values,
    the registry (``extras`` by entity_key), the ledger - ``pieces`` (entity_key, ...) with their entity's settled
    values - and the reports: what is still open of each review field, and how many rows each list has.
    ``winners`` are those of ``vote_with_sources``.
    """
    given = confirmations(review, value)
    kept, settled = settle_corrections(review, value, resolutions, winners, stamp, top_source)
    before = settle(winners, resolutions, top_source)
    registry = reliable_checkpoint(resolve.registry_of(settled, extras, fields, review_fields))
    ledger = pieces.join(registry.select("entity_key", *fields, "needs_review"), "entity_key", "left")
    unsettled = settled.where(F.col("status").isin("CONFLICT", "GAP") & F.col("field").isin(review_fields))
    return {
        "resolutions": kept, "settled": settled, "registry": registry, "ledger": ledger, "open": unsettled,
        "log": corrections_log(given, before.drop("winner").withColumnRenamed("value", "winner")),
        "index": status_counts(settled, fields, "CONFLICT"),
    }


def settle_corrections(review: DataFrame, value: str, resolutions: DataFrame, winners: DataFrame, stamp: Column, top_source: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """V04, the first step: the resolutions with those of a review list taken over, and the values settled by them, both kept."""
    given = confirmations(review, value)
    kept = reliable_checkpoint(upsert(resolutions, given.withColumn("stamp", stamp), ["entity_key", "field"], "chosen_value", "stamp"))
    return kept, reliable_checkpoint(settle(winners, kept, top_source))


def auto_filled_types(pieces: DataFrame, part_type: str, cls: str = "structure_class") -> DataFrame:
    """Pieces without a written type whose class the number still tells."""
    return pieces.where(is_blank(part_type) & (F.col(cls) != "unknown"))


def conflict_report(records: DataFrame, resolution: str, hand: str, value: str, key: str) -> DataFrame:
    """Unsettled records and those whose hand-entered value differs, most severe first."""
    differs = F.coalesce(blank_to_null(hand) != blank_to_null(value), F.lit(False))
    rows = records.where(F.col(resolution).isin("CONFLICT", "CONSENSUS_OVERRIDE") | differs)
    return rows.withColumn("severity", severity(resolution)).orderBy("severity", key)


def severity(resolution: str) -> Column:
    """L03."""
    return F.when(F.col(resolution) == "CONFLICT", 0).when(F.col(resolution) == "CONSENSUS_OVERRIDE", 1).otherwise(2)


def problem_list(records: DataFrame, resolution: str, source: str, key: str) -> DataFrame:
    """Records to verify, with the number of sources behind the value and what to do."""
    rows = records.where(F.col(resolution).isin("CONFLICT", "CONSENSUS_OVERRIDE"))
    sources = F.filter(F.split(F.coalesce(source, F.lit("")), r"\+"), lambda s: F.trim(s) != "")
    action = F.when(F.col(resolution) == "CONSENSUS_OVERRIDE", "Verify: BOM value differs from 3-source consensus").otherwise(
        "Verify: sources disagree, no clear consensus")
    return rows.withColumns({"independent_sources": F.size(sources), "action": action}).orderBy(severity(resolution), key)


def status_counts(winners: DataFrame, fields: list[str], status: str) -> DataFrame:
    """Rows of each field's review list, in one aggregation; a field without any shows 0."""
    counts = winners.agg(*[F.count_if((F.col("field") == f) & (F.col("status") == status)).alias(f) for f in fields])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(f).alias("list"), F.col(f).alias("rows")) for f in fields])))


def index_counts(named: dict[str, DataFrame]) -> DataFrame:
    """How many rows each list has."""
    counted = [df.agg(F.lit(name).alias("list"), F.count("*").alias("rows")).select("list", "rows") for name, df in named.items()]
    return reduce(lambda a, b: a.unionByName(b), counted)


# ---------------------------------------------------------------- dashboard

def filter_map(counts: DataFrame, text: str | None = None, text_columns: list[str] | None = None, years: tuple[int, int] | None = None,
               states: list[str] | None = None, plants: list[str] | None = None, precisions: list[int] | None = None) -> DataFrame:
    """The map's filters; each one is optional and reaches the scan as a plain predicate."""
    out = counts
    if text:
        hit = reduce(lambda a, b: a | b, [F.lower(c).contains(text.lower()) for c in text_columns or []])
        out = out.where(hit)
    if years:
        out = out.where(F.col("year").between(*years))
    for column, allowed in (("state", states), ("plant", plants), ("prec", precisions)):
        if allowed:
            out = out.where(F.col(column).isin(allowed))
    return out


def kpis(counts: DataFrame, qty: str, state: str, job: str) -> DataFrame:
    """Total, states, jobs, and the state with the most pieces."""
    by_state = counts.groupBy(state).agg(F.sum(qty).alias("q"))
    top = by_state.where(F.col(state).isNotNull()).agg(
        F.min(F.struct((-F.col("q")).alias("q"), F.col(state).alias("s"))).alias("m"), F.count("*").alias("states"))
    jobs = counts.agg(F.sum(qty).alias("total"), F.countDistinct(job).alias("jobs"))
    return jobs.withColumns({"states": top.select("states").scalar(), "top_state": top.select("m.s").scalar()})


def year_to_date(counts: DataFrame, qty: str, year: str, month: str, upto: int) -> DataFrame:
    """Each year's total up to a month against the year before; one row per calendar year."""
    by_year = counts.groupBy(year).agg(F.coalesce(F.sum(F.when(F.col(month) <= upto, F.col(qty))), F.lit(0)).alias("ytd"))
    before = F.lag("ytd").over(Window.orderBy(year))
    return by_year.withColumn("prior", before).withColumn("growth", F.round((F.col("ytd") - F.col("prior")) / F.nullif("prior", F.lit(0)), 4))


def mix(counts: DataFrame, key: str, qty: str) -> DataFrame:
    """Amount per key and its share of the total."""
    return share(counts.groupBy(key).agg(F.sum(qty).alias("qty")), "qty", "share")


def top_keys(counts: DataFrame, key: str, qty: str, n: int) -> DataFrame:
    """The ``n`` largest keys."""
    return counts.groupBy(key).agg(F.sum(qty).alias("qty")).orderBy(F.desc("qty"), key).limit(n)


def cumulative(counts: DataFrame, year: str, qty: str) -> DataFrame:
    """Running total by year; the window runs over one row per calendar year."""
    by_year = counts.groupBy(year).agg(F.sum(qty).alias("qty"))
    so_far = Window.orderBy(year).rowsBetween(Window.unboundedPreceding, 0)
    return by_year.withColumn("cumulative", F.sum("qty").over(so_far))


def flows(counts: DataFrame, origin: str, destination: str, qty: str) -> DataFrame:
    """Amount per plant and destination."""
    return counts.groupBy(origin, destination).agg(F.sum(qty).alias("qty"))

