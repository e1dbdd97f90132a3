"""Observations, trust, vote and precedence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.clean import as_col, blank_to_null, composite_id, lookup

from .scale import first_per_key, joined_set, literal_rows, rank_in_blocks

OBSERVATION = ["entity_key", "field", "source", "value_norm"]


# ---------------------------------------------------------------- observations

def melt(df: DataFrame, entity: str, source: Column | str, fields: dict[str, tuple[Column, Column]],
         row_no: str) -> DataFrame:
    """One source as (entity, field, source, norm, raw) rows; unreadable values are left out."""
    items = [
        F.struct(F.lit(name).alias("field"), norm.cast("string").alias("norm"), raw.cast("string").alias("raw"))
        for name, (norm, raw) in fields.items()
    ]
    return _observed(df, entity, source, F.array(*items), row_no)


def melt_routed(df: DataFrame, entity: str, source: Column | str, routed: Column, row_no: str) -> DataFrame:
    """R01 for a column that already is an array of (field, norm, raw), such as a routed location."""
    return _observed(df, entity, source, routed, row_no)


def _observed(df, entity, source, items, row_no):
    tag = F.lit(source) if isinstance(source, str) else source
    out = df.select(
        F.col(entity).cast("string").alias("entity_key"), tag.alias("source"), F.col(row_no).alias("row_no"),
        F.explode(items).alias("o"),
    )
    out = out.select("entity_key", "source", "row_no", F.col("o.field").alias("field"),
                     F.col("o.norm").alias("value_norm"),
                     F.coalesce(F.col("o.raw"), F.col("o.norm")).alias("value_raw"))
    return out.where(F.col("entity_key").isNotNull() & F.col("value_norm").isNotNull())


def count_observations(melted: DataFrame) -> DataFrame:
    """How often each source reports each value, with its last raw form."""
    return melted.groupBy(*OBSERVATION).agg(
        F.count("*").alias("n_pieces"),
        F.max_by("value_raw", "row_no").alias("value_raw"),
        F.min("row_no").alias("first_row"),
    )


def with_observation_ids(observations: DataFrame) -> DataFrame:
    """Sequence of a value within its entity, field and source, and the id made of it."""
    numbered = rank_in_blocks(observations, ["entity_key", "field", "source"], "first_row", "seq")
    return numbered.withColumn("obs_id", composite_id("entity_key", "field", "source", "seq"))


# ---------------------------------------------------------------- trust

def source_alias(c) -> Column:
    """Source id of a label; other labels in lower case."""
    label = F.trim(as_col(c))
    return F.coalesce(lookup(K.SOURCE_ALIASES, F.upper(label)), F.lower(label))


def learn_trust(history: DataFrame) -> DataFrame:
    """Wins, losses and smoothed trust per (field, source).

    ``history`` has ``field, resolution, source, conflict``; a conflict lists its contenders as
    ``Label='value'; ...`` and the winning label comes first in ``source``.
    """
    settled = history.where(F.col("resolution") == "CONFLICT").select(
        "field",
        source_alias(F.substring_index("source", "+", 1)).alias("winner"),
        F.transform(F.regexp_extract_all("conflict", F.lit(r"([A-Za-z]+)\s*="), F.lit(1)), source_alias).alias("contenders"),
    ).where(F.col("winner").isNotNull() & (F.size("contenders") > 0))
    outcome = F.concat(
        F.array(F.struct(F.col("winner").alias("source"), F.lit(1).alias("won"), F.lit(0).alias("lost"))),
        F.transform(
            F.filter("contenders", lambda c: c != F.col("winner")),
            lambda c: F.struct(c.alias("source"), F.lit(0).alias("won"), F.lit(1).alias("lost")),
        ),
    )
    counted = settled.select("field", F.inline(outcome)).groupBy("field", "source").agg(
        F.sum("won").alias("wins"), F.sum("lost").alias("losses")
    )
    return counted.withColumn("trust", (F.col("wins") + 1) / (F.col("wins") + F.col("losses") + 2))


def source_ranking(trust: DataFrame, fields: list[str], default_order: list[str] | None = None) -> DataFrame:
    """(field, source, rank) - learned sources by trust, then the default order."""
    order = default_order or K.DEFAULT_SOURCE_ORDER
    spark = trust.sparkSession
    defaults = literal_rows(spark, [(f, s, i) for f in fields for i, s in enumerate(order)], "field string, source string, position int")
    both = defaults.join(trust.select("field", "source", "trust"), ["field", "source"], "full")
    # One small row set per field: sources are named systems, not data.
    listed = both.groupBy("field").agg(F.array_sort(F.collect_list(F.struct(
        F.col("trust").isNull().alias("unseen"), (-F.coalesce("trust", F.lit(0.0))).alias("loss"),
        F.when(F.col("trust").isNull(), F.col("position")).alias("position"), F.col("source"),
    ))).alias("ranked"))
    return listed.select("field", F.posexplode("ranked").alias("rank", "r")).select("field", F.col("r.source").alias("source"), "rank")


def score(trust: Column, rank: Column, resolution: Column | None = None) -> Column:
    """Trust of one observation in [0, 1], lowered by how its value was settled before."""
    base = F.coalesce(trust, F.lit(0.5) - F.lit(0.03) * rank, F.lit(0.3))
    grade = F.lit(1.0)
    if resolution is not None:
        grade = F.coalesce(lookup(K.RESOLUTION_GRADES, F.upper(resolution)), F.lit(1.0))
    return F.round(F.least(F.lit(1.0), base) * grade, 4)


def with_trust(observations: DataFrame, trust: DataFrame, ranking: DataFrame, resolution: str | None = None) -> DataFrame:
    """R05 for a whole table of observations."""
    table = ranking.join(trust.select("field", "source", F.col("trust").alias("_t")), ["field", "source"], "full")
    scored = observations.join(table, ["field", "source"], "left").withColumn(
        "trust", score(F.col("_t"), F.col("rank"), F.col(resolution) if resolution else None)
    )
    return scored.drop("_t", "rank")


def trust_report(trust: DataFrame) -> DataFrame:
    """Sources of each field, best first. Fields and sources are few by nature."""
    w = Window.partitionBy("field").orderBy(F.desc("trust"), "source")
    return trust.withColumn("rank", F.row_number().over(w)).withColumn("trust", F.round("trust", 3))


# ---------------------------------------------------------------- vote

def vote(observations: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """One row per (entity, field) with the winning value and AGREE or CONFLICT."""
    return vote_with_sources(observations, sources).drop("field_sources")


def vote_with_sources(observations: DataFrame, sources: list[str] | None = None) -> DataFrame:
    """R06 with ``field_sources``, all that say anything about the field, so that nothing has to read the observations again.

    Two partial aggregations and no window: trust adds up exactly as a whole number of ten-thousandths, the winner
    is the smallest (-trust, -pieces, value), so ties fall the same way on every run. Where the names of all sources
    are given (63 at most), a set of them is a number, and values are counted in hash tables without a sort;
    a source that is not among them is an error.
    """
    values, union, listed = _source_sets(sources)
    per_value = observations.groupBy("entity_key", "field", "value_norm").agg(
        F.sum((F.col("trust").cast("decimal(9,4)") * 10_000).cast("bigint")).alias("trust_sum"),
        F.sum("n_pieces").alias("pieces"),
        values.alias("srcs"),
    )
    best = F.min(F.struct((-F.col("trust_sum")).alias("t"), (-F.col("pieces")).alias("p"), F.col("value_norm").alias("v"), F.col("srcs").alias("s")))
    return (
        # Values differ without bound, the sets of sources behind them do not: sources are named systems.
        per_value.groupBy("entity_key", "field").agg(best.alias("b"), F.count("*").alias("n_values"), union.alias("sets"))
        .select(
            "entity_key", "field",
            F.when(F.col("n_values") > 1, "CONFLICT").otherwise("AGREE").alias("status"),
            F.col("b.v").alias("winner"), F.array_join(listed(F.col("b.s")), ",").alias("winner_sources"),
            (F.col("b.t") / F.lit(-10_000.0)).alias("winner_trust"), "n_values",
            listed(F.col("sets")).alias("field_sources"),
        )
    )


def _source_sets(sources: list[str] | None):
    """Aggregates for the set of the sources of rows and the union of such sets (``srcs``), and the names in a set, in order."""
    if sources is None:
        return F.array_sort(F.collect_set("source")), F.array_sort(F.array_distinct(F.flatten(F.collect_set("srcs")))), lambda s: s
    names = sorted(sources)
    bit = lookup({s: 1 << i for i, s in enumerate(names)}, F.col("source")).cast("bigint")
    bit = F.when(F.col("source").isNull() | bit.isNotNull(), bit).otherwise(F.raise_error(F.concat(F.lit("not among the named sources: "), F.col("source"))).cast("bigint"))
    listed = F.array(*[F.lit(s) for s in names])
    return F.bit_or(bit), F.bit_or("srcs"), lambda s: F.filter(listed, lambda _, i: F.getbit(s, i) == 1)


def sources_of(field_sources: str = "field_sources") -> Column:
    """Aggregate over the fields of an entity: the distinct sources that say anything about it."""
    return F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(field_sources)))), ",")


def best_per_source(observations: DataFrame) -> DataFrame:
    """The best value of every source of every (entity, field)."""
    order = [F.desc("trust"), F.desc("n_pieces"), F.asc("value_norm")]
    return first_per_key(observations, ["entity_key", "field", "source"], order)


def settle(winners: DataFrame, confirmed: DataFrame, top_source: dict[str, str]) -> DataFrame:
    """Overlay confirmed values and promote conflicts that the field's top source backs."""
    named = confirmed.select("entity_key", "field", "chosen_value")
    top = lookup(top_source, F.col("field"))
    backed = F.array_contains(F.split(F.coalesce("winner_sources", F.lit("")), ","), top)
    status = (
        F.when(F.col("chosen_value").isNotNull(), F.lit("CONFIRMED"))
        .when(F.col("status").isNull(), F.lit("GAP"))
        .when((F.col("status") == "CONFLICT") & backed, F.lit("RESOLVED"))
        .otherwise(F.col("status"))
    )
    joined = winners.join(named, ["entity_key", "field"], "full")
    return joined.withColumns({"status": status, "value": F.coalesce("chosen_value", "winner")}).drop("chosen_value")


def known_systems(rows: DataFrame, label: str, out: str = "system", labels: dict[str, str] | None = None) -> DataFrame:
    """rows with the id of their accounting system; rows of other systems are dropped."""
    return rows.withColumn(out, lookup(labels or K.SYSTEM_LABELS, F.col(label))).where(F.col(out).isNotNull())


def entity_sources(observations: DataFrame) -> DataFrame:
    """The distinct sources that say anything about an entity."""
    return observations.groupBy("entity_key").agg(joined_set("source").alias("sources"))


def registry(winners: DataFrame, extras: DataFrame, confirmed: DataFrame, fields: list[str],
             top_source: dict[str, str], review_fields: list[str], code_pattern: str = "[A-Z]{2,4}") -> DataFrame:
    """One row per entity - winners pivoted with their sources, supplements joined, statuses settled.

    ``winners`` are those of ``vote_with_sources``. ``extras`` is keyed by ``entity_key``; an entity stays when
    its key looks right or extras know it.
    """
    return registry_of(settle(winners, confirmed, top_source), extras, fields, review_fields, code_pattern)


def registry_of(settled: DataFrame, extras: DataFrame, fields: list[str], review_fields: list[str], code_pattern: str = "[A-Z]{2,4}") -> DataFrame:
    """R07 from values that ``settle`` has settled already."""
    wide = settled.groupBy("entity_key").agg(
        sources_of().alias("sources"),
        *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields],
        *[F.max(F.when(F.col("field") == f, F.col("status"))).alias(f"{f}_status") for f in fields],
    )
    known = extras.withColumn("_known", F.lit(True))
    joined = wide.join(known, "entity_key", "full")
    joined = joined.where(F.col("entity_key").rlike(f"^(?:{code_pattern})$") | F.col("_known"))
    statuses = {f"{f}_status": F.coalesce(f"{f}_status", F.lit("GAP")) for f in fields}
    joined = joined.withColumns(statuses)
    open_field = F.lit(False)
    for f in review_fields:
        open_field = open_field | F.col(f"{f}_status").isin("CONFLICT", "GAP")
    return joined.withColumns({
        "sources": F.coalesce("sources", F.lit("")),
        "needs_review": F.when(open_field, F.lit("Y")).otherwise(F.lit("")),
    }).drop("_known")


# ---------------------------------------------------------------- precedence

def with_precedence(df: DataFrame, values: dict[str, Column], out: str, tiers: dict[str, int] | None = None, primary: str = "BOM",
                    independent: list[str] | None = None) -> DataFrame:
    """Add struct(value, source, resolution, conflict) settled from one value per source.

    The lowest tier wins. When the primary source stands alone against one common value that at
    least three independent sources report, that value overrides it. The lists the rule looks at are
    columns of earlier projections, so each is worked out once per row.
    """
    tiers = tiers or K.SOURCE_TIERS
    independent = independent or K.INDEPENDENT_SOURCES
    ordered = sorted(values, key=lambda s: tiers.get(s, 99))
    entries = [F.struct(F.lit(s).alias("s"), blank_to_null(values[s]).alias("v")) for s in ordered]
    c = F.col
    staged = df.withColumn("_given", F.filter(F.array(*entries), lambda e: e["v"].isNotNull()))
    staged = staged.withColumn("_others", F.filter("_given", lambda e: e["s"] != primary))
    staged = staged.withColumns({
        "_n_values": F.size(F.array_distinct(F.transform("_given", lambda e: e["v"]))),
        "_other_values": F.array_distinct(F.transform("_others", lambda e: e["v"])),
        "_backers": F.size(F.filter("_others", lambda e: e["s"].isin(independent))),
        "_best": F.get("_given", F.lit(0)),
    })
    has_primary = F.size("_given") > F.size("_others")
    staged = staged.withColumn("_resolution", (
        F.when(F.size("_given") == 0, F.lit("NO_DATA"))
        .when(F.size("_given") == 1, F.lit("SINGLE_SOURCE"))
        .when(c("_n_values") == 1, F.lit("MATCH"))
        .when(has_primary & (F.size("_other_values") == 1) & (c("_backers") >= 3), F.lit("CONSENSUS_OVERRIDE"))
        .otherwise(F.lit("CONFLICT"))))
    overrides = c("_resolution") == "CONSENSUS_OVERRIDE"
    common = F.get("_other_values", F.lit(0))
    names = F.array_join(F.array_sort(F.transform("_others", lambda e: e["s"])), "+")
    quoted = lambda e: F.concat(e["s"], F.lit("='"), e["v"], F.lit("'"))
    detail = (
        F.when(overrides, F.concat(quoted(c("_best")), F.lit("; "), names, F.lit(" all say '"), common, F.lit("'")))
        .when(c("_resolution") == "CONFLICT", F.array_join(F.transform("_given", quoted), "; "))
    )
    settled = F.struct(
        F.when(overrides, common).otherwise(c("_best.v")).alias("value"),
        F.when(overrides, names).otherwise(c("_best.s")).alias("source"),
        c("_resolution").alias("resolution"), detail.alias("conflict"))
    return staged.withColumn(out, settled).drop("_given", "_others", "_n_values", "_other_values", "_backers", "_best", "_resolution")


def known_pair(plants: Column) -> Column:
    """Label of a legitimate combination of plants, NULL otherwise."""
    have = F.array_sort(F.array_distinct(plants))
    hits = [F.when(have == F.array(*[F.lit(x) for x in pair]), F.lit(label)) for label, pair in K.PLANT_PAIRS.items()]
    return F.coalesce(*hits)


def tagged_coalesce(values: dict[str, Column]) -> Column:
    """First non-blank value with the tag of where it came from."""
    clean = {tag: blank_to_null(c) for tag, c in values.items()}
    tag = F.coalesce(*[F.when(c.isNotNull(), F.lit(t)) for t, c in clean.items()])
    return F.struct(F.coalesce(*clean.values()).alias("value"), tag.alias("source"))


def merge_sources(sources: dict[str, DataFrame], key: str, fields: list[str]) -> DataFrame:
    """One row per key with ``field__source`` columns and ``in_<source>`` flags.

    All sources are stacked and reduced in one aggregation instead of a chain of full joins, so
    the keys cross the network once.
    """
    stacked = None
    for name, df in sources.items():
        cols = [F.col(f).cast("string").alias(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields]
        part = df.select(key, F.lit(name).alias("_source"), *cols)
        stacked = part if stacked is None else stacked.unionByName(part)
    held = {
        name: [f for f in fields if f in df.columns] for name, df in sources.items()
    }
    return stacked.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.max(F.when(F.col("_source") == name, F.col(f))).alias(f"{f}__{name}") for name in sources for f in held[name]],
        *[F.max((F.col("_source") == name)).alias(f"in_{name}") for name in sources],
    )


def resolution_counts(records: DataFrame, resolution: str) -> DataFrame:
    """A28."""
    names = ["MATCH", "SINGLE_SOURCE", "CONFLICT", "CONSENSUS_OVERRIDE", "NO_DATA"]
    return records.agg(*[F.count_if(F.col(resolution) == n).alias(n.lower()) for n in names])
