"""Registry aggregates, key universe and row selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import blank_to_null, code_to_int, filled_count, int_to_code, leading_year

from plumbline.session import reliable_checkpoint

from .scale import dense_index, first_filled, join_null_safe, top_per_key


def registry_source(df: DataFrame, key: str, row_no: str, name: str, first: dict[str, Column] | None = None,
                    least: dict[str, Column] | None = None, sets: dict[str, Column] | None = None,
                    distinct: dict[str, Column] | None = None) -> DataFrame:
    """A14 for one source: first non-blank values, earliest values, small sets, distinct counts, rows."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[first_filled(c, row_no).alias(n) for n, c in (first or {}).items()],
        *[F.min(c).alias(n) for n, c in (least or {}).items()],
        *[F.array_sort(F.collect_set(c)).alias(n) for n, c in (sets or {}).items()],
        *[F.countDistinct(c).alias(n) for n, c in (distinct or {}).items()],
        F.count("*").alias(f"{name}_rows"),
    )


def join_registry(sources: dict[str, DataFrame], key: str, universe: DataFrame | None = None) -> DataFrame:
    """All sources side by side by key, completed with keys no source has."""
    wide = reduce(lambda a, b: a.join(b, key, "full"), sources.values())
    if universe is not None:
        wide = wide.join(universe.select(key).where(F.col(key).isNotNull()).distinct(), key, "full")
    counts = {f"{n}_rows": F.coalesce(f"{n}_rows", F.lit(0).cast("bigint")) for n in sources}
    flags = {f"in_{n}": F.col(f"{n}_rows") > 0 for n in sources}
    return wide.withColumns(counts).withColumns(flags)


def source_names(names: list[str]) -> Column:
    """The sources a registry row occurs in, as text."""
    return F.concat_ws(" + ", *[F.when(F.col(f"in_{n}"), F.lit(n)) for n in names])


def registry_summary(registry: DataFrame, first: str, second: str, third: str) -> DataFrame:
    """How many keys are in all sources, in one alone, or in none."""
    a, b, c = F.col(f"in_{first}"), F.col(f"in_{second}"), F.col(f"in_{third}")
    return registry.agg(
        F.count("*").alias("total"), F.count_if(a).alias(f"in_{first}"), F.count_if(b).alias(f"in_{second}"),
        F.count_if(c).alias(f"in_{third}"), F.count_if(a & b & c).alias("in_all"),
        F.count_if(a & ~b & ~c).alias(f"{first}_only"), F.count_if(c & ~a).alias(f"{third}_no_{first}"),
        F.count_if(~a & ~b & ~c).alias("no_source"),
    )


def modal_value(df: DataFrame, key: str, value: str, out: str = "mode") -> DataFrame:
    """The most frequent value of every key; the smaller value wins a tie."""
    counted = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key, value).count()
    best = F.min(F.struct((-F.col("count")).alias("n"), F.col(value).alias("v")))
    return counted.groupBy(key).agg(best.alias("b")).select(key, F.col("b.v").alias(out), (-F.col("b.n")).alias(f"{out}_rows"))


def order_rollup(lines: DataFrame, key: str, row_no: str, first: dict[str, Column], fulfilled: Column, item: Column,
                 amount: Column, skip_items: list[str]) -> DataFrame:
    """One row per key - first values, whether any line is fulfilled, value without totals and tax."""
    counted = F.when(~F.coalesce(F.lower(item).isin(skip_items), F.lit(False)), amount.try_cast("decimal(18,2)"))
    return lines.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[first_filled(c, row_no).alias(n) for n, c in first.items()],
        F.coalesce(F.bool_or(fulfilled), F.lit(False)).alias("fulfilled"),
        F.nullif(F.sum(counted), F.lit(0)).alias("job_value"),
    )


def fullest_row(df: DataFrame, key: str, year: str, row_no: str, columns: list[str]) -> DataFrame:
    """The row with most filled columns, then the latest year, then the earliest line."""
    rank = F.struct(filled_count(*columns).alias("f"), F.coalesce(leading_year(year), F.lit(0)).alias("y"), (-F.col(row_no)).alias("r"))
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns if c != key]), rank).alias("b"))
    return best.select(key, "b.*")


def latest_year(df: DataFrame, key: str, year: str, prefer: Column | None = None) -> DataFrame:
    """Newest record per key; with ``prefer``, newest among those that have it when any does."""
    parts = [F.col(year).alias("y")]
    if prefer is not None:
        parts.insert(0, F.coalesce(prefer, F.lit(False)).alias("p"))
    best = df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in df.columns if c != key]), F.struct(*parts)).alias("b"))
    return best.select(key, "b.*")


def code_sequence(codes: DataFrame, code: str, rows: DataFrame | None = None) -> DataFrame:
    """Every code from the first possible one to the highest used, gaps included.

    ``rows`` (one per code) is joined on; ``is_placeholder`` marks codes nothing uses. Three-letter
    codes bound the sequence at 26**3 rows.
    """
    top = codes.agg(F.max(code_to_int(code)).alias("top")).where(F.col("top").isNotNull())
    listed = top.select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("top"))).alias("code_no"))
    listed = listed.withColumn(code, int_to_code("code_no"))
    if rows is None:
        rows = codes.select(code).distinct()
    joined = listed.join(rows.withColumn("_used", F.lit(True)), code, "left")
    return joined.withColumn("is_placeholder", F.col("_used").isNull()).drop("_used")


def job_rollup(rows: DataFrame, key: Column, row_no: str, first: list[str], part: Column, year: str, top: int = 15) -> DataFrame:
    """One row per job - first attributes, its most frequent parts, first and last year."""
    keyed = rows.select(key.alias("job_key"), part.alias("_part"), F.struct(F.col(row_no).alias("_no"), *first).alias("_row"), F.col(year).alias("_year"))
    # The rows are read once, into counts per job and part; row attributes come from the first row as a whole.
    counted = reliable_checkpoint(keyed.groupBy("job_key", "_part").agg(
        F.count("*").alias("n"), F.min("_row").alias("_row"), F.min("_year").alias("first_year"), F.max("_year").alias("last_year")))
    base = counted.groupBy("job_key").agg(F.min("_row").alias("f"), F.min("first_year").alias("first_year"), F.max("last_year").alias("last_year"))
    base = base.select("job_key", *[F.col(f"f.{c}").alias(c) for c in first], "first_year", "last_year")
    counted = counted.where(F.col("_part").isNotNull()).select("job_key", "_part", "n")
    best = top_per_key(counted, ["job_key"], [F.desc("n"), F.asc("_part")], top, out="place")
    listed = best.groupBy("job_key").agg(F.array_sort(F.collect_list(F.struct("place", "_part", "n"))).alias("p")).select(
        "job_key", F.array_join(F.transform("p", lambda x: F.concat_ws(":", x["_part"], x["n"])), ",").alias("composition")
    )
    return base.join(listed, "job_key", "left")


def composite_job_key(job: str, *fallback: str) -> Column:
    """The job code, else the parts that identify a row without one."""
    return F.coalesce(blank_to_null(job), F.concat_ws("|", F.lit(""), *[F.coalesce(c, F.lit("")) for c in fallback]))


def size_histogram(rows: DataFrame, keys: list[str], size: Column) -> DataFrame:
    """Pieces per key with a histogram of sizes, '?' for unknown ones, most frequent first.

    Sizes are counted before they are listed, and their domain is small.
    """
    counted = rows.withColumn("_size", F.coalesce(size, F.lit("?"))).groupBy(*keys, "_size").agg(F.count("*").alias("n"))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col("_size").alias("s"))))
    text = F.array_join(F.transform(listed, lambda x: F.concat_ws(":", x["s"], -x["o"])), ",")
    return counted.groupBy(*keys).agg(F.sum("n").alias("qty"), text.alias("sizes"))


def encode(rows: DataFrame, columns: list[str], out: str) -> tuple[DataFrame, DataFrame]:
    """Rows with a dense id in place of the columns, and the dictionary."""
    dictionary = dense_index(rows, columns, out)
    coded = join_null_safe(rows, dictionary, columns).drop(*columns)
    return coded, dictionary


def frequency(df: DataFrame, value: str, out: str = "n") -> DataFrame:
    """How often each value occurs, most frequent first."""
    return df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias(out)).orderBy(F.desc(out), value)

