"""The pieces ledger: cross-system dedup, one row per piece, overlap policy, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import composite_id

from .scale import first_filled, join_spreading_nulls, joined_set, spread

CHUNK = 10_000


def system_quantities(lines: DataFrame, keys: list[str], system: str, qty: Column, meta: list[str], row_no: str) -> DataFrame:
    """Quantity per key and system, with the first row's other columns.

    Rows of several feeds are stacked before this; zero quantities are not pieces.
    """
    counted = lines.withColumn("_qty", qty).where(F.col("_qty") != 0)
    return counted.groupBy(*keys, system).agg(
        F.sum("_qty").alias("qty"),
        F.min_by(F.struct(*meta), F.col(row_no)).alias("meta") if meta else F.lit(None).alias("meta"),
        F.min(row_no).alias("first_row"),
    )


def stack_feeds(feeds: list[DataFrame], row_no: str) -> DataFrame:
    """Feeds one under another; ``row_no`` orders the rows of an earlier feed before those of a later one.

    With ``system_quantities`` on top, a second feed adds to the first one's sums, and the first one's
    metadata stays.
    """
    numbered = [f.withColumn(row_no, F.struct(F.lit(i).alias("feed"), F.col(row_no).alias("row"))) for i, f in enumerate(feeds)]
    return reduce(lambda a, b: a.unionByName(b), numbered)


def dedup_systems(quantities: DataFrame, keys: list[str], system: str) -> DataFrame:
    """The same piece kept in several systems counts once - the largest system count stands."""
    return quantities.groupBy(*keys).agg(
        F.max("qty").alias("n_pieces"),
        joined_set(system, "+").alias("source"),
        F.sum("qty").alias("raw_pieces"),
        F.min_by("meta", "first_row").alias("meta"),
    )


def explode_pieces(groups: DataFrame, n: str, id_parts: list[str], chunk: int = CHUNK) -> DataFrame:
    """One row per piece with its sequence and id.

    A group is cut into chunks first and the chunks are spread over the cluster, so a group of any
    size never becomes one array or one task.
    """
    steps = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(n) - 1) / chunk).cast("bigint"))
    chunked = groups.where(F.col(n) > 0).withColumn("_chunk", F.explode(steps))
    first = F.col("_chunk") * chunk
    last = F.least(F.col(n).cast("bigint"), first + chunk) - 1
    pieces = spread(chunked, *id_parts, "_chunk").withColumn("seq", F.explode(F.sequence(first, last))).drop("_chunk")
    return pieces.withColumn("piece_id", composite_id(F.lit("erp"), *id_parts, "seq", sep=":"))


def apply_overlap(erp: DataFrame, dispatch: DataFrame, policy: str, job: str = "job_code", year: str = "year",
                  years: tuple[int, int] = (2019, 2025)) -> DataFrame:
    """Which system's pieces count where both record them.

    ``erp`` keeps that system alone; ``dispatch`` takes its years from dispatch; ``union`` adds the
    pieces of jobs that only dispatch knows, pieces without a job included.
    """
    if policy == "erp":
        return erp
    if policy == "dispatch":
        outside = ~F.coalesce(F.col(year).between(*years), F.lit(False))
        return dispatch.unionByName(erp.where(outside), allowMissingColumns=True)
    if policy != "union":
        raise ValueError(f"unknown overlap policy {policy!r}")
    return erp.unionByName(only_in(dispatch, erp, job), allowMissingColumns=True)


def only_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows whose key the other side never has; rows without a key stay."""
    known = right.select(key).where(F.col(key).isNotNull()).distinct()
    return join_spreading_nulls(left, known, [key], "left_anti")


def with_location(pieces: DataFrame, registry: DataFrame, job: str, fields: list[str]) -> DataFrame:
    """The registry's place where it has one, else the piece's own."""
    named = registry.select(job, *[F.col(f).alias(f"_r_{f}") for f in fields])
    joined = join_spreading_nulls(pieces, named, [job], "left")
    return joined.withColumns({f: F.coalesce(f"_r_{f}", f) for f in fields}).drop(*[f"_r_{f}" for f in fields])


def _sides(dispatch: DataFrame, erp: DataFrame, columns: list[str]) -> DataFrame:
    """Both systems' pieces, counted per ``columns`` before anything else happens."""
    tagged = dispatch.select(*columns, F.lit(1).alias("d"), F.lit(0).alias("e")).unionByName(
        erp.select(*columns, F.lit(0).alias("d"), F.lit(1).alias("e"))
    )
    return tagged.groupBy(*columns).agg(F.sum("d").alias("d"), F.sum("e").alias("e"))


def reconcile_by_year(dispatch: DataFrame, erp: DataFrame, years: tuple[int, int], job: str = "job_code", year: str = "year") -> DataFrame:
    """Pieces and job sets of both systems by year, with a TOTAL row."""
    span = F.col(year).between(*years)
    per_job = _sides(dispatch.where(span), erp.where(span), [year, job])
    in_d, in_e = F.col("d") > 0, F.col("e") > 0
    by_year = per_job.rollup(year).agg(
        F.sum("d").alias("dispatch_pieces"), F.sum("e").alias("erp_pieces"),
        (F.sum("d") - F.sum("e")).alias("diff"),
        F.count_if(in_d & ~in_e).alias("jobs_dispatch_only"),
        F.count_if(in_e & ~in_d).alias("jobs_erp_only"),
        F.count_if(in_d & in_e).alias("jobs_both"),
    )
    jobs = ["jobs_dispatch_only", "jobs_erp_only", "jobs_both"]
    return by_year.where(F.col("dispatch_pieces").isNotNull()).withColumns({
        **{c: F.when(F.col(year).isNotNull(), F.col(c)) for c in jobs},
        year: F.coalesce(F.col(year).cast("string"), F.lit("TOTAL")),
    })


def reconcile_by_job(dispatch: DataFrame, erp: DataFrame, years: tuple[int, int], job: str = "job_code", year: str = "year") -> DataFrame:
    """Pieces of both systems by job and where the job is present, rows without a job last."""
    span = F.col(year).between(*years)
    counted = _sides(dispatch.where(span).select(job), erp.where(span).select(job), [job])
    where = (
        F.when((F.col("d") > 0) & (F.col("e") > 0), "both")
        .when(F.col("d") > 0, "dispatch_only").otherwise("erp_only")
    )
    return counted.select(
        job, F.col("d").alias("dispatch_pieces"), F.col("e").alias("erp_pieces"),
        (F.col("d") - F.col("e")).alias("diff"), where.alias("present_in"),
    ).orderBy(F.asc_nulls_last(job))


def unshipped(released: DataFrame, shipped: DataFrame, job: str, structure: str, year: str, document: str, row_no: str,
              first: list[str], quote_documents: list[str]) -> DataFrame:
    """Released jobs without any shipped piece; quotes and drawings alone are told apart."""
    rows = only_in(released.where(F.col(job).isNotNull()), shipped, job)
    quoted = F.coalesce(F.bool_and(F.col(document).isin(quote_documents)), F.lit(False))
    return rows.groupBy(job).agg(
        *[first_filled(c, row_no).alias(c) for c in first],
        joined_set(F.col(year).cast("string")).alias("years"),
        F.countDistinct(structure).alias("structures"),
        joined_set(document).alias("documents"),
        F.when(quoted, "quote/drawing only").otherwise("released, no shipment").alias("note"),
    )


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Q01: ids that occur more than once."""
    return df.groupBy(key).count().where(F.col("count") > 1)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Q01 as a guard: fails the job when an id occurs twice."""
    found = duplicates(df, key).take(1)
    if found:
        raise ValueError(f"duplicate {key}: {found[0][0]}")
    return df
