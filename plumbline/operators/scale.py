"""Building blocks that keep one hot key, or one long sequence, from landing in one task."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import reliable_checkpoint

#: Rows of a block, and the most ranges a column is cut into.
BLOCK = 65_536
RANGES = 4_096
#: Buckets by which the rows of keys are counted.
BUCKETS = 65_536
#: Rows of a key that one task may hold of one.
WHOLE = 1 << 20


def range_of(df: DataFrame, order: str, rows: int = BLOCK, most: int = RANGES) -> Column | None:
    """The number of a row's range when ``order`` is cut into ranges of about ``rows`` rows; null goes to the first.

    The bounds are quantiles, so gaps between the values make no difference, and a key that holds a third
    of all rows has about a third of every range it lies in. They are worked out once, in one aggregation,
    and are at most ``most`` numbers. None if one range is enough.
    """
    steps = [i / most for i in range(1, most)]
    value = F.col(order).cast("bigint")
    found = df.agg(F.count("*").alias("n"), F.percentile_approx(value, steps, 8 * most).alias("q")).first()
    parts = min(most, -(-found["n"] // rows))
    if parts < 2 or not found["q"]:
        return None
    bounds = sorted({found["q"][min(most - 2, i * most // parts - 1)] for i in range(1, parts)})
    listed, halves = F.lit(np.array(bounds, dtype="int64")), F.lit(np.array([1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)], dtype="int32"))
    # Binary search: how many bounds lie at or below the value.
    return F.aggregate(halves, F.lit(0), lambda low, half: F.when(F.get(listed, low + half - 1) <= value, low + half).otherwise(low))


def in_blocks(df: DataFrame, keys: list[str], order: str, *, fills: dict[str, Column] | None = None,
              sums: dict[str, Column] | None = None, mins: dict[str, Column] | None = None, width: int | None = None, rows: int = BLOCK) -> DataFrame:
    """Running values along ``order`` within ``keys``, worked out block by block.

    ``fills`` carries the last non-null value forward, ``sums`` adds up so far, ``mins`` keeps the least
    value so far (all up to and with the current row). A window over a whole long key would sort that key in one
    task; such keys are cut along ``order`` into balanced ranges of about ``rows`` rows, every key's part of a range
    is a window of its own, and only one summary row per key and range crosses ranges: a prefix scan. Keys of up to
    ``rows`` rows are one window each and have no summaries. ``order`` is a whole number unique within a key, of any
    density. Where it is known to be dense, ``width`` cuts it every so many values without looking at the rows first.
    """
    fills, sums, mins = fills or {}, sums or {}, mins or {}
    df = df.withColumns({f"_v_{n}": c for n, c in {**fills, **sums, **mins}.items()})
    if width:
        parts = [_running(df.withColumn("_block", F.floor(F.col(order) / width)), keys, order, fills, sums, mins)]
    else:
        short, long = by_length(df, keys, rows)
        parts = [_running(short, keys, order, fills, sums, mins)]
        if long is not None:
            block = range_of(long, order, rows)
            long = long if block is None else long.withColumn("_block", block)
            # The summaries of long keys are sorted, not sent whole to the driver for being small when compressed.
            parts.append(_running(long, keys, order, fills, sums, mins, "merge"))
    return reduce(DataFrame.unionByName, parts)


def by_length(df: DataFrame, keys: list[str], rows: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of keys that have no more than ``rows`` rows, and those of the others, if there are any.

    Rows are counted by the key's bucket, so what is shuffled does not grow with the keys; the few short keys that
    share a bucket with a long one are taken for long.
    """
    bucket, counts = _bucket_counts(df, keys)
    return _by_bucket(df, bucket, counts, rows)


def _bucket_counts(df: DataFrame, keys: list[str]) -> tuple[Column, DataFrame]:
    """The bucket of a row's key, and (_bucket, count), kept."""
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")
    return bucket, reliable_checkpoint(df.groupBy(bucket.alias("_bucket")).count())


def _by_bucket(df: DataFrame, bucket: Column, counts: DataFrame, rows: int) -> tuple[DataFrame, DataFrame | None]:
    crowded = counts.where(F.col("count") > rows).select("_bucket")
    if crowded.isEmpty():
        return df, None
    cut = df.withColumn("_bucket", bucket)
    return cut.join(crowded, "_bucket", "left_anti").drop("_bucket"), cut.join(crowded, "_bucket", "left_semi").drop("_bucket")


def whole_keys(df: DataFrame, key: str, rows: int | None = None) -> list[DataFrame]:
    """The rows dealt by ``key``, about ``rows`` to a task, so that all steps grouped by it and more need no further shuffle.

    Keys of more than ``rows`` rows stay out of that: they are a part of their own, as they come, whose
    aggregates are reduced ahead of each shuffle. ``key`` is a column as the later steps name it.
    """
    rows = rows or WHOLE
    bucket, counts = _bucket_counts(df, [key])
    short, long = _by_bucket(df, bucket, counts, rows)
    total = counts.agg(F.sum("count")).first()[0] or 0
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // rows))
    return [short.repartition(n, key)] + ([long] if long is not None else [])


def each_part(parts: list[DataFrame], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on parts that share no key."""
    return reduce(DataFrame.unionByName, map(work, parts))


def _running(cut: DataFrame, keys: list[str], order: str, fills, sums, mins, hint: str | None = None) -> DataFrame:
    """Running values of the columns ``_v_...`` within the keys, across the ranges of ``_block`` if there is one."""
    names, blocks = [*fills, *sums, *mins], "_block" in cut.columns
    inside = Window.partitionBy(*keys, *(["_block"] if blocks else [])).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = cut.withColumns({
        **{n: F.last(f"_v_{n}", ignorenulls=True).over(inside) for n in fills},
        **{n: F.sum(f"_v_{n}").over(inside) for n in sums},
        **{n: F.min(f"_v_{n}").over(inside) for n in mins},
    })
    if not blocks:
        return local.withColumns({n: F.coalesce(F.col(n), F.lit(0)) for n in sums}).drop(*[f"_v_{n}" for n in names])
    carried = carry(cut, keys, order, fills, sums, mins)
    joined = join_null_safe(local, carried.hint(hint) if hint else carried, [*keys, "_block"]).withColumns({
        **{n: F.coalesce(F.col(n), F.col(f"_c_{n}")) for n in fills},
        **{n: F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"_c_{n}"), F.lit(0)) for n in sums},
        **{n: F.least(n, f"_c_{n}") for n in mins},
    })
    return joined.drop("_block", *[f"_v_{n}" for n in names], *[f"_c_{n}" for n in names])


def carry(cut: DataFrame, keys: list[str], order: str, fills, sums, mins) -> DataFrame:
    """What the ranges before hand on to each (keys, _block): one row each, with the columns ``_c_...``."""
    per_block = cut.groupBy(*keys, "_block").agg(
        *[F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(order))).alias(f"_b_{n}") for n in fills],
        *[F.sum(f"_v_{n}").alias(f"_b_{n}") for n in sums],
        *[F.min(f"_v_{n}").alias(f"_b_{n}") for n in mins],
    )
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    return per_block.select(
        *keys, "_block",
        *[F.last(f"_b_{n}", ignorenulls=True).over(before).alias(f"_c_{n}") for n in fills],
        *[F.sum(f"_b_{n}").over(before).alias(f"_c_{n}") for n in sums],
        *[F.min(f"_b_{n}").over(before).alias(f"_c_{n}") for n in mins],
    )


def rank_in_blocks(df: DataFrame, keys: list[str], order: str, out: str, rows: int = BLOCK) -> DataFrame:
    """Position 1, 2, ... along ``order`` within ``keys``, without one window per whole key."""
    return in_blocks(df, keys, order, sums={out: F.lit(1).cast("bigint")}, rows=rows)


def shifts(counts: DataFrame, bucket: str, n: str, out: str, group: int = 1_024) -> DataFrame:
    """(bucket, out): the sum of ``n`` over the buckets before, by a scan in two levels.

    Buckets are added up within groups of neighbours, the groups' sums among themselves; no task sorts all buckets.
    """
    grouped = counts.select(F.col(bucket), F.col(n), F.floor(F.col(bucket) / group).alias("_g"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    within = grouped.withColumn("_in", F.sum(n).over(before(Window.partitionBy("_g").orderBy(bucket))))
    above = grouped.groupBy("_g").agg(F.sum(n).alias("_sum")).select("_g", F.sum("_sum").over(before(Window.orderBy("_g"))).alias("_over"))
    return within.join(above, "_g").select(bucket, (F.coalesce("_in", F.lit(0)) + F.coalesce("_over", F.lit(0))).alias(out))


def digest_buckets(values: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """The distinct rows of ``columns`` with their digest and a bucket, about ``rows`` of them in each.

    Buckets cut the range of digests evenly, so a bucket's number grows with the digest however many there are.
    """
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in columns]
    digest = F.md5(F.concat_ws("|", *parts))
    distinct = reliable_checkpoint(values.select(*columns).distinct().withColumn("_digest", digest))
    buckets = max(1, -(-distinct.count() // rows))
    head = F.conv(F.substring("_digest", 1, 8), 16, 10).cast("bigint")
    return distinct.withColumn("_bucket", F.shiftright(head * buckets, 32))


def dense_index(values: DataFrame, columns: list[str], out: str, rows: int = BLOCK // 2) -> DataFrame:
    """Dense ids 0, 1, ... for distinct rows, in the order of their digest.

    The digests spread the rows evenly over buckets of about ``rows`` rows, whatever their number; each
    bucket is numbered on its own and shifted by the rows before it. The ids do not depend on ``rows``.
    """
    keyed = digest_buckets(values, columns, rows)
    before = shifts(keyed.groupBy("_bucket").count(), "_bucket", "count", "_shift")
    inside = Window.partitionBy("_bucket").orderBy("_digest", *columns)
    numbered = keyed.withColumn("_n", F.row_number().over(inside))
    return numbered.join(before, "_bucket").select(*columns, (F.col("_n") - 1 + F.col("_shift")).alias(out))


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """Small rows over all shuffle partitions, ahead of a step that makes many rows of each.

    The number is given, so adaptive execution does not merge the partitions for being small now.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *[F.col(c) for c in columns or df.columns])


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key; Spark keeps one row per key and map task before the shuffle."""
    return top_per_key(df, keys, order, 1)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, out: str | None = None) -> DataFrame:
    """The first ``k`` rows of every key by ``order`` (a group limit runs before the shuffle)."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col("_rank") <= k)
    return kept.withColumnRenamed("_rank", out) if out else kept.drop("_rank")


def join_spreading_nulls(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left",
                         spread: int = 64, salt: list[str] | None = None) -> DataFrame:
    """Left, left-anti or left-semi join whose NULL keys do not pile up in one partition.

    Rows with a NULL key can match nothing, but a plain shuffle sends them all to one task; a salt
    taken from two of the row's other columns, or those named by ``salt``, spreads them without
    holding on to columns that nothing else reads. The right side's salt is always 0, but worked out
    from its key: as a constant the optimizer would take it out of the join keys again.
    """
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    rest = [F.col(f"`{c}`") for c in salt or [c for c in left.columns if c not in keys][:2]] or [F.lit(0)]
    salted = left.withColumn(
        "_salt", F.when(missing, F.pmod(F.xxhash64(*rest), F.lit(spread)).cast("int")).otherwise(F.lit(0))
    )
    zero = F.pmod(F.xxhash64(*keys), F.lit(1)).cast("int")
    return salted.join(right.withColumn("_salt", zero), [*keys, "_salt"], how).drop("_salt")


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys equal each other; the right side's other columns are added."""
    other = [c for c in right.columns if c not in keys]
    renamed = right.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *other)
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"_k_{k}" for k in keys])


def share(df: DataFrame, value: str, out: str, digits: int = 4) -> DataFrame:
    """Part of the grand total; the total is a one-row scalar, not a window over all rows."""
    total = df.agg(F.sum(value).alias("total"))
    return df.withColumn(out, F.round(F.col(value) / total.scalar(), digits))


def bound(value, use) -> Column:
    """``use`` of a value that is worked out once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def first_filled(value: Column | str, order: Column | str) -> Column:
    """Aggregate: the first non-null value along ``order`` (partial on the map side)."""
    v = F.col(value) if isinstance(value, str) else value
    o = F.col(order) if isinstance(order, str) else order
    return F.min_by(v, F.when(v.isNotNull(), o))


def joined_set(value: Column | str, sep: str = ",") -> Column:
    """Aggregate: distinct values in order, as text. For value domains that are small by nature
    (systems, sources, years, document labels)."""
    return F.array_join(F.array_sort(F.collect_set(value)), sep)


def literal_rows(spark, rows: list[tuple], schema: str) -> DataFrame:
    """A small fixed table as a literal, without a round trip through Python."""
    names = [part.split()[0] for part in schema.split(",")]
    types = [part.split()[1] for part in schema.split(",")]
    structs = [F.struct(*[F.lit(v).cast(t).alias(n) for v, n, t in zip(row, names, types)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
