"""Tabular sources (S01-S05, S07, S08, S10, S14-S16): text columns, names resolved by alias."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.clean import first_non_blank, valid_key
from plumbline.operators.documents import source_year_union

#: Fields are quoted with double quotes, and a quote inside one is doubled, as other programs write CSV.
CSV_FORMAT = {"header": True, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def with_row_no(df: DataFrame) -> DataFrame:
    """Add ``source_file`` and ``row_no``, a whole number that grows along each file.

    Taken right at the scan: the split's start in units of 4 KB, then the record's place in its task.
    Splits of one file start further apart than that, so the pair orders a file's rows on any
    cluster, in files of up to 4 TB. To be applied to a freshly read DataFrame, before any shuffle.
    """
    split = F.shiftright(F.col("_metadata.file_block_start"), 12)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return df.select("*", F.col("_metadata.file_path").alias("source_file"), (F.shiftleft(split, 33) + place).alias("row_no"))


def _without_mark(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed({c: c.lstrip("﻿").strip() for c in df.columns if c != c.lstrip("﻿").strip()})


def read_csv(spark: SparkSession, paths: str | list[str], row_no: bool = True, line_breaks: bool = False, **options) -> DataFrame:
    """Header CSV, every column text, byte-order mark removed from the first name.

    ``line_breaks`` allows quoted line breaks inside fields; a file is then read by one task, as it
    cannot be split. ``row_no`` follows the file's order either way.
    """
    df = spark.read.options(**CSV_FORMAT, inferSchema=False, multiLine=line_breaks, **options).csv(paths)
    return _without_mark(with_row_no(df) if row_no else df)


def header_map(columns: list[str]) -> dict[str, str]:
    """Trimmed lower-case header to column name."""
    return {c.strip().lower(): c for c in columns}


def resolve_headers(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Each wanted column from the first header that fits, ignoring case; NULL where none does."""
    have = header_map(df.columns)
    picked = []
    for name, options in aliases.items():
        hit = next((have[o.strip().lower()] for o in options if o.strip().lower() in have), None)
        picked.append((F.col(f"`{hit}`") if hit else F.lit(None).cast("string")).alias(name))
    kept = [F.col(c) for c in ("source_file", "row_no") if c in df.columns]
    return df.select(*picked, *kept)


def coalesce_headers(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Each wanted column as the first non-empty of all headers that fit, row by row."""
    have = header_map(df.columns)
    picked = []
    for name, options in aliases.items():
        hits = [F.col(f"`{have[o.lower()]}`") for o in options if o.lower() in have]
        picked.append((first_non_blank(*hits) if hits else F.lit(None).cast("string")).alias(name))
    kept = [F.col(c) for c in ("source_file", "row_no") if c in df.columns]
    return df.select(*picked, *kept)


#: Rows a lookup table may have: it becomes a literal of every plan that uses it.
LOOKUP_ROWS = 10_000


def read_lookup(spark: SparkSession, path: str, key: str, value: str) -> dict[str, str]:
    """A small table of document types, overrides or states, loaded once, blank keys left out.

    The last row of a key wins. A table of more than ``LOOKUP_ROWS`` rows is none to load but to join.
    """
    rows = read_csv(spark, path).where(F.trim(key) != "").orderBy("source_file", "row_no").select(F.trim(key).alias("k"), F.trim(value).alias("v")).take(LOOKUP_ROWS + 1)
    if len(rows) > LOOKUP_ROWS:
        raise ValueError(f"{path} has more than {LOOKUP_ROWS} rows: join it instead")
    return {r["k"]: r["v"] for r in rows}


def read_gazetteer(spark: SparkSession, path: str, states: list[str]) -> DataFrame:
    """Tab-separated postal file; rows without coordinates or outside the states are dropped."""
    schema = ", ".join(f"c{i} string" for i in range(12))
    raw = with_row_no(spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(path))
    rows = raw.select(
        "row_no", F.col("c1").alias("zip"), F.upper("c2").alias("city"), F.col("c4").alias("state"), F.upper("c5").alias("county"),
        F.col("c9").try_cast("double").alias("lat"), F.col("c10").try_cast("double").alias("lng"))
    return rows.where(F.col("lat").isNotNull() & F.col("lng").isNotNull() & F.col("state").isin(states))


def read_json_records(spark: SparkSession, path: str, schema: str, whole_files: bool = True) -> DataFrame:
    """JSON lists of records, or - splittable - one record per line."""
    return spark.read.schema(schema).option("multiLine", whole_files).json(path)


def read_years(spark: SparkSession, pattern: str, years: list[int], year: str = "file_year", line_breaks: bool = False) -> DataFrame:
    """One CSV per year, stacked by column name; years without a file are left out."""
    frames = {y: read_csv(spark, pattern.format(year=y), line_breaks=line_breaks) for y in years if exists(spark, pattern.format(year=y))}
    return source_year_union(frames, year)


def exists(spark: SparkSession, pattern: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p))


def export_projection(df: DataFrame, key: str, columns: list[str], pattern: str, mode: str = "prefix") -> DataFrame:
    """A few columns with a clean key; rows without one are dropped."""
    out = df.withColumn(key, valid_key(key, pattern, mode, squeeze_spaces=True)).where(F.col(key).isNotNull())
    return out.select(key, *[F.coalesce(F.trim(c), F.lit("")).alias(c) for c in columns])
