"""File listings (S11-S13) and whole-text sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import constants as K
from plumbline.functions.clean import as_col
from plumbline.operators.scale import bound, join_null_safe
from plumbline.session import reliable_checkpoint

from .tabular import with_row_no


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Every file below a root, its folder relative to the root; contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    base = root.rstrip("/").split(":", 1)[-1].lstrip("/") + "/"
    below = F.substring_index("path", base, -1)
    return df.select(
        "path", "modificationTime", "length", F.substring_index(below, "/", -1).alias("file_name"),
        F.regexp_replace(F.regexp_replace(below, r"[^/]*$", ""), "/$", "").alias("subfolder"))


def without_folders(files: DataFrame, skipped: list[str] | None = None, subfolder: str = "subfolder") -> DataFrame:
    """Files below none of the skipped folders."""
    names = F.split(F.lower(subfolder), "/")
    return files.where(~F.arrays_overlap(names, F.array(*[F.lit(s) for s in skipped or K.SKIPPED_FOLDERS])))


def release_files(files: DataFrame, job: str, subfolder: str = "subfolder", required: bool = True) -> DataFrame:
    """Files below a folder named for a release; without one, nothing or all of the job's files."""
    first = F.substring_index(subfolder, "/", 1)
    marked = files.withColumn("_release", F.lower(first).contains("release"))
    if required:
        return marked.where("_release").drop("_release")
    has = marked.groupBy(job).agg(F.bool_or("_release").alias("_has"))
    joined = join_null_safe(marked, has, [job])
    return joined.where(F.col("_release") | ~F.col("_has")).drop("_release", "_has")


def latest_file(files: DataFrame, patterns: list[str], name: str = "file_name", path: str = "path") -> DataFrame:
    """The newest file of the first pattern that has any, as one row."""
    shapes = ["^" + p.replace(".", r"\.").replace("*", ".*") + "$" for p in patterns]
    newest = [F.max_by(path, F.when(F.col(name).rlike(s), F.col("modificationTime"))) for s in shapes]
    return files.agg(F.coalesce(*newest).alias(path))


# ---------------------------------------------------------------- spreadsheet XML

CELL = "array<struct<Data:struct<_VALUE:string>,`_ss:Index`:bigint>>"


_SHEET_END = "</Worksheet>"
_SALTS = 64
#: What a piece holds: empty rows, the end of a sheet, and last the row with cells that the piece ends with.
_PARTS = r"(?s)<Row\b(?:[^>\"'/]|\"[^\"]*\"|'[^']*')*/>|</Worksheet>|<Row\b.*"


def read_sheet_xml(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the first worksheet of each spreadsheet-XML export as ``(source_file, row_no, raw_cells)``.

    A file is cut at the ends of its rows, wherever its splits lie, so many tasks read one worksheet and none
    holds more than a row at a time. Where a file's first sheet ends is one number, found among the same
    pieces; rows from there on belong to other sheets. ``row_no`` grows along the sheet. Row ends inside
    comments or character data are not told apart from others.
    """
    parts = _sheet_parts(spark, path)
    first = _meet(parts, _sheet_marks(parts)).where(F.col("row_no") < F.col("end"))
    return first.select("source_file", "row_no", row_cells("part").alias("raw_cells"))


def read_sheet_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """What ``sheet_records`` makes of ``read_sheet_xml``, each row's XML parsed once.

    Where a file's header row stands is known before any row is parsed, so only header rows are parsed for it.
    """
    parts = _sheet_parts(spark, path)
    marked = _meet(parts, _sheet_marks(parts)).where(F.col("row_no") < F.col("end"))
    header = marked.where(F.col("row_no") == F.col("header_no")).select("source_file", "end", "header_no", placed_cells(row_cells("part")).alias("header"))
    header = reliable_checkpoint(_column_places(header, ["source_file", "end", "header_no"], columns))
    body = _meet(parts, header).where((F.col("row_no") > F.col("header_no")) & (F.col("row_no") < F.col("end")))
    return _at_places(body.withColumn("cells", placed_cells(row_cells("part"))), columns)


def _sheet_parts(spark: SparkSession, path: str) -> DataFrame:
    """(part, source_file, row_no): rows of all sheets without their end tags, and sheet ends."""
    pieces = spark.read.option("lineSep", "</Row>").text(path)
    parts = pieces.select("_metadata", F.explode(F.regexp_extract_all("value", F.lit(_PARTS), F.lit(0))).alias("part"))
    return with_row_no(parts).drop("_metadata")


def _sheet_marks(parts: DataFrame) -> DataFrame:
    """(source_file, end, header_no): the number at which a file's first sheet ends, past all numbers if it never does, and its first row's.

    One row per file, kept: Spark sees how small the table is and sends it to the rows, which then are not shuffled.
    """
    ends = F.col("part") == _SHEET_END
    marks = parts.groupBy("source_file").agg(F.min(F.when(ends, F.col("row_no"))).alias("end"), F.min(F.when(~ends, F.col("row_no"))).alias("header_no"))
    return reliable_checkpoint(marks.withColumn("end", F.coalesce("end", F.lit((1 << 63) - 1))))


def _meet(parts: DataFrame, per_file: DataFrame) -> DataFrame:
    """The rows of each file with the file's one row, in several tasks where they are shuffled: one file may hold most rows."""
    salted = per_file.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)).cast("array<bigint>")))
    return parts.withColumn("_salt", F.pmod("row_no", F.lit(_SALTS).cast("bigint"))).join(salted, ["source_file", "_salt"]).drop("_salt")


#: A cell whose text needs no XML parser: no markup in it, no space or control at its ends, and not the parser's word for null.
_PLAIN_CELL = r'<Cell(?: ss:Index="([0-9]{1,9})")?><Data ss:Type="[A-Za-z]+">(?!null<)([^<>\p{Z}\p{C}](?:[^<>\p{Cc}\p{Cn}]*[^<>\p{Z}\p{C}])?)</Data></Cell>'


def row_cells(part) -> Column:
    """The cells of a row without its end tag. Rows of plain cells alone are read by their pattern, all others by the XML parser."""
    part = as_col(part)
    whole = F.when(F.endswith(part, F.lit("/>")) & ~part.contains("<Cell"), part).otherwise(F.concat(part, F.lit("</Row>")))
    parsed = F.coalesce(F.from_xml(whole, f"Cell {CELL}", {"rowTag": "Row"})["Cell"], F.array().cast(CELL))
    # What is left without plain cells is the row's own tag, and the row starts with it: nothing stands between or beside the cells.
    tag = F.regexp_replace(part, _PLAIN_CELL, "")
    plain = F.rlike(tag, F.lit(r"^<Row(?: [^<>]*)?>$")) & ~F.endswith(tag, F.lit("/>")) & F.startswith(part, tag) & ~F.rlike(part, F.lit("&(?!(?:lt|gt|amp|quot|apos);)"))
    decoded = lambda x: F.when(~x.contains("&"), x).otherwise(reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")], x))
    cells = F.zip_with(
        F.regexp_extract_all(part, F.lit(_PLAIN_CELL), F.lit(1)), F.regexp_extract_all(part, F.lit(_PLAIN_CELL), F.lit(2)),
        lambda at, x: F.struct(F.struct(decoded(x).alias("_VALUE")).alias("Data"), F.nullif(at, F.lit("")).cast("bigint").alias("_ss:Index")))
    return F.when(plain, cells.cast(CELL)).otherwise(parsed)


def placed_cells(raw_cells) -> Column:
    """Cells as (at, text) with their true positions, counted from 1.

    A cell may carry its own position and the ones after it count on from there: the row is cut into runs of
    cells that follow such a one.
    """
    one = F.lit(1).cast("bigint")

    def place(cells):
        given = F.filter(F.transform(cells, lambda c, i: F.struct((i + 1).cast("bigint").alias("i"), c["_ss:Index"].alias("at"))), lambda a: a["at"].isNotNull())

        def run(runs):
            end = lambda j: F.coalesce(F.get(runs, j + 1)["i"], F.size(cells) + one)
            return F.flatten(F.transform(runs, lambda r, j: F.transform(
                F.slice(cells, r["i"].cast("int"), (end(j) - r["i"]).cast("int")),
                lambda c, k: F.struct((r["at"] + k).cast("bigint").alias("at"), F.coalesce(c["Data"]["_VALUE"], F.lit("")).alias("text")))))

        return F.when(cells.isNotNull(), bound(F.concat(F.array(F.struct(one.alias("i"), one.alias("at"))), given), run))

    return bound(as_col(raw_cells), place)


def cell_at(placed, position: Column) -> Column:
    """The text at a position, '' where there is none; of cells at one position the last counts."""
    return F.coalesce(F.try_element_at(F.filter(as_col(placed), lambda c: c["at"] == position), F.lit(-1))["text"], F.lit(""))


def cell_texts(placed) -> Column:
    """All texts of a row in place, up to its last position; gaps are ''. Of cells at one position the last counts."""
    at = lambda cells, i: F.get(cells, i)["at"]
    in_order = F.array_sort(F.filter(F.transform(as_col(placed), lambda c, i: F.struct(c["at"].alias("at"), i.alias("i"), c["text"].alias("text"))), lambda c: c["at"] > 0))
    last = lambda cells: F.filter(cells, lambda c, i: F.coalesce(at(cells, i + 1) != c["at"], F.lit(True)))
    padded = lambda cells: F.flatten(F.transform(cells, lambda c, i: F.concat(
        F.array_repeat(F.lit(""), (c["at"] - F.when(i > 0, at(cells, i - 1)).otherwise(0) - 1).cast("int")), F.array(c["text"]))))
    return F.coalesce(bound(in_order, lambda cells: bound(last(cells), padded)), F.array().cast("array<string>"))


def sheet_records(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Named columns of a sheet whose first row is the header, however wide it is.

    The header row (one per file) gives each column's place; rows look their cells up by it.
    """
    cells = rows.select("source_file", "row_no", placed_cells("raw_cells").alias("cells"))
    header = cells.groupBy("source_file").agg(F.min("row_no").alias("header_no"), F.min_by("cells", "row_no").alias("header"))
    header = _column_places(header, ["source_file", "header_no"], columns)
    return _at_places(cells.join(header, "source_file").where(F.col("row_no") > F.col("header_no")), columns)


def _column_places(header: DataFrame, kept: list[str], columns: list[str]) -> DataFrame:
    """The place of each named column in the cells ``header``."""
    at = lambda c: F.get(F.filter("header", lambda h: F.trim(h["text"]) == c), F.lit(0))["at"]
    return header.select(*kept, *[at(c).alias(f"_at_{i}") for i, c in enumerate(columns)])


def _at_places(body: DataFrame, columns: list[str]) -> DataFrame:
    return body.select("source_file", "row_no", *[cell_at("cells", F.col(f"_at_{i}")).alias(c) for i, c in enumerate(columns)])


# ---------------------------------------------------------------- front matter

def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """One row per text file with its name and whole text."""
    df = spark.read.text(path, wholetext=True)
    # File names arrive percent-encoded; a plus sign in one stands for itself.
    name = F.url_decode(F.regexp_replace(F.col("_metadata.file_name"), r"\+", "%2B"))
    return df.select(name.alias("file_name"), F.col("value").alias("text"))


def front_matter(text) -> Column:
    """The ``key: value`` block at the top of a page as a map; quotes and link marks removed."""
    body = F.regexp_extract(as_col(text), r"(?s)^---\s*\n(.*?)\n---", 1)
    lines = F.filter(F.split(body, r"\r?\n"), lambda x: x.contains(":"))
    entry = lambda x: F.struct(
        F.lower(F.trim(F.substring_index(x, ":", 1))).alias("key"),
        F.nullif(F.regexp_replace(F.regexp_replace(F.trim(F.substr(x, F.instr(x, ":") + 1)), "^[\"']+|[\"']+$", ""), r"\[\[(.+?)\]\]", "$1"), F.lit("")).alias("value"))
    # The last line wins where a key is repeated.
    last = lambda entries: F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["key"] == e["key"]))
    return F.map_from_entries(bound(F.transform(lines, entry), last))
