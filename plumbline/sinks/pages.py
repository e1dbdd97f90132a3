"""Text pages per entity (K09, K10) as rows of (file_name, content)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.clean import front_matter_value, safe_file_name


def linked(value: Column) -> Column:
    """A place name as a quoted link, '' when absent."""
    return F.when(F.coalesce(value, F.lit("")) != "", F.concat(F.lit('"[['), value, F.lit(']]"'))).otherwise(F.lit(""))


def render_pages(rows: DataFrame, key: str, title: Column, front: dict[str, Column], body: Column) -> DataFrame:
    """Front matter, title and body of one page per row."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    heading = F.when(text(title) != "", F.concat(F.col(key), F.lit(" - "), title)).otherwise(F.col(key))
    lines = [F.lit("---"), *[F.concat(F.lit(f"{n}: "), text(c)) for n, c in front.items()], F.lit("---"), F.lit(""),
             F.concat(F.lit("# "), heading), F.lit(""), text(body)]
    return rows.select(key, F.concat(safe_file_name(heading), F.lit(".md")).alias("file_name"), F.concat_ws("\n", *lines).alias("content"))


def plain(value: Column) -> Column:
    return front_matter_value(F.coalesce(value, F.lit("")))


def bullet_section(heading: str, items: Column) -> Column:
    """A titled list, NULL when there is nothing to list."""
    listed = F.array_join(F.transform(items, lambda s: F.concat(F.lit("- "), s)), "\n")
    return F.when(F.size(items) > 0, F.concat(F.lit(f"### {heading}\n"), listed, F.lit("\n")))


def append_section(pages: DataFrame, sections: DataFrame, key: str, heading: str) -> DataFrame:
    """Pages with the section added once; keys without a page get a new one."""
    joined = pages.select(key, "content").join(sections.select(key, "section"), key, "full")
    block = F.concat(F.lit(f"\n## {heading}\n\n"), F.col("section"))
    fresh = F.concat(F.lit("---\njob_code: "), F.col(key), F.lit("\n---\n\n# "), F.col(key), F.lit("\n"), block)
    has = F.col("content").contains(f"## {heading}")
    state = (
        F.when(F.col("section").isNull() & F.col("content").isNotNull(), "unchanged").when(F.col("content").isNull(), "created")
        .when(has, "skipped").otherwise("updated")
    )
    content = (
        F.when(F.col("content").isNull(), fresh).when(F.col("section").isNull() | has, F.col("content"))
        .otherwise(F.concat("content", F.lit("\n"), block))
    )
    return joined.select(key, content.alias("content"), state.alias("state"))


def write_pages(pages: DataFrame, path: str) -> None:
    """All pages as rows of (file_name, content); the number of files follows the data, not the pages."""
    pages.select("file_name", "content").write.mode("overwrite").parquet(path)


def write_page_files(pages: DataFrame, path: str, file_names: list[str]) -> None:
    """A chosen set of pages as text, each in a folder of its name."""
    chosen = pages.where(F.col("file_name").isin(file_names))
    chosen.select("file_name", F.col("content").alias("value")).write.mode("overwrite").partitionBy("file_name").text(path)
