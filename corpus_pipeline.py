"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.llm.base import QUERIES, fresh, settle, table
from plumbline.llm.near_copies import near_copies
from plumbline.llm.packing import pack
from plumbline.llm.quality import rate
from plumbline.llm.toxicity import score
from plumbline.llm.vocab import public_path
from plumbline.session import reliable_checkpoint

#: Near-copies share this many words a shingle and hundredths of their shingles.
SHINGLE_WORDS, PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; those without a text go."""
    settle(spark)
    [verdict] = fresh(docs, "quality_rules")
    rated = rate(docs, table(spark, sf_dir, "labels"), out=verdict)
    return rated.where(f"{verdict}.kept").select(*[f"`{c}`" for c in docs.columns])


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted to be toxic."""
    settle(spark)
    [verdict] = fresh(docs, "toxicity")
    judged = score(docs, table(spark, sf_dir, "labels"), out=verdict)
    return judged.where(f"{verdict}.predicted = 0").select(*[f"`{c}`" for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: the one of the least doc_id, nulls last.

    Rows of one doc_id are documents of their own unless their texts are near-copies; of repeated rows
    one stays. Documents without words are no copies of each other.
    """
    settle(spark)
    row, copy = fresh(docs, "_row", "_copy")
    keyed = docs.withColumn(row, F.xxhash64("doc_id", F.col("doc_id").isNull(), "text", F.col("text").isNull()))
    groups = near_copies(keyed.select(F.col(row).alias("doc_id"), "text"), SHINGLE_WORDS, PERCENT)
    ids = reliable_checkpoint(keyed.select(F.col(row).alias("row"), "doc_id"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    members = ids.join(groups.select(F.col("doc_id").alias("row"), "component_id").distinct(), "row")
    winners = members.groupBy("component_id").agg(F.min(first).alias("first")).select(F.col("first.row").alias(row))
    kept = keyed.join(winners, row, "left_semi")
    one = F.row_number().over(Window.partitionBy(row).orderBy(F.lit(1)))
    return kept.withColumn(copy, one).where(F.col(copy) == 1).select(*[f"`{c}`" for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in cost-balanced sequences."""
    settle(spark)
    return pack(docs, public_path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("toxicity", toxicity), ("near_dedup", near_dedup), ("packing", packing)]

#: Hashes, fitted models and tokenizers are beyond SQL; tests/llm holds every stage to a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(settle(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = reliable_checkpoint(docs)
    return docs


QUERIES["pipeline"] = run
