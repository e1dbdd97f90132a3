"""Operator 2: quality rules by a hashed n-gram log-likelihood ratio, in built-in functions only.

Tokens are runs of letters and digits and runs of other signs; their unigrams and bigrams are hashed
into a fixed number of buckets. Two multinomials over the buckets are counted: one over all
documents, one over a trusted target, the documents labelled good. A document's score is the mean
over its n-grams of log(target / corpus), so it does not grow with length, and a fixed threshold
decides on every document. The target is smoothed towards the corpus, so a bucket that was seen too
rarely to tell says nothing.

Only the bucket table, whose size is a parameter, reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.base import fresh, query, table, text_of
from plumbline.session import reliable_checkpoint

BUCKETS = 1 << 14
#: Weight of the corpus, in n-grams, that smooths the target.
PRIOR = float(BUCKETS)
THRESHOLD = -0.2
TOKEN = r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\s]+"
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def _upto(n: Column) -> Column:
    """0, ..., n - 1; empty if n is not positive."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _covered(positions: Column) -> Column:
    """Words in the 3-word windows at sorted positions."""
    steps = F.zip_with(positions, F.slice(positions, 2, F.size(positions)), lambda a, b: F.when(b.isNull(), 3).otherwise(F.least(F.lit(3), b - a)))
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda s, x: s + x)


def _repeat_words(words: Column) -> Column:
    """Words in 3-word windows found twice or more; windows are compared by a 64-bit hash."""
    windows = F.transform(_upto(F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def repeated(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def at_runs(s: Column) -> Column:
            same = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
            return let(F.array_sort(F.transform(same, lambda x: x["i"])), _covered)

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(let(placed, at_runs))

    return let(windows, repeated)


def base_measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def measured(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("bigint").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("bigint"), lambda s, x: s + F.length(x)).alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            _repeat_words(w).alias("n_repeat_words"),
        )

    return let(words, measured)


def gram_buckets(text: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of every unigram and bigram of a text."""
    tokens = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))

    def grams(t: Column) -> Column:
        one = F.transform(t, lambda x: F.pmod(F.xxhash64(x), F.lit(buckets)).cast("int"))
        two = F.transform(_upto(F.size(t) - 1), lambda i: F.pmod(F.xxhash64(F.get(t, i), F.get(t, i + 1)), F.lit(buckets)).cast("int"))
        return F.concat(one, two)

    return let(tokens, grams)


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR) -> DataFrame:
    """(bucket, ratio): the log-likelihood ratio of every bucket seen.

    Corpus counts cover all rows of ``docs`` (doc_id, text). The target are all the documents whose
    ``quality`` in ``labels`` is 1.
    """
    good = labels.where(F.col("quality") == 1).where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    # Texts are shuffled, not their n-grams, which take more room; the ids are the side that is hashed.
    texts = docs.select("doc_id", text_of().alias("text"))
    known = texts.where(F.col("doc_id").isNotNull()).join(good.withColumn("trusted", F.lit(1)).hint("shuffle_hash"), "doc_id", "left")
    marked = known.select("text", F.coalesce("trusted", F.lit(0)).cast("bigint").alias("trusted"))
    # Documents without an id are never trusted and need no partner.
    marked = marked.unionByName(texts.where(F.col("doc_id").isNull()).select("text", F.lit(0).cast("bigint").alias("trusted")))
    each = marked.select("trusted", F.explode(gram_buckets(F.col("text"), buckets)).alias("bucket"))
    counts = reliable_checkpoint(each.groupBy("bucket").agg(F.count("*").alias("corpus"), F.sum("trusted").alias("target")))
    totals = counts.agg(F.sum("corpus").alias("corpus_all"), F.sum("target").alias("target_all"))
    share = F.col("corpus") / F.lit(totals.select("corpus_all").scalar())
    target_all = F.lit(totals.select("target_all").scalar())
    return counts.select("bucket", F.log((F.col("target") + prior * share) / ((target_all + prior) * share)).alias("ratio"))


def rate(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR,
         threshold: float = THRESHOLD, out: str = "quality_rules") -> DataFrame:
    """All columns of ``docs`` and the struct ``out``: the base measures, base_failed, kept, score.

    No column of ``docs`` may be named ``out``; any other names are free.

    A null or empty text has no words and fails the base rules. Without labels every score is 0. A
    text without n-grams scores 0. Equal rows are rated alike; an empty table stays empty.
    """
    spark = docs.sparkSession
    model = fit(docs, labels, buckets, prior)
    # One row of a fixed number of values.
    every = spark.range(0, buckets, 1, 1).withColumnRenamed("id", "bucket").join(model, "bucket", "left")
    ratios = every.agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", F.coalesce("ratio", F.lit(0.0)).alias("ratio")))), lambda x: x["ratio"]).alias("ratios")).scalar()
    text = text_of()
    values, base, rated = fresh(docs, "_ratios", "_base", "_score")

    def mean(g: Column) -> Column:
        total = F.aggregate(g, F.lit(0.0), lambda s, x: s + F.get(F.col(values), x))
        return F.when(F.size(g) == 0, F.lit(0.0)).otherwise(total / F.size(g))

    measured = docs.withColumn(values, ratios).withColumn(base, base_measures(text)).withColumn(rated, let(gram_buckets(text, buckets), mean))
    failed = (F.col(f"{base}.n_words") < 50) | (100 * F.col(f"{base}.n_repeat_words") > 50 * F.col(f"{base}.n_words"))
    parts = [F.col(f"{base}.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    rules = F.struct(*parts, failed.alias("base_failed"), (~failed & (F.col(rated) >= threshold)).alias("kept"), F.col(rated).alias("score"))
    return measured.withColumn(out, rules).drop(values, base, rated)


@query("op2_ngram_ratio_rules")
def op2_ngram_ratio_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdict on all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rate(docs, table(spark, sf_dir, "labels")).select("doc_id", "quality_rules.*")
