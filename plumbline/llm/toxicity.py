"""Operator 5: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and word beginnings that mark toxic texts is counted from the labelled training
documents. Every document gets a dozen dense features: lexicon densities (plain, by beginning, and
after undoing digit and sign substitutions), how near second-person words they stand, capitals,
punctuation and obfuscation rates. Boosted trees are fitted on a part of the training documents; an
isotonic regression on the other part turns their margin into a probability.

Labels, language, source and id are no inputs. The training rows are a bounded sample, those of the
smallest digests of their ids; every document is scored.
"""

from __future__ import annotations

import math
import re

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.base import fresh, map_batches, query, table, text_of
from plumbline.session import reliable_checkpoint

#: Bound on the labelled rows that are learned from, and on the lexicon.
TRAIN_ROWS = 12_000
LEXICON = 256
#: A lexicon entry is in so many, and this share, of the toxic training documents at least, and so much likelier there.
SUPPORT = 3
SHARE = 0.01
RATIO = 8.0
TREES, DEPTH = 30, 4
CUTOFF = 0.7
#: Words between a lexicon word and a second-person word that count as near.
NEAR = 5

# Second-person words.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen deiner ihr euch euer tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros tus su".split()
)
# Signs that stand for letters.
SUBSTITUTED = str.maketrans("0134578@$!|", "oieastbasil")
EDGES = ".,;:!?\"'()[]{}<>*_-~`…«»“”‘’#%&$@|/\\+="
FEATURES = [
    "lexicon", "lexicon_hits", "beginnings", "undone", "second_person", "near_second_person",
    "capitals", "shouted", "exclaimed", "punctuation", "obfuscated", "stretched",
]
_INNER = re.compile(r"[^\W\d_][\d@$!*|.][^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1{3}")
_PUNCTUATION = re.compile(r"[.,;:!?]")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_SHOUTED = re.compile(r"\b[A-ZÀ-ÖØ-Þ]{3,}\b")


def entries(word: str) -> list[str]:
    """Lexicon entries a word could match: itself, and its beginnings marked by a star."""
    return [word, *(word[:n] + "*" for n in (4, 5, 6) if len(word) > n)]


def measure(text: str, words: frozenset[str], stems: frozenset[str]) -> list[float]:
    """The features of one text."""
    plain = [w.strip(EDGES) for w in text.lower().split()]
    n = max(1, len(plain))
    chars = max(1, len(text))
    hits = [i for i, w in enumerate(plain) if w in words]
    begun = [i for i, w in enumerate(plain) if w[:4] in stems or w[:5] in stems or w[:6] in stems]
    inner = [w for w in plain if not w.isalpha() and _INNER.search(w)]
    undone = 0
    for w in inner:
        clear = w.translate(SUBSTITUTED)
        undone += clear in words or "".join(filter(str.isalpha, clear)) in words
    spoken = [i for i, w in enumerate(plain) if w in SECOND_PERSON]
    near, marks = 0, set(hits) | set(begun)
    if spoken and marks:
        around = {j for i in spoken for j in range(i - NEAR, i + NEAR + 1)}
        near = len(marks & around)
    return [
        len(hits) / n, math.log1p(len(hits)), len(begun) / n, undone / n, len(spoken) / n, near / n,
        len(_CAPITAL.findall(text)) / chars, len(_SHOUTED.findall(text)) / n, text.count("!") / n,
        len(_PUNCTUATION.findall(text)) / n, len(inner) / n, len(_STRETCHED.findall(text)) / n,
    ]


def features(text: Column | str, lexicon: list[str]) -> Column:
    """The features of a text column, as an array."""
    words = frozenset(w for w in lexicon if not w.endswith("*"))
    stems = frozenset(w[:-1] for w in lexicon if w.endswith("*"))

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return pd.Series([measure(t or "", words, stems) for t in texts])

    return measured(text)


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether a document's label is never learned from."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents outside the held-out third."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    one = known.groupBy("doc_id").agg(F.max("toxic").cast("double").alias("label"))
    # Written first: a limit right below a broadcast would gather every partition's rows on the driver.
    sample = reliable_checkpoint(one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    # Rows that share an id are one document to learn from, so the bound holds whatever repeats.
    return texts.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def learn_lexicon(train: DataFrame, size: int = LEXICON, support: int = SUPPORT, share: float = SHARE, ratio: float = RATIO) -> list[str]:
    """Words and beginnings (marked by a star) that mark toxic documents, the surest first."""

    def make():
        def step(batch: dict[str, list]) -> dict[str, list]:
            found = [(e, label) for t, label in zip(batch["text"], batch["label"]) for e in {e for w in set((t or "").lower().split()) for e in entries(w.strip(EDGES)) if w.strip(EDGES)}]
            return {"entry": [f[0] for f in found], "label": [f[1] for f in found]}

        return step

    seen = map_batches(train.select("text", "label"), make, "entry string, label double")
    counts = seen.groupBy("entry").agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    sizes = train.agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")).first()
    if not sizes["toxic"] or not sizes["clean"]:
        return []
    likelier = ((F.col("toxic") + 0.1) / sizes["toxic"]) / ((F.col("clean") + 0.1) / sizes["clean"])
    sure = counts.where((F.col("toxic") >= max(support, share * sizes["toxic"])) & (likelier >= ratio))
    best = sure.orderBy((F.log(likelier) * F.sqrt("toxic")).desc(), "entry").limit(size)
    return [r["entry"] for r in best.select("entry").collect()]


def score(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, cutoff: float = CUTOFF, out: str = "toxicity") -> DataFrame:
    """All columns of ``docs`` (doc_id, text) and the struct ``out``: held_out, score, predicted.

    Null texts are empty and scored like any other; equal rows get equal scores; an empty table
    stays empty. Where the training rows hold one label only, or one part of them does, every score is
    the share of toxic rows (0 without labels). No column of ``docs`` may be named ``out``; any other names are free.
    """
    train = reliable_checkpoint(training_rows(docs, labels, train_rows))
    lexicon = learn_lexicon(train)
    text = text_of()
    vectors, klass, raw, likely, margins, fitted = fresh(docs, "_tox_features", "_tox_class", "_tox_raw", "_tox_share", "_tox_margin", "_tox_score")
    part = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(3)).alias("part")
    sample = reliable_checkpoint(train.select(F.xxhash64("doc_id").alias("digest"), part, "label", features(text, lexicon).alias("values")))
    # At most ``train_rows`` rows of numbers, in a fixed order: the fit is the same whatever the partitions were.
    sample = reliable_checkpoint(sample.coalesce(1).sortWithinPartitions("digest", "values").drop("digest"))
    counts = {(r["first"], r["label"]): r["n"] for r in sample.groupBy((F.col("part") == 0).alias("first"), "label").agg(F.count("*").alias("n")).collect()}
    if set(counts) != {(p, y) for p in (True, False) for y in (0.0, 1.0)}:
        share = sum(n for (_, y), n in counts.items() if y == 1.0) / max(1, sum(counts.values()))
        scored = docs.withColumn(fitted, F.lit(float(share)))
    else:
        vector = lambda df, values: df.withColumn(vectors, array_to_vector(values))
        margin = vector_to_array(raw)[1]
        ready = vector(sample, "values")
        names = {"featuresCol": vectors, "predictionCol": klass, "rawPredictionCol": raw, "probabilityCol": likely}
        boosting = GBTClassifier(labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=7)
        for name, column in names.items():
            boosting.set(boosting.getParam(name), column)
        trees = boosting.fit(ready.where("part <> 0"))
        calibration = trees.transform(ready.where("part = 0")).select(margin.alias(margins), "label")
        isotonic = IsotonicRegression(featuresCol=margins, labelCol="label", predictionCol=fitted).fit(calibration)
        judged = trees.transform(vector(docs, features(text, lexicon))).withColumn(margins, margin)
        scored = isotonic.transform(judged)
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col(fitted)))
    verdict = F.struct(held_out().alias("held_out"), clipped.alias("score"), (clipped >= cutoff).cast("int").alias("predicted"))
    return scored.select(*[F.col(f"`{c}`") for c in docs.columns], verdict.alias(out))


@query("op5_boosted_toxicity")
def op5_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, table(spark, sf_dir, "labels")).select("doc_id", "toxicity.*")
