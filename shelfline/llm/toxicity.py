"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a learned lexicon and of its use near second-person words, of
capitals, punctuation and obfuscated spellings. The lexicon holds the words that most separate
toxic from other training documents. The trees are fitted on one part of the training rows, the
calibration on the rest.

Cases: null text counts as empty and gets a score like any other text; rows without a label, or
with a null one, do not train. With no training rows of both labels the score is the share of toxic
rows (0 without any). A document that occurs several times is scored each time.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from shelfline.llm.hyper_lang import remainder
from shelfline.llm.texts import fresh_name, groups, handing_back, map_texts, table
from shelfline.session import cut_lineage

# Lexicon, trees and calibration are fitted on at most this many labelled rows, the first ones in
# order of a hash of doc_id.
FIT_ROWS = 20_000
FIT_PARTS = 8  # tasks that hold them
LEXICON_WORDS = 300
LEXICON_MIN_DOCS = 5
CANDIDATES = 3000
LEXICON_GAIN = 12.0  # likelihood ratio below which a word may be chance, even among millions
TREES, DEPTH, RATE = 20, 3, 0.3

SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine sie ihr tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
# Signs and digits that stand for letters in disguised words.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None, "_": None, ".": None, "-": None})
WORDS = re.compile(r"[^\W\d_]+")
TOKENS = re.compile(r"\S+")
MIXED = re.compile(r"[^\W\d_][0-9@$!*_.\-]+[^\W\d_]|^[@$][^\W\d_]|^[0-9][^\W\d_]{2,}")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
NEAR = 5  # words
FEATURES = ["lexicon", "lexicon_log", "lexicon_weight", "lexicon_you", "disguised", "mixed", "stretched", "you", "capitals", "shouted", "punctuation", "exclaim", "digits", "log_words", "word_length"]


def plain_words(text: str) -> tuple[list[str], list[str]]:
    """Lower-case words, and the words that appear only after undoing a disguise."""
    words = WORDS.findall(text.lower())
    hidden = [t.translate(DISGUISE) for t in TOKENS.findall(text.lower()) if MIXED.search(t)] if not text.isalpha() else []
    return words, [w for h in hidden for w in WORDS.findall(h)]


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    words, hidden = plain_words(text)
    n, chars = len(words) or 1, len(text) or 1
    hits = [i for i, w in enumerate(words) if w in lexicon]
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON] if hits else []
    near = np.searchsorted(you, np.subtract(hits, NEAR)) < np.searchsorted(you, np.add(hits, NEAR), "right") if you else np.zeros(0)
    disguised = [w for w in hidden if w in lexicon]
    tokens = text.split()
    weight = sum(lexicon[words[i]] for i in hits) + sum(lexicon[w] for w in disguised)
    capitals = sum(map(str.isupper, tokens))
    return [
        (len(hits) + len(disguised)) / n,
        float(np.log1p(len(hits) + len(disguised))),
        weight / n,
        float(np.sum(near)) / n,
        len(disguised) / n,
        len(hidden) / n,
        len(STRETCHED.findall(text)) / n,
        len(you) / n,
        sum(map(str.isupper, text)) / chars,
        capitals / n,
        sum(map(text.count, ".,;:?()\"'")) / chars,
        text.count("!") / n,
        sum(map(text.count, "0123456789")) / chars,
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
    ]


def lexicon(training: DataFrame, size: int = LEXICON_WORDS, least: int = LEXICON_MIN_DOCS) -> dict[str, float]:
    """Word to log odds of occurring in toxic rather than other documents (text, toxic 0/1).

    Words are made distinct per document in the task and counted before the shuffle. The best
    `CANDIDATES` words by likelihood ratio are then counted by different neighbours in toxic
    documents, so a group of copies cannot teach its own vocabulary; the best `size` remain."""

    def work(batch: pa.RecordBatch) -> dict:
        counts: dict[tuple[str, int], int] = {}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            for w in set(chain(*plain_words(text or ""))):
                counts[w, toxic] = counts.get((w, toxic), 0) + 1
        return {"word": pa.array([w for w, _ in counts], pa.string()), "toxic": pa.array([t for _, t in counts], pa.int32()), "n": pa.array(list(counts.values()), pa.int64())}

    rows = map_texts(training.select("text", "toxic"), work, "word string, toxic int, n bigint")
    side = lambda t: F.sum(F.when(F.col("toxic") == t, F.col("n")).otherwise(0))
    words = rows.groupBy("word").agg(side(1).alias("bad"), side(0).alias("good")).where((F.col("bad") >= least) & (F.length("word") > 2))
    totals = training.agg(F.count_if(F.col("toxic") == 1).alias("bad"), F.count_if(F.col("toxic") == 0).alias("good")).first()
    first = cut_lineage(_best(words, totals, CANDIDATES).select("word", "bad", "good"))  # few rows; read twice
    shared = training.sparkSession.sparkContext.broadcast(frozenset(r["word"] for r in first.collect()))

    def contexts(batch: pa.RecordBatch) -> dict:
        found = set()
        for text in batch.column("text").to_pylist():
            words = ["", *plain_words(text or "")[0], ""]
            found.update((w, f"{words[i]} {words[i + 2]}") for i, w in enumerate(words[1:-1]) if w in shared.value)
        return {"word": pa.array([w for w, _ in found], pa.string()), "around": pa.array([c for _, c in found], pa.string())}

    around = map_texts(training.where("toxic = 1").select("text"), contexts, "word string, around string")
    spread = around.groupBy("word").agg(F.count_distinct("around").alias("n"))
    words = first.join(spread, "word", "left").withColumn("bad", F.least("bad", F.coalesce("n", F.lit(0)))).where(F.col("bad") >= least).drop("n")
    return {r["word"]: float(r["odds"]) for r in _best(words, totals, size).collect()}


def _best(words: DataFrame, totals, size: int) -> DataFrame:
    """The words with the highest likelihood ratio among those much more frequent in toxic text."""
    bad, good, all_bad, all_good = F.col("bad"), F.col("good"), float(totals["bad"]), float(totals["good"])
    odds = F.log((bad + 0.5) / F.greatest(all_bad - bad + 0.5, F.lit(0.5))) - F.log((good + 0.5) / (all_good - good + 0.5))
    expected = lambda of: (bad + good) * (of / (all_bad + all_good))
    # Unlike the odds' deviation this favours words seen often and never elsewhere.
    gain = bad * F.log(bad / expected(all_bad)) + F.when(good > 0, good * F.log(good / expected(all_good))).otherwise(0.0)
    scored = words.select("*", odds.alias("odds"), gain.alias("gain"))
    return scored.where((F.col("odds") > 2) & (F.col("gain") > LEXICON_GAIN)).orderBy(F.desc("gain"), "word").limit(size)


def with_features(docs: DataFrame, known: dict[str, float], column: str) -> DataFrame:
    """docs with an array column of features; rows stay in their tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(known)
    schema = StructType([*docs.schema.fields, StructField(column, ArrayType(DoubleType()))])

    def run(batches):
        for batch in batches:
            for part in groups(batch):
                found = [features(t or "", shared.value) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.list_(pa.float64()))], [*part.schema.names, column])

    return docs.mapInArrow(handing_back(run), schema)


class Model:
    """Lexicon, trees and calibration; `score` adds the calibrated probability to documents."""

    def __init__(self, known, trees, calibration, share: float):
        self.known, self.trees, self.calibration, self.share = known, trees, calibration, share

    def score(self, docs: DataFrame, column: str = "score") -> DataFrame:
        if self.trees is None:
            return docs.withColumn(column, F.lit(float(self.share)))
        from pyspark.ml.functions import array_to_vector, vector_to_array  # see fit

        array, vector, raw, odds, chance = (fresh_name(docs, f"_{c}") for c in ("features", "vector", "raw", "odds", "chance"))
        rows = with_features(docs, self.known, array).withColumn(vector, array_to_vector(F.col(array)))
        trees = self.trees.copy().setFeaturesCol(vector).setRawPredictionCol(raw).setProbabilityCol("").setPredictionCol("")
        rows = trees.transform(rows).withColumn(odds, vector_to_array(raw)[1])
        return rows.select(*docs.columns, calibrated(self.calibration, odds).alias(column))


def calibrated(calibration: tuple[list[float], list[float]], odds: str):
    """The fitted steps as an expression: linear between boundaries, flat outside."""
    bounds, values = calibration
    if len(bounds) == 1:
        return F.lit(values[0])
    x = F.col(odds)
    out = F.when(x <= bounds[0], F.lit(values[0]))
    for (x0, x1), (y0, y1) in zip(zip(bounds, bounds[1:]), zip(values, values[1:])):
        out = out.when(x <= x1, F.lit(y0) + (x - x0) * F.lit((y1 - y0) / (x1 - x0) if x1 > x0 else 0.0))
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), out.otherwise(F.lit(values[-1]))))


def fit(training: DataFrame) -> Model:
    """training: doc_id, text, toxic. See the module for its parts."""
    # Only the driver needs these. Python workers import this module too and would hold them as long as they live.
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    rows = training.where("toxic IN (0, 1)").select("doc_id", "text", F.col("toxic").cast("int").alias("toxic"))
    rows = cut_lineage(rows).coalesce(FIT_PARTS)  # stored from all tasks; only FIT_ROWS rows are left
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        return Model({}, None, None, float(max(totals, default=0)))
    known = lexicon(rows)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(3)).alias("part")
    sample = cut_lineage(with_features(rows, known, "features").select("toxic", part, array_to_vector("features").alias("vector")))
    trees = GBTClassifier(featuresCol="vector", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE, seed=7, cacheNodeIds=False)
    model = trees.fit(sample.where("part > 0"))
    odds = model.transform(sample.where("part = 0")).select(F.col("toxic").cast("double").alias("label"), vector_to_array("rawPrediction")[1].alias("odds"))
    odds = VectorAssembler(inputCols=["odds"], outputCol="x").transform(odds)
    if odds.isEmpty():
        return Model(known, None, None, totals[1] / sum(totals.values()))
    steps = IsotonicRegression(featuresCol="x", labelCol="label").fit(odds)
    return Model(known, model, (steps.boundaries.toArray().tolist(), steps.predictions.toArray().tolist()), 0.0)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows: at most FIT_ROWS documents with a label whose fold is not 0. The chosen labels,
    ids and marks only, are broadcast, so no text is shuffled."""
    marks = labels.where((remainder(5) != 0) & F.col("toxic").isin(0, 1)).select("doc_id", "toxic").distinct()
    chosen = marks.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(FIT_ROWS)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = fit(labelled(docs, table(spark, sf_dir, "labels"))).score(docs)
    return scored.select(
        "doc_id",
        F.coalesce(remainder(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
