"""Preparation of a text collection: five stages, each working on all that the one before kept.

toxicity drops documents that the model rejects; line_dedup removes cross-site boilerplate lines;
near_dedup keeps one document of each group of near copies (five-word shingles, similarity 0.8);
decontamination drops documents that hold benchmark passages; bpe encodes what is left, decodes it
again and returns token counts and digests instead of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import bpe, leaks, minhash, site_lines, toxicity
from shelfline.llm.texts import GROUP_BYTES, fresh_name, table
from shelfline.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """`stage` with rows sent to Python workers in batches of about GROUP_BYTES. The default, 10,000 rows or
    64 MB, is held at once by the JVM and the worker of every task, next to the heap. The setting stays on
    the session: a stage returns before Spark runs it."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(GROUP_BYTES))
        return stage(spark, docs, sf_dir)

    return run


@in_small_batches
def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(toxicity.labelled(docs, table(spark, sf_dir, "labels")))
    score = fresh_name(docs, "_score")
    return model.score(docs, score).where(F.col(score) < 0.5).select(*docs.columns)


@in_small_batches
def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = site_lines.without_boilerplate(docs)
    removed = rows[rows.columns[-1]]  # the operator's count comes last
    kinds = dict(docs.dtypes)
    chars = F.when(removed > 0, F.length("text").cast(kinds["n_chars"])).otherwise(F.col("n_chars")) if "n_chars" in kinds else None
    return rows.select(*[chars.alias(c) if c == "n_chars" else rows[c] for c in docs.columns])


@in_small_batches
def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.one_of_each(docs, minhash.Plan(words=5, percent=80))


@in_small_batches
def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


@in_small_batches
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs, bpe.vocabulary())


STAGES = [
    ("toxicity", remove_toxic),
    ("line_dedup", remove_boilerplate),
    ("near_dedup", remove_near_copies),
    ("decontamination", remove_leaks),
    ("bpe", encode),
]

# Trained trees, sketches and tokens have no SQL form; tests hold the result against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each stored in the shared folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
