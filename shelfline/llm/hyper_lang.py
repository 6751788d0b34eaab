"""Language identification with hyperdimensional profiles.

Every letter has a random +1/-1 vector. A trigram's vector binds (multiplies) its letters' vectors,
each permuted (rotated) by its place. A text is the bundle (sum) of its trigram vectors, a language
prototype the bundle of all its training texts, and a text gets the language whose prototype has
the highest cosine. Letter vectors come from the code point alone, so every task makes the same.

Training texts are bundled inside the tasks; only sums per language and dimension are shuffled.
Cases: null text, or text without a letter, gives `und` with score 0; without any training text
every text is `und`. Ties go to the language that sorts first. Repeated rows are scored alike.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.texts import map_texts, table

DIMENSIONS = 1024
UNKNOWN = "und"
# Trigram vectors kept per worker: DIMENSIONS bytes each, emptied when full.
KEPT_TRIGRAMS = 60_000
OTHERS = regex.compile(r"[^\p{L}]+")


@lru_cache(maxsize=20_000)
def letter_vector(code: int, dimensions: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(code)).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1


class Space:
    """Trigram vectors of one dimension count, made on first use."""

    def __init__(self, dimensions: int):
        self.dimensions, self.rows = dimensions, {}
        self.matrix = np.zeros((1024, dimensions), np.int8)

    def row(self, trigram: int) -> int:
        at = self.rows.get(trigram)
        if at is None:
            at = len(self.rows)
            if at == len(self.matrix):
                self.matrix = np.vstack([self.matrix, np.zeros_like(self.matrix)])
            letters = (trigram >> 42, trigram >> 21 & 0x1FFFFF, trigram & 0x1FFFFF)
            first, second, third = (letter_vector(c, self.dimensions) for c in letters)
            self.matrix[at] = np.roll(first, 2) * np.roll(second, 1) * third
            self.rows[trigram] = at
        return at

    def bundle(self, text: str) -> np.ndarray | None:
        """Sum of the text's trigram vectors, None without a letter. Case and all that is not a
        letter (one space each) do not count."""
        letters = OTHERS.sub(" ", text).strip()
        if not letters:
            return None
        codes = np.frombuffer(f" {letters.lower()} ".encode("utf-32-le"), np.uint32).astype(np.int64)
        found, counts = np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)
        if len(self.rows) + len(found) > KEPT_TRIGRAMS:
            self.rows.clear()
        total = np.zeros(self.dimensions, np.float64)
        for part in range(0, len(found), 4096):
            rows = [self.row(t) for t in found[part : part + 4096].tolist()]
            total += counts[part : part + 4096].astype(np.float32) @ self.matrix[rows].astype(np.float32)
        return total


@lru_cache(maxsize=2)
def space(dimensions: int) -> Space:
    return Space(dimensions)


def prototypes(training: DataFrame, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Language to its bundle. training: text and lang; rows with null in either are left out.

    Each group of texts yields one sum per language; adding them up shuffles languages times
    dimensions numbers per task, and the driver gets languages times dimensions numbers. Texts are
    scaled to the same number of trigrams, in whole numbers, so sums do not depend on order."""

    def work(batch: pa.RecordBatch) -> dict:
        sums: dict[str, np.ndarray] = {}
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
            found = space(dimensions).bundle(text)
            if found is not None:
                norm = np.sqrt(found @ found) or 1.0
                sums.setdefault(lang, np.zeros(dimensions, np.int64))
                sums[lang] += np.rint(found * (1e6 / norm)).astype(np.int64)
        return {"lang": pa.array(list(sums), pa.string()), "sums": pa.array([v.tolist() for v in sums.values()], pa.list_(pa.int64()))}

    rows = training.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    parts = map_texts(rows, work, "lang string, sums array<bigint>")
    totals = parts.select("lang", F.posexplode("sums").alias("place", "part")).groupBy("lang", "place").agg(F.sum("part").alias("total"))
    found: dict[str, np.ndarray] = {}
    for row in totals.collect():
        found.setdefault(row["lang"], np.zeros(dimensions))[row["place"]] = row["total"]
    return dict(sorted(found.items()))


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], dimensions: int = DIMENSIONS) -> DataFrame:
    """doc_id, lang_pred and score (cosine, at least 0) for every row of docs."""
    names = list(profiles)
    matrix = np.array([profiles[n] / (np.linalg.norm(profiles[n]) or 1.0) for n in names]).reshape(len(names), dimensions)
    shared = docs.sparkSession.sparkContext.broadcast((names, matrix))  # languages x dimensions numbers

    def work(batch: pa.RecordBatch) -> dict:
        names, matrix = shared.value
        best, scores = [], []
        for text in batch.column("text").to_pylist():
            found = space(dimensions).bundle(text or "") if names else None
            norm = np.sqrt(found @ found) if found is not None else 0.0
            if not norm:
                best.append(UNKNOWN), scores.append(0.0)
                continue
            cosines = matrix @ found / norm
            at = int(np.argmax(cosines))
            best.append(names[at]), scores.append(float(min(1.0, max(0.0, cosines[at]))))
        return {"doc_id": batch.column("doc_id"), "lang_pred": pa.array(best, pa.string()), "score": pa.array(scores, pa.float64())}

    rows = docs.select(docs["doc_id"].cast("bigint").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return map_texts(rows, work, "doc_id bigint, lang_pred string, score double")


def remainder(parts: int) -> Column:
    """The fold of a document: crc32 of its id as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts))


def op6_hyper_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    profiles = prototypes(docs.where(~held_out))
    return identify(docs, profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
