"""Embedding whitening through a bidiagonal qd solver.

Entries become whole numbers, their sums per dimension are exact. Every task reduces its centred rows
block by block to one triangular factor; factors are merged pairwise on the executors and 16 at most
reach the driver, each width x width numbers. There the last factor is made bidiagonal and solved (see
`bidiagonal`). Whitened rows are made where the rows lie; only sums and factors are moved.

Rows whose vector is null or holds null, NaN or infinite entries are left out. A shorter vector goes on
with zeros. Components without variance are not returned, so equal rows alone give no result, as does an
empty table. Rows with a null id and repeated rows are kept and count each. Entries beyond +-2^40 count
as that; a deviation beyond a long is null, its exact value is in deviation_exact as text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.bidiagonal import right_vectors
from shelfline.llm.texts import fresh_name, table
from shelfline.llm.vectors import blocks, finite, merged

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
LIMIT = float(1 << 40)
LONGEST = float(1 << 62)


def whole(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * entry) as whole doubles; SHIFT is left to the sums, where it stays exact."""
    return np.floor(np.clip(x * SCALE, -LIMIT, LIMIT))


def _sums(parts: list[bytes]) -> bytes:
    rows = [np.frombuffer(p, np.int64) for p in parts]
    out = np.zeros(max(len(r) for r in rows), np.int64)
    for r in rows:
        out[: len(r)] += r
    return out.tobytes()


def _factors(parts: list[bytes]) -> bytes:
    found = [np.frombuffer(p) for p in parts]
    width = int(np.sqrt(len(found[0])))
    return _square(np.vstack([f.reshape(width, width) for f in found])).tobytes()


def _square(rows: np.ndarray) -> np.ndarray:
    """Triangular factor of rows, filled up to a square."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])


def _plus(parts: list[bytes]) -> bytes:
    return sum(np.frombuffer(p) for p in parts).tobytes()


def _binary(rows: DataFrame, fold, merge, width: int = 0) -> bytes | None:
    """One binary result of `fold` over the dense blocks of every task, merged."""

    def work(batches):
        held = None
        for _, x in blocks(batches, "v", width):
            if len(x):
                part = fold(whole(x))
                held = part if held is None else merge([held, part])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary())], ["part"])

    parts = merged(rows.select("v").mapInArrow(work, "part binary"), merge)
    return merge(parts) if parts else None


@dataclass
class Whitening:
    """n, exact sums S per dimension (without SHIFT), components as columns and their variances."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.sums / self.n) @ self.components / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> tuple[list[int | None], list[str]]:
        """Sum over dimensions of (n x - S)^2, exact: in longs where they suffice, else in whole Python numbers."""
        apart = x.astype(np.int64).astype(object) * self.n - self.sums.astype(object) if self._wide(x) else x.astype(np.int64) * self.n - self.sums
        exact = [int(d) for d in (apart * apart).sum(axis=1)]
        return [d if d < 1 << 63 else None for d in exact], [str(d) for d in exact]

    def _wide(self, x: np.ndarray) -> bool:
        most = np.abs(x * float(self.n) - self.sums.astype(float)).max(initial=0.0)
        return most * most * max(1, x.shape[1]) >= LONGEST or np.abs(x).max(initial=0.0) * self.n >= LONGEST


def usable(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """df's rows that take part, with the vector as array<double> under a new last column."""
    return df.where(finite(df[vector])).withColumn(fresh_name(df, "_vector"), df[vector].cast("array<double>"))


def fit(rows: DataFrame, vector: str, components: int = COMPONENTS) -> Whitening | None:
    """Components of all rows of an array<double> column; None without rows. Three passes over that column."""
    rows = rows.select(rows[vector].alias("v"))

    def summed(x: np.ndarray) -> bytes:
        return np.r_[len(x), x.astype(np.int64).sum(axis=0)].tobytes()

    found = _binary(rows, summed, _sums)
    if found is None:
        return None
    n, sums = int(np.frombuffer(found, np.int64)[0]), np.frombuffer(found, np.int64)[1:]
    width, mean = len(sums), sums / n
    if not width:
        return Whitening(n, sums, np.zeros((0, 0)), np.zeros(0), 0.0)
    r = np.frombuffer(_binary(rows, lambda x: _square(x - mean).tobytes(), _factors, width)).reshape(width, width)
    squares, vectors = right_vectors(r, min(components, width))
    model = Whitening(n, sums, vectors, squares / n, float((r * r).sum() / n))
    if len(squares):

        def products(x: np.ndarray) -> bytes:
            y = model.project(x)
            return np.vstack([y.sum(axis=0), y.T @ y]).tobytes()

        moments = np.frombuffer(_binary(rows, products, _plus, width)).reshape(-1, len(squares)) / n
        model.identity_error = float(np.abs(moments[1:] - np.outer(moments[0], moments[0]) - np.eye(len(squares))).max())
    return model


def transform(df: DataFrame, vector: str, model: Whitening | None, key: str) -> DataFrame:
    """key, the whitened vector and deviation (null beyond a long) and deviation_exact of every row of df."""
    kind = dict(df.dtypes)[key]
    shared = df.sparkSession.sparkContext.broadcast(model)  # width x components numbers

    def work(batches):
        model = shared.value
        for part, x in blocks(batches, "v", len(model.sums) if model else 0):
            if model is None or not len(x):
                continue
            x = whole(x)
            short, exact = model.deviations(x)
            y = model.project(x)
            white = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * y.shape[1], pa.int32()), pa.array(y.ravel()))
            yield pa.RecordBatch.from_arrays([part.column("k"), white, pa.array(short, pa.int64()), pa.array(exact)], [key, "whitened", "deviation", "deviation_exact"])

    return df.select(df[key].alias("k"), df[vector].alias("v")).mapInArrow(work, f"`{key}` {kind}, whitened array<double>, deviation bigint, deviation_exact string")


def op12_qd_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per usable row of `embeddings` and component."""
    rows = usable(table(spark, sf_dir, "embeddings"))
    return by_component(rows, rows.columns[-1])


def by_component(rows: DataFrame, vector: str) -> DataFrame:
    model = fit(rows, vector)
    found = transform(rows, vector, model, "vec_id")
    shares = [float(v / model.total) for v in model.variances] if model else []
    out = found.select("vec_id", F.posexplode("whitened").alias("place", "whitened"), "deviation", "deviation_exact")
    explained = F.element_at(F.array(*map(F.lit, shares)) if shares else F.array().cast("array<double>"), F.col("place") + 1)
    return out.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), (F.col("place") + 1).cast("int").alias("component"),
        F.lit(model.n if model else 0).cast("bigint").alias("n"), "deviation", "whitened", explained.alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"), "deviation_exact",
    )
