"""Helpers shared by the vector operators: usable rows, dense blocks, merging small results of tasks."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Results of tasks that the driver reads at most; more are merged on the executors first.
LAST_PARTS = 16
# Arrays are handed to numpy in blocks of about this many bytes.
BLOCK_BYTES = 8 << 20


def finite(vector: Column) -> Column:
    """True where the array is not null and holds no null, NaN or infinite entry."""
    whole = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < F.lit(float("inf")))
    return F.coalesce(vector.isNotNull() & F.forall(vector, whole), F.lit(False))


def dense(column: pa.Array, width: int = 0) -> np.ndarray:
    """Rows of an array column as doubles; a shorter vector goes on with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = max(width, int(lengths.max(initial=0)))
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def blocks(batches, column: str, width: int = 0):
    """(record batch, dense matrix) in slices of bounded size."""
    for batch in batches:
        step = max(1, BLOCK_BYTES // (8 * max(1, width or _widest(batch.column(column)))))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield part, dense(part.column(column), width)


def _widest(column: pa.Array) -> int:
    return int(np.diff(column.offsets.to_numpy()).max(initial=1))


def merged(parts: DataFrame, merge: Callable[[list[bytes]], bytes]) -> list[bytes]:
    """One binary row per task of `parts`, merged on the executors until LAST_PARTS are left at most."""

    def work(batches):
        held = None
        for batch in batches:
            for item in batch.column(0).to_pylist():
                held = item if held is None else merge([held, item])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held], pa.binary())], ["part"])

    rows = parts.repartition(LAST_PARTS).mapInArrow(work, "part binary")
    return [bytes(r["part"]) for r in rows.collect()]
