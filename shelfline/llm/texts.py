"""Helpers shared by the text operators: reading tables, words, batches bounded by bytes."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: what separates words, as stated for the operators.
WORD = r"[^\x20\x09-\x0D]+"
WORD_BYTES = re.compile(rb"[^\x20\x09-\x0D]+")
# Texts are handed to a function in groups of about this many bytes (one text may be longer).
GROUP_BYTES = 4 << 20
# Bits of the filter of `may_be_among`: at most 2^19 rows of two longs are broadcast, at any size.
FILTER_BITS = 1 << 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def may_be_among(df: DataFrame, key: Column, ids: DataFrame, flag: str) -> DataFrame:
    """df with a boolean column that is false only where key is not in the one column of ids.

    Every id sets one of FILTER_BITS bits; their words are broadcast, so no row of df moves. A row that
    is true needs an exact join; with very many ids most rows are true and go through that join."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS).cast("bigint"))
    word, bits = fresh_name(df, "_word"), fresh_name(df, "_bits")
    spots = ids.select(place(F.col(ids.columns[0])).alias("at"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("at") % 64).cast("int"))
    words = spots.groupBy(F.floor(F.col("at") / 64).alias(word)).agg(F.bit_or(one).alias(bits))
    rows = df.withColumn(flag, place(key))
    rows = rows.join(F.broadcast(words), F.floor(F.col(flag) / 64) == F.col(word), "left")
    bit = F.call_function("shiftright", F.col(bits), (F.col(flag) % 64).cast("int")).bitwiseAND(F.lit(1).cast("bigint"))
    return rows.withColumn(flag, F.coalesce(bit == 1, F.lit(False))).drop(word, bits)


def groups(batch: pa.RecordBatch, text: str = "text", limit: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about `limit` bytes of text each."""
    start = size = 0
    for i, length in enumerate(pc.binary_length(batch.column(text)).fill_null(0).to_pylist()):
        if size and size + length > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += length
    if batch.num_rows > start:
        yield batch.slice(start)


def handing_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """`run` for a task, after which its Python worker gives free memory back to the system: workers
    outlive their tasks, and later stages of the executor need what they would go on holding."""

    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only where the C library has it
            if trim is not None:
                trim(0)

    return task


def map_texts(df: DataFrame, work: Callable[[pa.RecordBatch], dict], schema: str, text: str = "text", after: Callable[[], None] = lambda: None) -> DataFrame:
    """Runs `work` on groups of whole rows; it returns columns by name. No rows move between tasks.
    `after` drops what `work` has gathered, when the task ends and before memory is handed back."""
    names = [part.split()[0] for part in schema.split(", ")]  # ", " only between columns

    def run(batches):
        try:
            for batch in batches:
                for part in groups(batch, text):
                    found = work(part)
                    yield pa.RecordBatch.from_arrays([found[n] if isinstance(found[n], pa.Array) else pa.array(found[n]) for n in names], names)
        finally:
            after()

    return df.mapInArrow(handing_back(run), schema)
