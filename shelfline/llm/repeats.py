"""Exact removal of repeated passages with suffix arrays.

A byte goes if a string of LENGTH bytes over it also starts earlier in the corpus. Equal strings
contain the same smallest 16-gram at the same place, so the strings of a document are cut into
segments by that 16-gram, and only segments whose 16-gram occurs more than once are brought together,
with the bytes of their strings. Each task sorts the suffixes of such blocks in two stages, and runs
of adjacent common prefixes of LENGTH bytes are equal strings; all but the first occurrence count as
repeats. Equal segments are reduced to one before sorting, and whole copies of a document are set
aside before anything else. A 16-gram with more than HOT_ROWS segments is not gathered at all: its
strings are compared by digests in an ordinary aggregate, which spreads them.

Order is by doc_id, then by place. Cases: null text counts as empty; rows equal in doc_id and text are
one document and get the same result; of rows that share a doc_id but not the text, one takes part
(by a hash of the text) and the others are left whole, as are rows without doc_id and texts shorter
than LENGTH; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.shingles import mixed
from shelfline.llm.suffixes import common_prefixes, suffix_order, words_of
from shelfline.llm.texts import table
from shelfline.session import cut_lineage

LENGTH = 100
GRAM = 16
WINDOW = LENGTH - GRAM + 1
PIECE = 1 << 20
BLOCK_BYTES = 1 << 20
HOT_ROWS = 100_000
COPY, ASIDE = 1, 2
_FACTORS = {1: np.uint32(0x9E3779B1), 2: np.uint32(0x85EBCA77), 4: np.uint32(0xC2B2AE3D), 8: np.uint32(0x27D4EB2F)}


def segments(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """(64-bit hash of the 16-gram, first and number of the string starts that have it as smallest,
    and at how many places in a row it is that, over 1 where the text repeats itself at once)."""
    parts = [_segments(data[s : s + PIECE + LENGTH - 1]) for s in range(0, max(len(data) - LENGTH + 1, 0), PIECE)]
    if not parts:
        return np.zeros(0, np.int64), *(np.zeros(0, np.int32) for _ in range(3))
    shift = np.repeat(np.arange(len(parts)) * PIECE, [len(p[0]) for p in parts])
    keys, first, size, runs = (np.concatenate(x) for x in zip(*parts))
    return keys.view(np.int64), (first + shift).astype(np.int32), size.astype(np.int32), runs.astype(np.int32)


def _segments(data: np.ndarray) -> tuple[np.ndarray, ...]:
    grams, reach = data.astype(np.uint32) + np.uint32(1), 1
    while reach < GRAM:
        grams, reach = grams[:-reach] * _FACTORS[reach] + grams[reach:], 2 * reach
    grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    # Hash and place in one number: the minimum is the leftmost smallest.
    least = (grams.astype(np.uint64) << np.uint64(32)) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while 2 * reach <= WINDOW:
        least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
    if reach < WINDOW:
        least = np.minimum(least[: -(WINDOW - reach)], least[WINDOW - reach :])
    place = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    spot = place[starts]
    halves = [np.zeros(len(spot), np.uint64), np.zeros(len(spot), np.uint64)]
    for half in (0, 1):
        for j in range(8):
            halves[half] = (halves[half] << np.uint64(8)) | data[spot + 8 * half + j]
    keys = mixed(mixed(halves[0]) + halves[1])
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))  # neighbours of equal hash are one
    ends = np.append(starts[1:], len(place))
    return keys[new], starts[new], np.append(ends[new[1:] - 1], ends[-1]) - starts[new], np.diff(np.append(new, len(keys)))


def _segment_rows(base: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for doc, text, state in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "state"))):
                if doc is None or state is not None:
                    continue
                keys, first, size, runs = segments(np.frombuffer(text.encode(), np.uint8))
                if len(keys):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (keys, np.full(len(keys), doc, np.int64), first, size, runs)], ["gram", "doc_id", "first", "size", "runs"])

    # Rows are left out above and not by a filter, which would move below the shuffle of the documents
    # and keep it from being shared with the other parts of the plan.
    return base.select("doc_id", "text", "state").mapInArrow(_joined(run), "gram bigint, doc_id bigint, first int, size int, runs int")


def _joined(run, rows: int = 20_000):
    """Small batches of `run` put together."""

    def joined(batches):
        kept, count = [], 0
        for part in run(batches):
            kept.append(part)
            count += part.num_rows
            if count >= rows:
                yield from pa.Table.from_batches(kept).combine_chunks().to_batches()
                kept, count = [], 0
        if kept:
            yield from pa.Table.from_batches(kept).combine_chunks().to_batches()

    return joined


def _base(docs: DataFrame) -> DataFrame:
    """doc_id, text and `state`: COPY for a whole copy of an earlier document, ASIDE for a row whose
    doc_id stands for another text."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    long_rows = rows.where((F.octet_length("text") >= LENGTH) & F.col("doc_id").isNotNull())
    digests = cut_lineage(long_rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest")).distinct())
    firsts = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")).where("rows > 1")
    copies = digests.join(firsts, "digest").where("doc_id <> first").select("doc_id", "text_key", F.lit(COPY).alias("state"))
    double = digests.groupBy("doc_id").agg(F.min("text_key").alias("used"), F.count("*").alias("rows")).where("rows > 1")
    aside = digests.join(double, "doc_id").where("text_key <> used").select("doc_id", "text_key", F.lit(ASIDE).alias("state"))
    states = copies.unionByName(aside).groupBy("doc_id", "text_key").agg(F.min("state").alias("state"))
    states = cut_lineage(states.groupBy("doc_id").agg(F.map_from_entries(F.collect_set(F.struct("text_key", "state"))).alias("states")))
    joined = rows.join(states, "doc_id", "left")
    return joined.select("doc_id", "text", F.when(F.col("states").isNotNull(), F.element_at("states", F.xxhash64("text"))).alias("state"))


def _contexts(base: DataFrame, marks: DataFrame) -> DataFrame:
    """Marked segments with their bytes: the strings that start in them, whole."""
    lists = marks.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "first", "size", "runs")).alias("marks"))
    rows = base.join(lists, "doc_id", "left")

    def run(batches):
        for batch in batches:
            docs, texts, states = (batch.column(n).to_pylist() for n in ("doc_id", "text", "state"))
            lists = batch.column("marks")
            for i in range(batch.num_rows):
                if not lists[i].is_valid or states[i] is not None:
                    continue
                flat, data = lists[i].values, texts[i].encode()
                first, size = flat.field("first"), flat.field("size")
                bytes_of = [data[a : a + n + LENGTH - 1] for a, n in zip(first.to_pylist(), size.to_pylist()) if a + n + LENGTH - 1 <= len(data)]
                if len(bytes_of) < len(first):
                    continue  # a short row that shares its doc_id with the marked one
                doc = pa.array(np.full(len(bytes_of), docs[i], np.int64))
                yield pa.RecordBatch.from_arrays([flat.field("gram"), doc, first, size, flat.field("runs"), pa.array(bytes_of, pa.binary())], ["gram", "doc_id", "first", "size", "runs", "data"])

    rows = rows.select("doc_id", "text", "state", "marks")
    return rows.mapInArrow(_joined(run), "gram bigint, doc_id bigint, first int, size int, runs int, data binary")


class _Sorter:
    """Blocks of different segments; `flush` returns the repeats among their strings."""

    def __init__(self):
        self.rows: list[tuple[int, int, int, bytes]] = []  # doc_id, first, size, bytes
        self.size = 0

    def add(self, rows: list[tuple[int, int, int, bytes]]) -> None:
        self.rows += rows
        self.size += sum(len(r[3]) for r in rows)

    def flush(self) -> list[tuple[int, int, int]]:
        rows, self.rows, self.size = self.rows, [], 0
        if not rows:
            return []
        text = np.frombuffer(b"".join(r[3] for r in rows), np.uint8)
        lengths = np.array([len(r[3]) for r in rows])
        begins = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(rows)), lengths)
        offset = np.arange(len(text)) - begins[owner]
        strings = np.array([r[2] for r in rows])
        needed = offset < strings[owner]
        words = words_of(np.concatenate([text, np.array([0, 1], np.uint8)]), LENGTH)
        order = suffix_order(text, needed, LENGTH, words)
        group = np.cumsum(common_prefixes(order, words, LENGTH) < LENGTH) - 1
        _, rank = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)
        firsts = np.array([r[1] for r in rows], np.int64)
        when = (rank.astype(np.int64)[owner[order]] << 32) | (firsts[owner[order]] + offset[order])
        heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        earliest = np.minimum.reduceat(when, heads)
        again = np.sort(order[when != earliest[group]])
        if not len(again):
            return []
        cut = np.flatnonzero((np.diff(again) != 1) | (np.diff(owner[again]) != 0)) + 1
        begin, last = again[np.concatenate([[0], cut])], again[np.concatenate([cut - 1, [len(again) - 1]])]
        return [(rows[o][0], int(rows[o][1] + offset[a]), int(rows[o][1] + offset[b] + LENGTH)) for o, a, b in zip(owner[begin].tolist(), begin.tolist(), last.tolist())]


def _repeats(contexts: DataFrame) -> DataFrame:
    """(doc_id, start, end) of bytes covered by repeats, from segments gathered by 16-gram."""

    def run(batches):
        sorter, gram, kept, seen, single = _Sorter(), None, [], set(), True
        for batch in batches:
            found: list[tuple[int, int, int]] = []
            for g, runs, *row in zip(*(batch.column(c).to_pylist() for c in ("gram", "runs", "doc_id", "first", "size", "data"))):
                if g != gram:
                    if not single:
                        sorter.add(kept)
                        if sorter.size >= BLOCK_BYTES:
                            found += sorter.flush()
                    gram, kept, seen, single = g, [], set(), True
                if row[3] in seen:  # rows come in order, so an equal segment was earlier
                    found.append((row[0], row[1], row[1] + row[2] + LENGTH - 1))
                else:
                    single = not kept and runs == 1  # one segment that does not repeat itself
                    seen.add(row[3])
                    kept.append(tuple(row))
            if found:
                yield _ranges(found)
        if not single:
            sorter.add(kept)
        yield _ranges(sorter.flush())

    rows = contexts.repartition("gram").sortWithinPartitions("gram", "doc_id", "first")
    return rows.mapInArrow(run, "doc_id bigint, start int, end int")


def _ranges(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], k) for i, k in enumerate(kinds)], ["doc_id", "start", "end"])


def _hot_repeats(contexts: DataFrame) -> DataFrame:
    """The same for 16-grams that are everywhere: one row per string, compared by digest."""

    def run(batches):
        for batch in batches:
            for doc, first, size, data in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "first", "size", "data"))):
                digests = [hashlib.blake2b(data[i : i + LENGTH], digest_size=16).digest() for i in range(size)]
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(np.full(size, doc, np.int64)), pa.array(np.arange(first, first + size, dtype=np.int32))], ["digest", "doc_id", "start"])

    rows = contexts.mapInArrow(_joined(run), "digest binary, doc_id bigint, start int")
    earliest = rows.groupBy("digest").agg(F.min(F.struct("doc_id", "start")).alias("earliest"), F.count("*").alias("rows")).where("rows > 1")
    again = rows.join(earliest, "digest").where(F.struct("doc_id", "start") != F.col("earliest"))
    return again.select("doc_id", "start", (F.col("start") + LENGTH).alias("end"))


def without_repeats(docs: DataFrame, hot_rows: int = HOT_ROWS, kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with `kept`, the remaining bytes.

    One plan: the shuffle of the documents by id is used by every part of it."""
    base = _base(docs)
    rows = _segment_rows(base)
    counts = rows.groupBy("gram").agg(F.sum("runs").alias("rows")).where("rows > 1")
    marked = rows.join(counts, "gram")  # a 16-gram at one place only cannot be part of a repeat
    usual = _repeats(_contexts(base, marked.where(F.col("rows") <= hot_rows)))
    hot = _hot_repeats(_contexts(base, marked.where(F.col("rows") > hot_rows)))
    ranges = usual.unionByName(hot).groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    joined = base.join(ranges, "doc_id", "left").select("doc_id", "text", "state", "ranges")
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept binary" * kept

    def run(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            lists = batch.column("ranges")
            for i, (text, state) in enumerate(zip(batch.column("text").to_pylist(), batch.column("state").to_pylist())):
                data = text.encode()
                usable = lists[i].is_valid and state is None and len(data) >= LENGTH
                spans = [(0, len(data))] if state == COPY else merged(lists[i].values) if usable else []
                rest, at = [], 0
                for start, end in spans:
                    rest.append(data[at:start])
                    at = end
                remaining = b"".join([*rest, data[at:]])
                for column, value in zip(out, (len(data), len(data) - len(remaining), len(spans), hashlib.sha256(remaining).hexdigest(), remaining)):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 if kept else 4]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, k) for v, k, _ in zip(out, kinds, names))], ["doc_id", *names])

    return joined.mapInArrow(run, schema)


def merged(ranges: pa.StructArray) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    start, end = (ranges.field(n).to_numpy() for n in ("start", "end"))
    by = np.argsort(start, kind="stable")
    start, end = start[by], np.maximum.accumulate(end[by])
    new = np.flatnonzero(np.concatenate([[True], start[1:] > end[:-1]]))
    return list(zip(start[new].tolist(), end[np.append(new[1:] - 1, len(end) - 1)].tolist()))


def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
