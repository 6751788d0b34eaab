"""Benchmark decontamination by the q-gram lemma.

Benchmark items are cut into segments. An occurrence of a segment of m characters with at most e
edits shares at least m + 1 - q * (e + 1) q-grams with the text, all on e + 1 neighbouring diagonals
(text place minus segment place). So q-grams of the text that occur in the benchmark are counted
per segment in overlapping bands of diagonals; bands that reach the bound are verified by banded
alignment against the text. The filter loses nothing within the edit budget.

Texts are compared without regard to case, and all white space is alike. Segments are SEGMENT
characters long, one every SEGMENT / 2, so a passage of one and a half segments of an item is found
even where the rest is missing. An item of up to WHOLE characters is a segment as a whole too, with a
budget that a replaced word of usual length stays within; in longer items one replaced word always
leaves a segment untouched. Items under EXACT characters are found only unchanged and between word
boundaries. Those of a single word, or of fewer than Q characters, prove nothing and are not searched.

Cases: null text has no leaks; null or empty items are not searched; an empty benchmark leaves all
documents clean; equal items are each reported; repeated documents are searched alike.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.texts import fresh_name, map_texts, table

Q = 8  # a power of two
SEGMENT = 40
WHOLE = 2 * SEGMENT + Q
EXACT = 24
SHARED = 9  # q-grams that an occurrence with all its edits still shares
# Segments sent to the tasks at once (about 100 bytes each there); more are searched in further passes.
BLOCK_SEGMENTS = 50_000
BITMAP_BITS = 22
_FACTORS = {1: np.uint32(0x9E3779B1), 2: np.uint32(0x85EBCA77), 4: np.uint32(0xC2B2AE3D)}
_MIX = np.uint32(0x27D4EB2F)
OUTSIDE = np.uint32(0xFFFFFFFF)  # no code point


def folded(text: str) -> np.ndarray:
    """Code points in lower case, one per character of the text, white space as blanks."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    for blank in "\t\n\x0b\f\r":
        low = low.replace(blank, " ")
    return np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """32-bit hashes of the q-grams, each of two hashes of half the length. Equal hashes of different
    q-grams only add candidates."""
    if len(codes) < Q:
        return np.zeros(0, np.uint32)
    out, reach = codes, 1
    while reach < Q:
        out, reach = out[:-reach] * _FACTORS[reach] + out[reach:], 2 * reach
    return (out ^ (out >> np.uint32(15))) * _MIX


def budget(length: int) -> int:
    """Edits allowed: as many as leave SHARED q-grams by the lemma; none for items under EXACT characters."""
    return 0 if length < EXACT else (length + 1 - SHARED) // Q - 1


def segments(items: list[tuple[int, str]]) -> list[tuple[int, int, np.ndarray]]:
    """(item, start, code points) of every segment."""
    out = []
    for item, text in items:
        codes = folded(text.strip())
        if len(codes) < Q or (len(codes) < EXACT and ord(" ") not in codes):
            continue
        if len(codes) <= WHOLE:
            out.append((item, 0, codes))
        if len(codes) > SEGMENT:
            starts = list(range(0, len(codes) - SEGMENT + 1, SEGMENT // 2))
            if starts[-1] + SEGMENT < len(codes):
                starts.append(len(codes) - SEGMENT)
            out += [(item, s, codes[s : s + SEGMENT]) for s in starts]
    return out


class Index:
    """q-grams of a block of segments, sorted by hash."""

    def __init__(self, found: list[tuple[int, int, np.ndarray]]):
        self.items = np.array([item for item, _, _ in found], np.int64)
        self.codes = [codes for _, _, codes in found]
        self.edits = np.array([budget(len(c)) for c in self.codes], np.int64)
        self.lengths = np.array([len(c) for c in self.codes], np.int64)
        self.bound = self.lengths + 1 - Q * (self.edits + 1)
        self.band = int(self.edits.max()) + 1  # bands of twice this width, one every such width
        hashes = [gram_hashes(c) for c in self.codes]
        owner = np.repeat(np.arange(len(hashes)), [len(h) for h in hashes])
        place = np.concatenate([np.arange(len(h)) for h in hashes])
        flat = np.concatenate(hashes)
        order = np.argsort(flat, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.hashes, self.first, self.count = np.unique(flat[order], return_index=True, return_counts=True)
        self.bits = np.zeros(1 << BITMAP_BITS, bool)
        self.bits[self.hashes >> np.uint32(32 - BITMAP_BITS)] = True

    def _dense(self, at: np.ndarray) -> np.ndarray:
        """Which places lie among enough others: an occurrence spans at most a segment plus its edits
        and holds as many shared q-grams, at different places, as the smallest bound asks for."""
        least, span = int(self.bound.min()), int((self.lengths + self.edits).max())
        if len(at) < least:
            return np.zeros(len(at), bool)
        first = np.flatnonzero(at[least - 1 :] - at[: len(at) - least + 1] < span)
        steps = np.zeros(len(at) + 1, np.int64)
        steps[first] += 1  # places are distinct
        steps[first + least] -= 1
        return np.cumsum(steps[:-1]) > 0

    def search(self, text: str) -> list[tuple[int, int, int]]:
        """(item, end in the text, edits), each verified; one per band that holds an occurrence."""
        codes = folded(text)
        grams = gram_hashes(codes)
        at = np.flatnonzero(self.bits.take(grams >> np.uint32(32 - BITMAP_BITS)))
        at = at[self._dense(at)]
        if not len(at):
            return []
        spot = np.minimum(np.searchsorted(self.hashes, grams[at]), len(self.hashes) - 1)
        real = self.hashes[spot] == grams[at]
        at, spot = at[real], spot[real]
        near = self._dense(at)
        at, spot = at[near], spot[near]
        if not len(at):
            return []
        low, count = self.first[spot], self.count[spot]
        total = int(count.sum())
        steps = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
        hit = np.repeat(low, count) + steps
        diagonal = np.repeat(at, count) - self.place[hit] + WHOLE  # above zero
        band = diagonal // self.band
        # A run of e + 1 diagonals lies in one band or crosses into the next: each hit counts in both.
        wide = np.int64(len(codes) // self.band + WHOLE + 4)
        keys = self.owner[hit] * wide + band
        keys, counts = np.unique(np.concatenate([keys, keys - 1]), return_counts=True)
        owner = keys // wide
        keep = counts >= self.bound[owner]
        if not keep.any():
            return []
        owner, start = owner[keep], (keys[keep] % wide) * self.band - WHOLE
        short = self.lengths[owner] < EXACT
        found = self._whole_words(codes, np.unique(owner[short])) if short.any() else set()
        owner, start = owner[~short], start[~short]
        edits, ends = self._align(codes, owner, start)
        good = edits <= self.edits[owner]
        return sorted(found | {(int(self.items[o]), int(e), int(d)) for o, e, d in zip(owner[good], ends[good], edits[good])})

    def _whole_words(self, codes: np.ndarray, owner: np.ndarray) -> set[tuple[int, int, int]]:
        """Occurrences of short items that no letter or digit touches."""
        plain = lambda c: c.tobytes().decode("utf-32-le", "surrogatepass")
        text = plain(codes)
        return {(int(self.items[o]), m.end(), 0) for o in owner for m in re.finditer(rf"(?<!\w){re.escape(plain(self.codes[o]))}(?!\w)", text)}

    def _align(self, codes: np.ndarray, owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Fewest edits of each segment inside its band, and where that occurrence ends. The table is
        kept by diagonal: width of the band plus the edit budget on both sides. Longer segments come
        first, so the rows that still have characters are always the first ones."""
        slack = self.band
        width = 2 * self.band + 2 * slack
        edits, ends = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
        columns = np.arange(width, dtype=np.int32)
        order = np.argsort(-self.lengths[owner], kind="stable")
        for part in np.array_split(order, max(1, len(order) // 20_000)):
            lengths, first = self.lengths[owner[part]], start[part] - slack
            longest = int(lengths.max(initial=0))
            segment = np.full((len(part), longest), OUTSIDE, np.uint32)
            for row, o in enumerate(owner[part]):
                segment[row, : len(self.codes[o])] = self.codes[o]
            place = first[:, None] + np.arange(longest + width)
            inside = (place >= 0) & (place < len(codes))
            window = np.where(inside, codes[np.clip(place, 0, len(codes) - 1)], OUTSIDE)
            cost = np.zeros((len(part), width), np.int32)
            active = np.searchsorted(-lengths, -np.arange(longest), "left")
            for i, n in enumerate(active.tolist()):
                now = cost[:n]
                step = now + (window[:n, i : i + width] != segment[:n, i : i + 1])
                np.minimum(step[:, :-1], now[:, 1:] + 1, out=step[:, :-1])
                step -= columns
                np.minimum.accumulate(step, axis=1, out=step)
                np.add(step, columns, out=now)
            best = np.argmin(cost, axis=1)
            edits[part], ends[part] = cost[np.arange(len(part)), best], np.clip(first + best + lengths, 0, len(codes))
        return edits, ends


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key and `leaks` (item_id, text_end, edits) of every row of docs, in blocks of
    benchmark segments of bounded size; the documents are not shuffled unless there are several."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = [_search(rows, block) for block in _blocks(benchmark)]
    if not parts:
        return rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.array().cast("array<struct<item_id:bigint,text_end:int,edits:int>>").alias("leaks"))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    if len(parts) > 1:
        out = out.groupBy("doc_id", "text_key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("leaks")))).alias("leaks"))
    return out


def _blocks(benchmark: DataFrame):
    block: list = []
    for row in benchmark.where("text IS NOT NULL").select("item_id", "text").toLocalIterator():
        block += segments([(row["item_id"], row["text"])])
        if len(block) >= BLOCK_SEGMENTS:
            yield block
            block = []
    if block:
        yield block


def _search(rows: DataFrame, block: list) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(block)
    kept: list[Index] = []

    def work(batch: pa.RecordBatch) -> dict:
        if not kept:
            kept.append(Index(shared.value))
        found = [[{"item_id": i, "text_end": e, "edits": d} for i, e, d in kept[0].search(t or "")] for t in batch.column("text").to_pylist()]
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("text_end", pa.int32()), ("edits", pa.int32())]))
        return {"doc_id": batch.column("doc_id"), "text_key": batch.column("text_key"), "leaks": pa.array(found, kind)}

    return map_texts(rows.withColumn("text_key", F.xxhash64("text")), work, "doc_id bigint, text_key bigint, leaks array<struct<item_id:bigint,text_end:int,edits:int>>")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs without the rows that hold a passage of the benchmark; the other rows as they were."""
    key, at, marks = fresh_name(docs, "_text_key"), fresh_name(docs, "_leak_id"), fresh_name(docs, "_leak_key")
    leaky = find_leaks(docs, benchmark).where(F.size("leaks") > 0).select(F.col("doc_id").alias(at), F.col("text_key").alias(marks))
    rows = docs.withColumn(key, F.xxhash64(F.col("text").cast("string")))
    return rows.join(leaky, rows["doc_id"].cast("bigint").eqNullSafe(leaky[at]) & (rows[key] == leaky[marks]), "left_anti").select(*docs.columns)


def op4_qgram_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform("leaks", lambda x: x["item_id"])))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.size(items).cast("bigint").alias("n_items"), items.alias("item_ids"), F.array_min(F.transform("leaks", lambda x: x["edits"])).alias("least_edits"))
