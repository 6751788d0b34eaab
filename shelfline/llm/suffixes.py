"""Two-stage suffix sorting in array code, to a bounded depth, with adjacent common prefixes.

Only suffixes that are smaller than their successor are sorted directly. All others are induced: the
buckets (by first byte) are scanned in order, and every suffix found puts its predecessor, if that is
the larger one, at the next free place of the predecessor's bucket.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def smaller_than_next(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; equal bytes are decided by the next
    change, and the last suffix is larger than nothing."""
    n = len(text)
    change = np.zeros(n, np.int16)
    change[:-1] = np.diff(text.astype(np.int16))
    at = np.where(change != 0, np.arange(n), n - 1)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return change[at] > 0


def words_of(text: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes from every place on as one number, zeros past the end."""
    padded = np.zeros(len(text) + depth + 2 * WORD, np.uint64)
    padded[: len(text)] = text
    reach = 1
    while reach < WORD:
        padded[:-reach] = (padded[:-reach] << np.uint64(8 * reach)) | padded[reach:]
        reach *= 2
    return padded


def direct_sort(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places in order of their first `depth` bytes: by eight bytes, then ties by the next eight."""
    order = places[np.argsort(words[places], kind="stable")]
    key = words[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = key[1:] != key[:-1]
    for offset in range(WORD, depth, WORD):
        tied = ~fresh
        tied[:-1] |= ~fresh[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(fresh)[at]
        key = words[order[at] + offset]
        by = np.lexsort((key, group))
        order[at], key = order[at][by], key[by]
        fresh[at[1:]] |= key[1:] != key[:-1]
    return order


def suffix_order(text: np.ndarray, needed: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """The places marked in `needed`, ordered by at least their first `depth` bytes.

    Suffixes between a needed one and the next directly sorted one are carried along."""
    text = np.concatenate([text, np.array([0, 1], np.uint8)])  # a sorted suffix behind every place
    smaller = smaller_than_next(text)
    n = len(text)
    # A larger suffix hangs on those after it, up to the next smaller one.
    wanted = np.zeros(n, bool)
    wanted[: len(needed)] = needed
    anchor = np.minimum.accumulate(np.where(smaller, np.arange(n), n - 1)[::-1])[::-1]
    steps = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(wanted)
    np.add.at(steps, at, 1)
    np.add.at(steps, anchor[at] + 1, -1)
    used = np.cumsum(steps[:-1]) > 0
    words = words_of(text, depth) if words is None else words
    direct = direct_sort(np.flatnonzero(used & smaller), words, depth)
    bounds = np.searchsorted(text[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        wave = np.concatenate(waiting[c]) if waiting[c] else direct[:0]
        bucket = []
        while len(wave):  # equal bytes: predecessors in the same bucket
            bucket.append(wave)
            before = wave[wave > 0] - 1
            wave = before[used[before] & (text[before] == c)]
        bucket.append(direct[bounds[c] : bounds[c + 1]])
        found = np.concatenate(bucket)
        out.append(found)
        before = found[found > 0] - 1
        before = before[used[before] & (text[before] > c)]
        if len(before):
            first = text[before]
            by = np.argsort(first, kind="stable")
            before, first = before[by], first[by]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for part, value in zip(np.split(before, cuts), first[np.concatenate([[0], cuts])]):
                waiting[value].append(part)
    order = np.concatenate(out)
    return order[wanted[order]]


def common_prefixes(order: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each place in `order` with the one before, at most `depth`."""
    out = np.zeros(len(order), np.int64)
    open_ = np.arange(1, len(order))
    for offset in range(0, depth, WORD):
        differ = words[order[open_] + offset] ^ words[order[open_ - 1] + offset]
        ended = differ != 0
        # Whole bytes before the first that differs: its bit length from the top.
        top = np.frexp(differ[ended].astype(np.float64))[1]
        top = np.where((differ[ended] >> np.minimum(np.maximum(top - 1, 0), 63).astype(np.uint64)) == 0, top - 1, top)
        out[open_[ended]] = offset + (64 - top) // 8
        open_ = open_[~ended]
        if not len(open_):
            break
    out[open_] = depth
    return np.minimum(out, depth)
