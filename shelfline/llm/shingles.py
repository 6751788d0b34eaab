"""Word shingles of a text as sets of 64-bit hashes, in array code; memory follows the pieces read."""

from __future__ import annotations

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(32)
PIECE = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _M1
    x = (x ^ (x >> _SHIFT)) * _M2
    return x ^ (x >> _SHIFT)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_STEP, PIECE), _powers(_BACK, PIECE)


def word_hashes(text: str) -> np.ndarray:
    """Hash of every word, A-Z in lower case. Bytes weigh by their place, so the hash of a word is a
    difference of running sums brought back to its start."""
    data = np.frombuffer(text.encode("utf-8").lower(), np.uint8)
    out, start = [], 0
    while start < len(data):
        end = min(len(data), start + PIECE)
        if end < len(data):  # cut at white space; a word beyond a whole piece is hashed alone
            gaps = np.flatnonzero(_SPACE[data[start:end]])
            if len(gaps):
                end = start + int(gaps[-1]) + 1
            else:
                rest = np.flatnonzero(_SPACE[data[end:]])
                end = end + int(rest[0]) if len(rest) else len(data)
        out.append(_piece(data[start:end]))
        start = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _piece(data: np.ndarray) -> np.ndarray:
    up, down = (_UP, _DOWN) if len(data) <= PIECE else (_powers(_STEP, len(data)), _powers(_BACK, len(data)))
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    if not len(starts):
        return np.zeros(0, np.uint64)
    return mixed((sums[ends] - sums[starts]) * down[starts])


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of runs of `words` words; a shorter text is one run, an empty one none."""
    hashes = word_hashes(text or "")
    if not len(hashes):
        return hashes
    size = min(words, len(hashes))
    n = len(hashes) - size + 1
    out = np.full(n, np.uint64(size))
    for j in range(size):
        out = mixed(out * _STEP + hashes[j : j + n])
    return np.unique(out)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the sets' intersection is at least `percent` hundredths of their union."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    common = int(np.count_nonzero(large[np.minimum(at, len(large) - 1)] == small))
    return 100 * common >= percent * (len(a) + len(b) - common)
