"""Singular values and right singular vectors of a triangular factor by way of a bidiagonal matrix.

Householder reflectors from both sides leave an upper bidiagonal B; the differential quotient-difference
algorithm with shifts finds the squares of its singular values to high relative accuracy; a twisted
factorisation of B'B minus such a square gives its vector, which the right reflectors carry back.
All matrices are width x width: this is the small part that is left after the rows have been reduced.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
TINY = np.finfo(float).tiny
# Squares nearer to each other than this share are treated as one group, whose vectors are made orthogonal.
NEAR = 1e-3


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B = U'RV, and V."""
    a, n = np.array(r, dtype=float), r.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.abs(x).max(initial=0.0)
        if not size or not np.any(x[1:]):
            return None
        h = x / size
        h[0] += np.copysign(np.linalg.norm(h), h[0])
        return h / np.linalg.norm(h)

    for k in range(n):
        if (h := reflector(a[k:, k].copy())) is not None:
            a[k:, k:] -= 2 * np.outer(h, h @ a[k:, k:])
        if k + 2 < n and (h := reflector(a[k, k + 1 :].copy())) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ h, h)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ h, h)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling.

    The sum of shifts is carried on; a shift that would make a quotient negative is taken back and a
    smaller one tried. A block splits where a superdiagonal entry no longer matters."""
    found: list[float] = []
    blocks = [(np.asarray(diagonal, float) ** 2, np.asarray(above, float) ** 2, 0.0)]
    while blocks:
        q, e, shift = blocks.pop()
        guess = None
        while len(q):
            if len(q) == 1:
                found.append(q[0] + shift)
                break
            cut = np.flatnonzero(e <= EPS * EPS * (shift + q[:-1]))
            if not len(cut):
                cut = np.flatnonzero(e <= EPS * EPS * (shift + q[1:]))
            if len(cut):
                k = int(cut[-1])
                blocks.append((q[: k + 1], e[:k], shift))
                q, e, guess = q[k + 1 :], e[k + 1 :], None
                continue
            tau = _smallest(q[-2], e[-1], q[-1]) if guess is None else guess
            for attempt in range(4):
                new_q, new_e, least, low = _transform(q, e, tau)
                if least >= 0:
                    break
                # A failure in the last place only gives a lower bound at once; else go down quickly.
                tau = tau + least if low == len(q) - 1 and tau + least > 0 and attempt == 0 else tau / 4 if attempt < 2 else 0.0
            q, e, shift = new_q, new_e, shift + tau
            guess = None
    return np.array(sorted(found, reverse=True))


def _smallest(a: float, b: float, c: float) -> float:
    """A little less than the smaller eigenvalue of the last two rows: [[a + b, sqrt(b c)], [., c]]."""
    half = (a + b + c) / 2
    root = np.sqrt(max(half * half - a * c, 0.0))
    return 0.0 if half + root == 0 else max(0.0, a * c / (half + root)) * (1 - 4 * EPS)


def _transform(q: np.ndarray, e: np.ndarray, tau: float) -> tuple[np.ndarray, np.ndarray, float, int]:
    """One dqds step; also the least quotient difference and where it is."""
    new_q, new_e = np.empty_like(q), np.empty_like(e)
    d = q[0] - tau
    least, low = d, 0
    for i in range(len(e)):
        whole = d + e[i]
        if whole == 0:
            new_e[i], d = 0.0, q[i + 1] - tau
        else:
            ratio = q[i + 1] / whole
            new_e[i], d = e[i] * ratio, d * ratio - tau
        new_q[i] = whole
        if d < least:
            least, low = d, i + 1
        if least < 0 and tau:
            return q, e, least, low if i + 1 == len(e) else -1
    new_q[-1] = d
    return new_q, new_e, max(least, 0.0) if not tau else least, low


def _twisted(top: np.ndarray, links: np.ndarray, square: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """L D L' - square, factored from above and from below: both multipliers and the twist elements."""
    n = len(top)
    down, up, s, p = np.empty(max(n - 1, 0)), np.empty(max(n - 1, 0)), np.empty(n), np.empty(n)
    s[0] = -square
    for i in range(n - 1):
        pivot = s[i] + top[i] or -EPS * square or -TINY
        down[i] = top[i] * links[i] / pivot
        s[i + 1] = down[i] * links[i] * s[i] - square
    p[-1] = top[-1] - square
    for i in range(n - 2, -1, -1):
        pivot = top[i] * links[i] ** 2 + p[i + 1] or -EPS * square or -TINY
        ratio = top[i] / pivot
        up[i] = links[i] * ratio
        p[i] = p[i + 1] * ratio - square
    return down, up, s + p + square


def _vector(down: np.ndarray, up: np.ndarray, at: int) -> np.ndarray:
    z = np.zeros(len(down) + 1)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -down[i] * z[i + 1]
    for i in range(at, len(up)):
        z[i + 1] = -up[i] * z[i]
    return z


def right_vectors(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest squares of singular values of r that are not zero to its precision, and their
    unit right singular vectors as columns. Equal values get any orthogonal vectors of their space."""
    width = r.shape[1]
    if not width or not np.any(r):
        return np.zeros(0), np.zeros((width, 0))
    scale = np.abs(r).max()
    diagonal, above, v = bidiagonalise(r / scale)
    size = max(np.abs(diagonal).max(), np.abs(above).max(initial=0.0))
    diagonal = np.where(np.abs(diagonal) < EPS * EPS * size, EPS * EPS * size, diagonal)
    above = np.where(np.abs(above) < EPS * EPS * size, 0.0, above)
    squares = dqds(diagonal, above)
    squares = squares[squares > (EPS * width) ** 2 * squares[0]][:count]
    top, links = diagonal**2, above / diagonal[:-1]
    kept: list[np.ndarray] = []
    for k, square in enumerate(squares):
        group = [z for z, other in zip(kept, squares) if other - square <= NEAR * other]
        kept.append(_one(diagonal, above, top, links, square, group))
    z = np.array(kept).T
    return squares * scale**2, v @ z


def _one(diagonal, above, top, links, square, group) -> np.ndarray:
    """Vector of one square by the twist with the smallest element that is not already in the group's space."""
    down, up, twist = _twisted(top, links, square)
    best, rest = None, 0.0
    for at in np.argsort(np.abs(twist)):
        z = _vector(down, up, at)
        if not np.isfinite(z).all():
            continue
        z /= np.linalg.norm(z)
        for _ in range(2):
            for other in group:
                z -= (other @ z) * other
        left = np.linalg.norm(z)
        if left > 0.5 or left > 4 * rest:
            error = np.linalg.norm(_apply(diagonal, above, z / left) - square * z / left)
            if best is None or error < best[0]:
                best, rest = (error, z / left), left
            if error <= 64 * EPS * len(z) * (diagonal.max() ** 2 + square):
                break
    return best[1]


def _apply(diagonal: np.ndarray, above: np.ndarray, z: np.ndarray) -> np.ndarray:
    """B'B z."""
    y = diagonal * z
    y[:-1] += above * z[1:]
    out = diagonal * y
    out[1:] += above * y[:-1]
    return out
