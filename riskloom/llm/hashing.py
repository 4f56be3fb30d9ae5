"""Vectorised 64-bit hashes of the words and word shingles in a run of texts."""

from __future__ import annotations

import numpy as np

U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_STEP = 1 << 19
_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser that spreads every input bit."""
    x = np.asarray(x, U).copy()
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    if len(_powers["up"]) < n:
        for key, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
            step = np.full(max(n, _STEP + 64), base, U)
            step[0] = 1
            _powers[key] = np.multiply.accumulate(step)
    return _powers["up"], _powers["down"]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and where each text's words begin in that list."""
    full = ~_SPACE[data]
    n, first, last = len(data), offsets[:-1], offsets[1:] - 1
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = full[:-1], full[1:]
    some = last >= first
    before[first[some]] = False
    after[last[some]] = False
    start = np.flatnonzero(full & ~before)
    end = np.flatnonzero(full & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes."""
    out, i = np.empty(len(start), U), 0
    while i < len(start):
        base = int(start[i])
        j = max(i + 1, int(np.searchsorted(start, base + _STEP)))
        width = int(end[j - 1]) - base
        up, down = powers(width + 1)
        total = np.zeros(width + 1, U)
        np.cumsum((data[base : base + width].astype(U) + U(1)) * up[:width], out=total[1:])
        s, e = start[i:j] - base, end[i:j] - base
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))
        i = j
    return out


def text_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes in order and each text's first place among them."""
    start, end, at = word_bounds(data, offsets)
    return word_hashes(data, start, end), at


def shingles(words: np.ndarray, at: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words; a text of fewer words has one shingle of all its words."""
    n = np.diff(at)
    count = np.where(n >= width, n - width + 1, (n > 0).astype(np.int64))
    to = np.zeros(len(at), np.int64)
    np.cumsum(count, out=to[1:])
    place = np.arange(to[-1]) - np.repeat(to[:-1] - at[:-1], count)
    stop = np.repeat(at[1:], count)
    total = np.zeros(to[-1], U)
    for k in range(width):
        here = place + k
        inside = here < stop
        value = words[np.where(inside, here, 0)] if len(words) else np.zeros(0, U)
        total = total * U(0xC2B2AE3D27D4EB4F) + np.where(inside, value, U(k + 1))
    return mix(total), to


def distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of every row."""
    rows = [np.unique(values[at[i] : at[i + 1]]) for i in range(len(at) - 1)]
    to = np.zeros(len(at), np.int64)
    np.cumsum([len(x) for x in rows], out=to[1:])
    return (np.concatenate(rows) if rows else values[:0]), to
