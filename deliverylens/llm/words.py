"""Helpers on the words of one UTF-8 text: spans, hashes and window hashes.

A word is a maximal run of bytes outside ASCII white space (0x20, 0x09-0x0D).
Word hashes are 64-bit polynomials over bytes mapped to random odd numbers; a
window hash is a second polynomial over mixed word hashes. Equal words always
have equal hashes; different ones collide with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 0xD1342543DE82EF95
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def spans(buf: np.ndarray, between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the words in a byte array; ``between`` has
    True for the bytes that are no part of a word."""
    inside = np.zeros(len(buf) + 2, dtype=bool)
    np.logical_not(between[buf], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash for each word."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    up, down = _powers(len(buf))
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * up, out=total[1:])
    value = (total[ends] - total[starts]) * down[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(_STEP))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` consecutive words (none if there are fewer)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out *= np.uint64(_STEP)
        out += words[k : k + n]
    return mix(out)


def range_hashes(words: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A hash for each run words[start:stop], runs of any length."""
    up, down = _powers(max(1, len(words)))
    total = np.zeros(len(words) + 1, dtype=np.uint64)
    np.cumsum(words * up, out=total[1:])
    value = (total[stops] - total[starts]) * down[starts]
    return mix(value ^ mix((stops - starts).astype(np.uint64) * np.uint64(_STEP)))


def covered(n: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which of n positions lie in one of the runs [start, stop)."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, stops, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated(values: np.ndarray) -> np.ndarray:
    """Which values occur twice or more."""
    if len(values) < 2:
        return np.zeros(len(values), dtype=bool)
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    out = np.zeros(len(values), dtype=bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out
