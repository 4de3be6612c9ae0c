"""Vectorised splitting and hashing of many texts at once (numpy, inside Spark tasks)."""

from __future__ import annotations

import numpy as np


def _random_words(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64, n, dtype=np.uint64) | np.uint64(1)


_BYTE = _random_words(256, 11)
_PLACE = _random_words(1 << 16, 12)
_TURN = _random_words(64, 13)

#: True for bytes of words: all but blanks, tabs and line ends.
SPACED = np.ones(256, bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: True for bytes of lines: all but \n.
LINED = np.ones(256, bool)
LINED[0x0A] = False
#: True for ASCII digits, lower-case ASCII letters and all bytes of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64 bits (a finaliser of xor-shifts and odd products)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return data + (((data >= 65) & (data <= 90)).astype(np.uint8) << np.uint8(5))


def runs(data: np.ndarray, at: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and text numbers of the maximal runs of bytes of a kind; none crosses from a text to the next."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = kind[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = at[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    first[cut] |= inside[cut]
    last[cut - 1] |= inside[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(at, starts, "right") - 1


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, step: int = 4 << 20) -> np.ndarray:
    """A 64-bit hash of each run's bytes, ``step`` bytes of runs at once."""
    out = np.zeros(len(starts), np.uint64)
    total = np.concatenate([[0], np.cumsum(ends - starts)])
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(total, total[i] + step, "right")) - 1)
        size = ends[i:j] - starts[i:j]
        begin = total[i:j] - total[i]
        place = np.arange(total[j] - total[i]) - np.repeat(begin, size)
        value = _BYTE[data[place + np.repeat(starts[i:j], size)]]
        value *= _PLACE[place & 0xFFFF]
        out[i:j] = np.add.reduceat(value, begin) + size.astype(np.uint64) * _TURN[0]
        i = j
    return mix(out)


def windows(hashes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First places and hashes of all windows of n runs of one text."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    m = len(hashes) - n + 1
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h += mix(hashes[k : k + m] + _TURN[k]) * _TURN[k + 1]
    whole = np.flatnonzero(text[:m] == text[n - 1 :])
    return whole, mix(h[whole])


def per_text(text: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """How many runs (or the sum of their weights) each of n texts has."""
    return np.bincount(text, weights, n)
