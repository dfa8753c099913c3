"""Words and word shingles of many texts at once, as 64-bit hashes computed on the UTF-8 bytes with numpy.

A word is a maximal run of bytes other than space and 0x09-0x0D. Hashes depend on the bytes alone, so they agree
between executors and runs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

U64 = np.uint64
_RANDOM = np.random.RandomState(20240229)
_BYTE = _RANDOM.randint(0, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_STEP, _SHINGLE, _SHORT = U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93), U64(0xA0761D6478BD642F)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on uint64."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


@dataclass
class Words:
    """Words of a run of texts: start and end byte, text number; first[i]:first[i + 1] are the words of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def hashes(self, lower: bool = False) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, U64)
        length = self.end - self.start
        total = np.concatenate(([0], np.cumsum(length)))
        at = np.arange(total[-1]) - np.repeat(total[:-1], length)
        power = np.cumprod(np.full(int(length.max()), _STEP, U64))
        raw = self.data[np.repeat(self.start, length) + at]
        return mix(np.add.reduceat(_BYTE[_LOWER[raw] if lower else raw] * power[at], total[:-1]))


def words(data: np.ndarray, ends: np.ndarray) -> Words:
    """Words of the texts data[ends[i]:ends[i + 1]]."""
    n = len(ends) - 1
    edge = np.ones(len(data) + 1, bool)
    edge[1:] = False
    if len(data):
        space = _SPACE[data]
        edge[1:-1] = space[:-1]
        edge[ends] = True
        start = np.flatnonzero(~space & edge[:-1])
        edge[1:-1] = space[1:]
        edge[ends] = True
        end = np.flatnonzero(~space & edge[1:]) + 1
    else:
        start = end = np.zeros(0, np.int64)
    first = np.searchsorted(start, ends)
    return Words(data, start, end, np.repeat(np.arange(n), np.diff(first)), first)


def shingles(w: Words, size: int = 5, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text number, first word) of each size-word window; a text of fewer words, if any, is one window."""
    h, n = w.hashes(lower), len(w.start)
    count = np.diff(w.first)
    out, doc, at = [], [], []
    if n >= size:
        value = np.zeros(n - size + 1, U64)
        for k in range(size):
            value = value * _SHINGLE + h[k : n - size + 1 + k]
        whole = np.flatnonzero(w.doc[: n - size + 1] == w.doc[size - 1 :])
        out, doc, at = [mix(value[whole])], [w.doc[whole]], [whole]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        value = np.zeros(len(short), U64)
        for k in range(size - 1):
            has = count[short] > k
            value[has] = value[has] * _SHORT + h[w.first[short[has]] + k]
        out.append(mix(value * _SHORT + count[short].astype(U64)))
        doc.append(short)
        at.append(w.first[short])
    if not out:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, doc, at = np.concatenate(out), np.concatenate(doc), np.concatenate(at)
    if len(short):
        order = np.argsort(at, kind="stable")
        h, doc, at = h[order], doc[order], at[order]
    return h, doc, at


def sequences(w: Words, size: int) -> np.ndarray:
    """At each word, the hash that shingles() gives a whole text of the ``size`` words from there on."""
    h, n = w.hashes(True), len(w.start) - size + 1
    value = np.zeros(n, U64)
    for k in range(size):
        value = value * _SHORT + h[k : n + k]
    return mix(value * _SHORT + U64(size))


def shingle_sets(w: Words, size: int = 5, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, ascending within each text, and the n + 1 offsets of the texts."""
    h, doc, _ = shingles(w, size, lower)
    n = len(w.first) - 1
    bounds = np.searchsorted(doc, np.arange(n + 1))
    for i in np.flatnonzero(np.diff(bounds) > 1):
        h[bounds[i] : bounds[i + 1]].sort()
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[fresh], np.concatenate(([0], np.cumsum(fresh)))[bounds]
