"""Directly addressable codes of unsigned integers.

A value is cut into chunks, lowest bits first. Level k holds the k-th chunk of every value that has one, and a bitmap
that says whether the value goes on to level k + 1. A rank directory (set bits before every 512th bit) turns a place in
one level into its place in the next, so any value is read without decoding others. Chunk widths are the ones of
4, 8 and 16 bits in sequence that need the least space for the values at hand.

Layout, little-endian: "DAC1", values (u64), levels (u8), widths (u8 each); then for each level its chunks, padded to
a byte, and, but for the last level, its bitmap and its directory (u32 each).
"""

from __future__ import annotations

import struct

import numpy as np

_MAGIC = b"DAC1"
_WIDTHS = (4, 8, 16)
_RANK_BITS = 512
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    """How many of the values need 0, 1, ... 32 bits."""
    edges = np.concatenate(([0], 2 ** np.arange(33, dtype=np.uint64)))
    below = np.searchsorted(np.sort(values), edges, side="left") if len(values) < 1000 else np.concatenate(([0], np.cumsum(np.histogram(values, edges)[0])))
    return np.diff(below)[: 33]


def widths(values: np.ndarray) -> list[int]:
    """The cheapest sequence of chunk widths for these values."""
    if not len(values):
        return [_WIDTHS[0]]
    longest = max(1, int(values.max()).bit_length())
    counts = np.zeros(34, np.int64)
    bits = _bit_lengths(values)
    counts[: len(bits)] = bits
    longer = counts[::-1].cumsum()[::-1]  # longer[b]: values of b bits or more
    best: dict[int, tuple[int, list[int]]] = {}
    for at in range(longest - 1, -1, -1):
        have = len(values) if at == 0 else int(longer[at + 1])
        best[at] = min((have * w, [w]) if at + w >= longest else (have * (w + 1) + best[at + w][0], [w, *best[at + w][1]]) for w in _WIDTHS)
    return best[0][1]


def _pack(chunks: np.ndarray, width: int) -> bytes:
    if width == 16:
        return chunks.astype("<u2").tobytes()
    chunks = chunks.astype(np.uint8)
    if width == 8:
        return chunks.tobytes()
    pairs = np.zeros(len(chunks) + len(chunks) % 2, np.uint8)
    pairs[: len(chunks)] = chunks
    return (pairs[::2] | pairs[1::2] << 4).tobytes()


def encode(values: np.ndarray) -> bytes:
    values = np.asarray(values, np.uint32)
    cut = widths(values)
    out = [_MAGIC, struct.pack("<QB", len(values), len(cut)), bytes(cut)]
    for k, w in enumerate(cut):
        out.append(_pack(values & np.uint32((1 << w) - 1), w))
        if k < len(cut) - 1:
            values = values >> np.uint32(w)
            more = values > 0
            bitmap = np.packbits(more, bitorder="little")
            ones = np.concatenate(([0], np.cumsum(_ONES[bitmap], dtype=np.int64)))
            out += [bitmap.tobytes(), ones[: -1 or None][:: _RANK_BITS // 8].astype("<u4").tobytes() if len(bitmap) else b""]
            values = values[more]
    return b"".join(out)


class Reader:
    """Random and whole access to one code, over its bytes as they are."""

    def __init__(self, raw):
        raw = memoryview(raw)
        if bytes(raw[:4]) != _MAGIC:
            raise ValueError("not a DAC1 code")
        n, levels = struct.unpack("<QB", raw[4:13])
        self.n, self.widths, at = n, list(raw[13 : 13 + levels]), 13 + levels
        self.levels = []
        for k, w in enumerate(self.widths):
            size = (n * w + 7) // 8
            chunks = np.frombuffer(raw[at : at + size], "<u2" if w == 16 else np.uint8)
            at += size
            bitmap = directory = None
            if k < levels - 1:
                size = (n + 7) // 8
                bitmap = np.frombuffer(raw[at : at + size], np.uint8)
                at += size
                size = -(-size // (_RANK_BITS // 8)) * 4
                directory = np.frombuffer(raw[at : at + size], "<u4")
                at += size
                following = int(_ONES[bitmap].sum(dtype=np.int64))
            self.levels.append((w, n, chunks, bitmap, directory))
            n = following if k < levels - 1 else 0

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = shift = 0
        for w, _, chunks, bitmap, directory in self.levels:
            chunk = int(chunks[i // 2]) >> 4 * (i % 2) & 15 if w == 4 else int(chunks[i])
            value |= chunk << shift
            shift += w
            if bitmap is None or not bitmap[i // 8] >> i % 8 & 1:
                break
            block = i // _RANK_BITS
            start = block * _RANK_BITS // 8
            i = int(directory[block]) + int(_ONES[bitmap[start : i // 8]].sum()) + int(_ONES[bitmap[i // 8] & ((1 << i % 8) - 1)])
        return value

    def all(self) -> np.ndarray:
        out, place, shift = np.zeros(self.n, np.uint32), None, 0
        for w, n, chunks, bitmap, _ in self.levels:
            if w == 4:
                both = np.empty(len(chunks) * 2, np.uint8)
                both[::2], both[1::2] = chunks & 15, chunks >> 4
                chunks = both[:n]
            part = chunks.astype(np.uint32) << np.uint32(shift)
            if place is None:
                out = part
            else:
                out[place] |= part
            shift += w
            if bitmap is not None:
                more = np.flatnonzero(np.unpackbits(bitmap, count=n, bitorder="little"))
                place = more if place is None else place[more]
        return out
