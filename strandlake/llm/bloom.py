"""A filter of fixed size over 64-bit keys, to leave rows where they are read. It may let other keys through, never loses one."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import trimmed
from .words import U64, mix

#: Bits of a filter; 8 MB whatever it holds.
BITS = 1 << 26


def _places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.view(U64)) & U64(BITS - 1)
    return (h >> U64(3)).astype(np.int64), np.uint8(1) << (h & U64(7)).astype(np.uint8)


class Bloom:
    """Filter over the long column of a one-column table; has(keys) marks those that may be in it."""

    def __init__(self, keys: DataFrame, tasks: int = 16):
        def mark(batches):
            bits, some = np.zeros(BITS // 8, np.uint8), False
            for batch in batches:
                place, bit = _places(batch.column(0).to_numpy(zero_copy_only=False))
                np.bitwise_or.at(bits, place, bit)
                some |= batch.num_rows > 0
            if some:
                yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(bits.tobytes(), 1)], pa.binary())], names=["bits"])

        bits = np.zeros(BITS // 8, np.uint8)
        for row in keys.coalesce(tasks).mapInArrow(trimmed(mark), "bits binary").collect():  # ``tasks`` rows of at most 8 MB
            bits |= np.frombuffer(zlib.decompress(row.bits), np.uint8)
        self._sent = keys.sparkSession.sparkContext.broadcast(bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        place, bit = _places(keys)
        return (self._sent.value[place] & bit) > 0

    def __getstate__(self):
        return {"_sent": self._sent}
