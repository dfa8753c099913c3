"""Packing of token sequences into windows of a fixed size, online with bounded space.

Each partition keeps a fixed number of open windows. A piece goes into the open window it fits best. When none fits,
another window is opened while there are fewer than the fixed number; else the fullest is emitted, topped up with the
head of the piece if its gap is worth a cut. What is still open at the end of a partition is merged: first within
the partition, then the windows still not full across a fixed number of partitions at a time.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, record, slices, stored, table, trimmed
from .tokens import AT_ONCE, encoder

VOCAB, END_ID, WINDOW = "word_bpe_49k.json", 2, 4096
#: Windows open at a time in a partition, the smallest gap that a piece is cut for, and partitions merged at a time.
OPEN, WORTH, FAN_IN = 64, 16, 16

DDL = "doc_id long,start long,length long,ids binary,doc_tokens long,sequence_id long,offset long"


class Packer:
    """put(piece, length, cut) places pieces; emitted windows are lists of them. cut(piece, k) splits off k ids."""

    def __init__(self, size: int, space: int, worth: int, cut=None):
        self.size, self.space, self.worth, self.cut = size, space, worth, cut
        self.gaps: list[tuple[int, int]] = []  # (gap, window), ascending
        self.windows: dict[int, list] = {}
        self.next = 0
        self.done: list[list] = []

    def put(self, piece, length: int) -> None:
        while length:
            at = bisect_left(self.gaps, (length, -1))
            if at < len(self.gaps):
                gap, key = self.gaps.pop(at)
                self.windows[key].append(piece)
                self._keep(gap - length, key)
                return
            if len(self.gaps) < self.space and length < self.size:
                self.windows[self.next] = [piece]
                self._keep(self.size - length, self.next)
                self.next += 1
                return
            if length >= self.size and self.cut:
                head, piece = self.cut(piece, self.size)
                self.done.append([head])
                length -= self.size
                continue
            gap, key = self.gaps.pop(0)
            if gap >= self.worth and self.cut:
                head, piece = self.cut(piece, gap)
                self.windows[key].append(head)
                length -= gap
            self.done.append(self.windows.pop(key))

    def _keep(self, gap: int, key: int) -> None:
        if gap:
            insort(self.gaps, (gap, key))
        else:
            self.done.append(self.windows.pop(key))

    def taken(self) -> list[list]:
        out, self.done = self.done, []
        return out

    def leftovers(self) -> list[list]:
        """The open windows, joined where two or more fit one window; emptied here."""
        fullest = sorted(((self.size - gap, self.windows[key]) for gap, key in self.gaps), key=lambda x: -x[0])
        merged = Packer(self.size, len(fullest) + 1, self.size)
        for used, pieces in fullest:
            merged.put(pieces, used)
        self.gaps, self.windows = [], {}
        return [[p for pieces in w for p in pieces] for w in (*merged.taken(), *merged.windows.values())]


def _rows(windows: list[list], first: int) -> pa.RecordBatch:
    """Rows of pieces (doc, start, ids, doc_tokens), the windows numbered from ``first``."""
    cols: list[list] = [[] for _ in range(7)]
    for k, pieces in enumerate(windows):
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            for col, v in zip(cols, (doc, start, n, bytes(ids), total, first + k, offset), strict=True):  # Arrow never frees a memoryview
                col.append(v)
            offset += n
    return record(DDL, *cols)


def _cut(piece, k: int):
    doc, start, ids, total = piece
    return (doc, start, ids[: 4 * k], total), (doc, start + k, ids[4 * k :], total)


def pack(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW, space: int = OPEN, worth: int = WORTH, vocab: str = VOCAB, end_id: int = END_ID) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset) of all documents, each id in one piece.

    ids holds little-endian unsigned 32-bit integers; start counts the document's ids before the piece, offset the
    sequence's. Null and empty texts have end_id alone. Repeated rows and null ids are packed like any other row;
    other columns are ignored; an empty table gives no pieces.
    """
    docs = documents(df, id_col, text_col)

    def run(batches):
        coder, packer, part, made = encoder(vocab, end_id), Packer(size, space, worth, _cut), TaskContext.get().partitionId(), 0
        for batch in slices(batches, size=AT_ONCE):
            flat, counts = coder.encode(batch.column(1).to_pylist())
            raw, at = memoryview(flat.astype("<u4").tobytes()), 0
            for doc, n in zip(batch.column(0).to_pylist(), counts.tolist(), strict=True):
                packer.put((doc, 0, raw[4 * at : 4 * (at + n)], n), n)
                at += n
            for windows in packer.windows.values():  # the slice's memory goes, that of open windows stays
                windows[:] = [(doc, start, bytes(ids), n) for doc, start, ids, n in windows]
            full = packer.taken()
            if full:
                yield _rows(full, part << 32 | made)
                made += len(full)
        last = packer.leftovers()
        if last:  # negative until they are merged
            yield _rows(last, -((part + 1) << 32))

    packed = stored(docs.mapInArrow(trimmed(run), DDL), "pieces")
    open_ = packed.where("sequence_id < 0")

    def merge(batches):
        def flush(group, windows):
            packer = Packer(size, len(windows) + 1, size)
            for pieces in sorted(windows, key=lambda w: -sum(len(p[2]) for p in w)):
                packer.put(pieces, sum(len(p[2]) for p in pieces) // 4)
            whole = [[p for pieces in w for p in pieces] for w in (*packer.taken(), *packer.windows.values())]
            return _rows(whole, 1 << 62 | group << 32)

        group, key, windows = None, None, []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if row[7] != group and windows:
                    yield flush(group, windows)
                    windows, key = [], None
                group = row[7]
                if row[5] != key:
                    windows.append([])
                    key = row[5]
                windows[-1].append((row[0], row[1], row[3], row[4]))
        if windows:
            yield flush(group, windows)

    group = F.floor((-F.shiftright("sequence_id", 32) - 1) / FAN_IN)
    last = open_.withColumn("group", group).repartition("group").sortWithinPartitions("group", "sequence_id", "offset").mapInArrow(trimmed(merge), DDL)
    return packed.where("sequence_id >= 0").unionAll(last)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
