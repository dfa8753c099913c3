"""Removal of long byte strings that occur more than once, by a partitioned enhanced suffix array.

Every string of LENGTH bytes has one anchor: its ANCHOR-byte substring of least hash, the first of equals. Equal strings
have equal anchors at equal places, so the strings of one anchor can be compared apart from all others. Consecutive
strings with the same anchor form a segment. Segments of equal bytes are counted first, however many there are; where
an anchor has different segments, a suffix array of them at the anchor, with its common-prefix intervals, finds which
of their strings they share, from the least interval up: members of an interval that also share enough to the left
form a maximal repeat, with all of its occurrences.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .bloom import Bloom
from .common import documents, record, scratch, slices, stored, table, text_buffer, trimmed
from .words import U64, mix

LENGTH, ANCHOR = 400, 64
#: Bytes that any passage of over 50 words has, spaces included, in languages written with letters: the pipeline's length.
PASSAGE = 256
#: Segments of one anchor that are compared in one task; those of a larger group go string by string.
MOST = 1 << 16
#: Starts that one numpy step works on.
STARTS = 1 << 19

_RANDOM = np.random.RandomState(977)
_BYTE = _RANDOM.randint(0, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15


class _Powers:
    """Powers of the hash base and of its inverse, as far as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up = np.cumprod(np.concatenate((np.ones(1, U64), np.full(size - 1, _BASE, U64))))
            self.down = np.cumprod(np.concatenate((np.ones(1, U64), np.full(size - 1, pow(_BASE, -1, 2**64), U64))))
        return self.up[:n], self.down[:n]


_powers = _Powers()


class Hashes:
    """Hashes of any substrings of data; equal bytes have equal hashes wherever they stand."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.concatenate((np.zeros(1, U64), np.cumsum(_BYTE[data] * up[:-1])))

    def __call__(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def all(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n])


def _least(keys: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` consecutive keys, from running minima of blocks in both directions."""
    n = len(keys)
    blocks = -(-n // size)
    padded = np.full(blocks * size, np.iinfo(np.uint64).max, U64)
    padded[:n] = keys
    grid = padded.reshape(blocks, size)
    left = np.minimum.accumulate(grid, axis=1).ravel()
    right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[: n - size + 1], left[size - 1 : n])


def segments(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """(text, start, end, anchor place, anchor hash, segment hash) of all segments, places within their texts."""
    outs = []
    for low in range(0, max(0, len(data) - length + 1), STARTS):
        part = data[low : low + STARTS + length - 1]
        h = Hashes(part)
        keys = h.all(anchor)
        place_bits = U64(STARTS * 2 - 1)
        keys = (keys & ~place_bits) | np.arange(len(keys), dtype=U64)
        at = (_least(keys, length - anchor + 1) & place_bits).astype(np.int64)
        start = np.arange(len(at))
        doc = np.searchsorted(ends, start + low, side="right") - 1
        inside = start + low + length <= ends[doc + 1]
        cut = np.flatnonzero(inside)
        if not len(cut):
            continue
        new = np.ones(len(cut), bool)
        new[1:] = (at[cut[1:]] != at[cut[:-1]]) | (doc[cut[1:]] != doc[cut[:-1]])
        first = cut[np.flatnonzero(new)]
        last = cut[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(cut) - 1]))]
        a, end = at[first], last + length
        fp = h(a, a + anchor)
        seg = mix(h(first, end) ^ mix((a - first).astype(U64) * U64(0xD6E8FEB86659FD93) + (end - first).astype(U64)))
        base = ends[doc[first]] - low
        outs.append((doc[first], first - base, end - base, a - base, fp.view(np.int64), seg.view(np.int64)))
    if not outs:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    return tuple(np.concatenate(x) for x in zip(*outs, strict=True))


def text_key(doc_id, text: bytes) -> int:
    """Names a row; rows of equal id and text share it, and so does all that is found in them."""
    return int.from_bytes(hashlib.blake2b(text, digest_size=8, key=str(doc_id).encode()).digest(), "little", signed=True)


def _keys(batch: pa.RecordBatch, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    raw = memoryview(data)
    return np.array([text_key(i, raw[a:b]) for i, a, b in zip(batch.column(0).to_pylist(), ends[:-1], ends[1:], strict=True)], np.int64)


def _common(rows: list[bytes]) -> np.ndarray:
    """Bytes that each of the sorted strings shares with the one before."""
    size = np.array([len(r) for r in rows])
    grid = np.zeros((len(rows), int(size.max()) + 1), np.uint8)
    flat = np.frombuffer(b"".join(rows), np.uint8)
    first = np.concatenate(([0], np.cumsum(size)))
    grid[np.repeat(np.arange(len(rows)), size), np.arange(len(flat)) - np.repeat(first[:-1], size)] = flat
    grid[:, -1] = np.arange(len(rows)) % 2  # neighbours differ at the end
    differ = (grid[1:] != grid[:-1]).argmax(axis=1)
    return np.minimum(differ, np.minimum(size[1:], size[:-1]))


def _intervals(shared):
    """(least, first, last) of every interval of neighbours that share more than those around it, inner ones first.

    shared[k] is what item k + 1 shares with item k; an interval of items first..last shares least > 0.
    """
    stack: list[tuple[int, int]] = []  # (shared, first item) of the intervals still open
    for i in range(len(shared) + 1):
        now = int(shared[i]) if i < len(shared) else 0
        low = i
        while stack and stack[-1][0] > now:
            least, low = stack.pop()
            yield least, low, i
        if now and (not stack or stack[-1][0] < now):
            stack.append((now, low))


class _Minima:
    """Minima of any values[a:b], from minima over powers of two."""

    def __init__(self, values: np.ndarray):
        self.table = [values]
        while len(self.table[-1]) > 1 << (len(self.table) - 1):
            half = 1 << (len(self.table) - 1)
            self.table.append(np.minimum(self.table[-1][:-half], self.table[-1][half:]))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        k = np.log2(b - a).astype(np.int64)
        out = np.empty(len(a), np.int64)
        for level in np.unique(k):
            at = k == level
            out[at] = np.minimum(self.table[level][a[at]], self.table[level][b[at] - (1 << level)])
        return out


class Suffixes:
    """Enhanced suffix array of the strings left[i] + right[i] at their anchors: sorted suffixes, common prefixes, ranks of what stands left."""

    def __init__(self, left: list[bytes], right: list[bytes]):
        m = len(right)
        self.order = sorted(range(m), key=right.__getitem__)
        self.lcp = _common([right[i] for i in self.order])
        flipped = [s[::-1] for s in left]
        self.by_left = sorted(range(m), key=flipped.__getitem__)
        self.lcs = _Minima(_common([flipped[i] for i in self.by_left]))
        rank = np.empty(m, np.int64)
        rank[self.by_left] = np.arange(m)
        self.place = rank[self.order]
        self.longest = max(map(len, left), default=0)

    def runs(self, length: int):
        """(depth, ranks, near) of members of a common-prefix interval that share enough to the left, too, to reach ``length``.

        ranks are places in by_left, ascending; near is what neighbours among them share left of the anchor.
        """
        for depth, low, high in _intervals(self.lcp):
            if length - depth > self.longest:
                continue
            ranks = np.sort(self.place[low : high + 1])
            near = self.lcs(ranks[:-1], ranks[1:])
            edges = np.flatnonzero(np.diff(np.concatenate(([0], (near >= length - depth).view(np.int8), [0]))))
            for a, b in edges.reshape(-1, 2):
                yield depth, ranks[a : b + 1], near[a:b]


def maximal_repeats(left: list[bytes], right: list[bytes], length: int):
    """Maximal repeats of at least ``length`` bytes across the anchors of strings left[i] + right[i].

    Yields (common bytes left of the anchor, common bytes right of it, members with all occurrences). A stack over the
    common prefixes of the sorted suffixes walks the interval tree bottom up; within an interval's members, in order of
    what stands left of them, another one walks theirs. A group is maximal if neither the byte before nor the byte after
    is the same for all of it: it is a whole interval to the left, and lies in no deeper one to the right.
    """
    found = Suffixes(left, right)
    lcp = _Minima(found.lcp)
    at = np.empty(len(left), np.int64)
    at[found.place] = np.arange(len(left))
    for depth, ranks, near in found.runs(length):
        near = near + 1  # so that groups with nothing to the left are intervals, too
        for shared, first, last in _intervals(near):
            places = at[ranks[first : last + 1]]
            if shared > length - depth and lcp(places.min(keepdims=True), places.max(keepdims=True))[0] == depth:
                yield shared - 1, depth, [found.by_left[r] for r in ranks[first : last + 1]]


def _covered(rows: list[tuple], length: int):
    """(key, start, end) of what is repeated of the segments (key, start, end, anchor, copies, bytes) of one anchor."""
    left = [r[5][: r[3] - r[1]] for r in rows]
    right = [r[5][r[3] - r[1] :] for r in rows]
    most, least = [-1] * len(rows), [length + 1] * len(rows)
    found = Suffixes(left, right)
    for depth, ranks, near in found.runs(length):
        for k, r in enumerate(ranks):
            i = found.by_left[r]
            reach = int(max(near[k - 1] if k else 0, near[k] if k < len(near) else 0))  # of the longest group that holds it
            most[i], least[i] = max(most[i], reach), min(least[i], length - depth)
    for i, (key, _, end, anchor, copies, _) in enumerate(rows):
        if copies == 1 and most[i] >= 0:
            yield key, anchor - most[i], anchor - max(least[i], anchor - end + length) + length


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, most: int = MOST) -> DataFrame:
    """(key, start, end): byte ranges that cover, with overlaps, all repeated strings of ``length`` bytes; key is text_key."""
    ddl = "key long,s int,e int,a int,fp long,seg long"

    def cut(batches):
        for part in slices(batches):
            data, ends = text_buffer(part.column(1))
            doc, s, e, a, fp, seg = segments(data, ends, length, anchor)
            if len(doc):
                yield record(ddl, _keys(part, data, ends)[doc], s.astype(np.int32), e.astype(np.int32), a.astype(np.int32), fp, seg)

    all_ = stored(docs.mapInArrow(trimmed(cut), ddl), "segments")
    equal = all_.groupBy("fp", "seg").agg(F.count(F.lit(1)).alias("c"))
    by_anchor = equal.groupBy("fp").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("fewest"))
    several = stored(equal.join(by_anchor.where("k > 1 OR fewest > 1"), "fp"), "several")
    whole = all_.join(several.where("c > 1").select("fp", "seg"), ["fp", "seg"]).select("key", F.col("s").alias("start"), F.col("e").alias("end"))
    mixed = several.where("k > 1 AND fewest = 1")
    anchors = Bloom(mixed.select("fp").distinct())

    def fetch(batches):
        seen: set[tuple] = set()
        for part in slices(batches):
            data, ends = text_buffer(part.column(1))
            doc, s, e, a, fp, seg = segments(data, ends, length, anchor)
            if not len(doc):
                continue
            hit = []
            for i in np.flatnonzero(anchors.has(fp)):
                name = (int(fp[i]), int(seg[i]))
                if name not in seen:  # one of equal segments is enough
                    hit.append(i)
                    if len(seen) >= most * 4:
                        seen.clear()
                    seen.add(name)
            if hit:
                raw = data.tobytes()
                own = [raw[ends[doc[i]] + s[i] : ends[doc[i]] + e[i]] for i in hit]
                yield record(ddl + ",bytes binary", _keys(part, data, ends)[doc[hit]], s[hit].astype(np.int32), e[hit].astype(np.int32), a[hit].astype(np.int32), fp[hit], seg[hit], pa.array(own, pa.binary()))

    texts = docs.mapInArrow(trimmed(fetch), ddl + ",bytes binary").dropDuplicates(["fp", "seg"]).join(mixed, ["fp", "seg"])
    fields = "fp", "key", "s", "e", "a", "c", "bytes"
    texts = stored(texts.select(*fields, "k"), "mixed")
    spans = "key long,start int,end int"

    def compare(batches):
        rows: list[tuple] = []
        last = None

        def flush():
            found = list(_covered(rows, length))
            rows.clear()
            return record(spans, *([list(x) for x in zip(*found, strict=True)] or [[], [], []]))

        for batch in batches:
            for fp, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if fp != last and rows:
                    yield flush()
                last = fp
                rows.append(tuple(row))
        if rows:
            yield flush()

    small = texts.where(F.col("k") <= most).select(*fields).repartition("fp").sortWithinPartitions("fp").mapInArrow(trimmed(compare), spans)
    large = texts.where(F.col("k") > most)

    def strings(batches):
        for batch in batches:
            for fp, key, s, e, a, _, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                starts = np.arange(e - s - length + 1)
                n = len(starts)
                yield record("fp long,off int,h long,key long,start int", np.full(n, fp), (starts + s - a).astype(np.int32), Hashes(np.frombuffer(raw, np.uint8))(starts, starts + length).view(np.int64), np.full(n, key), (starts + s).astype(np.int32))

    each = large.select(*fields).mapInArrow(trimmed(strings), "fp long,off int,h long,key long,start int")
    twice = each.groupBy("fp", "off", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rest = each.join(twice, ["fp", "off", "h"]).select("key", "start", (F.col("start") + length).cast("int").alias("end"))
    return whole.unionAll(small).unionAll(rest)


def merged(spans: DataFrame) -> DataFrame:
    """(key, spans): the maximal ranges of each key, as an array of (s, e) in order; touching ranges are one."""
    each = spans.groupBy("key", F.col("start").cast("int").alias("s")).agg(F.max(F.col("end").cast("int")).alias("e"))
    before = Window.partitionBy("key").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.when(F.max("e").over(before) >= F.col("s"), 0).otherwise(1)
    run = F.sum("fresh").over(Window.partitionBy("key").orderBy("s").rowsBetween(Window.unboundedPreceding, 0))
    runs = each.withColumn("fresh", fresh).withColumn("run", run).groupBy("key", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    return runs.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("spans"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, anchor: int = ANCHOR, most: int = MOST) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the text's UTF-8 bytes, removed ranges, and what is left of them.

    A byte goes if a ``length``-byte string that covers it also starts anywhere else in any text; all occurrences go.
    Null counts as empty. Repeated rows are texts of their own, so long ones are removed whole. Other columns are
    ignored; an empty table gives an empty result.
    """
    docs = documents(df, id_col, text_col)
    with scratch(df.sparkSession):
        spans = stored(merged(repeated_spans(docs, length, anchor, most)), "spans", keep=True)
    hit = Bloom(spans.select("key"))
    ddl = "doc_id long,key long,text string,clean boolean"

    def part(batches):
        for piece in slices(batches):
            data, ends = text_buffer(piece.column(1))
            keys = _keys(piece, data, ends)
            yield record(ddl, piece.column(0), keys, piece.column(1), ~hit.has(keys))

    keyed = docs.mapInArrow(trimmed(part), ddl)
    out = "doc_id long,n_bytes long,starts array<int>,ends array<int>,kept binary"
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("kept", pa.binary())])

    def cut(batches):
        for piece in slices(batches):
            raw = [t.encode() for t in piece.column(1).to_pylist()]
            ranges = [list(zip(s or [], e or [], strict=True)) for s, e in zip(piece.column(2).to_pylist(), piece.column(3).to_pylist(), strict=True)]
            kept = [b"".join(t[a:b] for a, b in zip([0, *(e for _, e in r)], [*(s for s, _ in r), len(t)], strict=True)) for t, r in zip(raw, ranges, strict=True)]
            yield pa.RecordBatch.from_arrays([piece.column(0), *(pa.array(v, f.type) for v, f in zip(([len(t) for t in raw], [[s for s, _ in r] for r in ranges], [[e for _, e in r] for r in ranges], kept), list(schema)[1:], strict=True))], schema=schema)

    none = F.lit(None).cast("array<int>")
    some = keyed.where("NOT clean").join(spans, "key", "left").select("doc_id", "text", F.col("spans.s").alias("s"), F.col("spans.e").alias("e"))
    return keyed.where("clean").select("doc_id", "text", none.alias("s"), none.alias("e")).unionAll(some).mapInArrow(trimmed(cut), out)


def with_text_kept(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = PASSAGE, anchor: int = ANCHOR, most: int = MOST) -> DataFrame:
    """df with the repeated passages cut from its texts, and n_chars, if there is one, counted anew; all rows stay.

    Where a cut leaves some bytes of a character only, they go too. A null text stays null.
    """
    with scratch(df.sparkSession):
        spans = stored(merged(repeated_spans(documents(df, id_col, text_col), length, anchor, most)), "spans", keep=True)
    hit = Bloom(spans.select("key"))

    names = df.columns

    def key(batches):
        for part in slices(batches, text_col):
            data, ends = text_buffer(part.column(text_col))
            keys = _keys(pa.RecordBatch.from_arrays([part.column(id_col).cast(pa.int64())], names=["id"]), data, ends)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(keys, mask=~hit.has(keys))], names=[*names, "__key"])

    def cut(batches):
        for part in slices(batches, text_col):
            texts = []
            for t, ranges in zip(part.column(text_col).to_pylist(), part.column(len(names)).to_pylist(), strict=True):
                raw = t.encode()
                texts.append("".join(raw[a:b].decode(errors="ignore") for a, b in zip([0, *(r["e"] for r in ranges)], [*(r["s"] for r in ranges), len(raw)], strict=True)))
            new = {text_col: texts} | ({"n_chars": [len(t) for t in texts]} if "n_chars" in names else {})
            yield pa.RecordBatch.from_arrays([pa.array(new[n], part.column(n).type) if n in new else part.column(n) for n in names], names=names)

    keyed = df.mapInArrow(trimmed(key), StructType([*df.schema.fields, StructField("__key", LongType())]))
    some = keyed.where("__key IS NOT NULL").join(spans.withColumnRenamed("key", "__key").withColumnRenamed("spans", "__spans"), "__key", "left")
    new = some.where("__spans IS NOT NULL").select(*names, "__spans").mapInArrow(trimmed(cut), df.schema)
    return keyed.where("__key IS NULL").select(*names).unionAll(some.where("__spans IS NULL").select(*names)).unionAll(new)


def op8_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents"))
    removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long")
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), (removed > 0).alias("repeated"))
