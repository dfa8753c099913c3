"""Benchmark decontamination by SimHash over item-sized windows.

Items and windows are bags of weighted word shingles; a shingle weighs less the more items have it. A document's windows
of an item's size are considered wherever they hold a shingle of that item, without which the similarity is zero. Their
64-bit SimHashes are looked up in an index of the items' by blocks of bits: fingerprints within RADIUS differ by no more
than RADIUS / len(BLOCKS) in some block, so trying all such values of every block finds each of them. Weighted Jaccard
similarity of the shingles then decides exactly. Windows at the threshold differ from their item by some 10 of 64 bits.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, record, slices, table, text_buffer, trimmed
from .words import U64, mix, sequences, shingles, words

SIZE, PERCENT = 5, 80
#: Hamming distance within which all items are found, and the bits of the blocks that 64 bits are cut into.
RADIUS, BLOCKS = 17, (11, 11, 11, 11, 10, 10)
#: Words of benchmark items that are held at a time; a larger benchmark goes against the documents block by block.
HELD = 2_000_000
_FILTER = 1 << 22
_BITS = np.arange(64, dtype=U64)
_ONES = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def _signs(tokens: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits of each token."""
    return ((mix(tokens)[:, None] >> _BITS) & U64(1)).astype(np.float64) * 2 - 1


def _fingerprint(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(U64).ravel()


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _ONES[(np.ascontiguousarray(a ^ b)).view(np.uint8).reshape(-1, 8)].sum(axis=1)


class HammingIndex:
    """near(fingerprints): all (query, entry) pairs within ``radius``; tried counts the pairs that the blocks let through."""

    def __init__(self, entries: np.ndarray, radius: int = RADIUS, blocks: tuple[int, ...] = BLOCKS):
        self.entries, self.radius, self.tried = entries, radius, 0
        self.tables = []
        low = 0
        for bits in blocks:
            flips = [0] + [sum(1 << b for b in c) for k in range(1, min(bits, radius // len(blocks)) + 1) for c in combinations(range(bits), k)]
            mask = U64((1 << bits) - 1)
            value = ((entries >> U64(low)) & mask).astype(np.int64)
            order = np.argsort(value, kind="stable")
            self.tables.append((U64(low), mask, np.array(flips, np.int64), order, np.searchsorted(value[order], np.arange((1 << bits) + 1))))
            low += bits

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pairs = []
        for low, mask, flips, order, first in self.tables:
            value = ((queries >> low) & mask).astype(np.int64)
            tried = value[:, None] ^ flips[None, :]
            count = first[tried + 1] - first[tried]
            q = np.repeat(np.arange(len(queries)), count.sum(axis=1))
            start, n = first[tried].ravel(), count.ravel()
            at = np.repeat(start - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            pairs.append(q * len(self.entries) + order[at])
            self.tried += len(at)
        pairs = np.unique(np.concatenate(pairs))
        q, e = pairs // len(self.entries), pairs % len(self.entries)
        ok = distance(queries[q], self.entries[e]) <= self.radius
        return q[ok], e[ok]


class Items:
    """Benchmark items (id, text): their shingle bags, weights, fingerprints and index. Wordless items match nothing.

    Where these are a block of a larger benchmark, whole tells about all of it: the number of its items with words, its
    shingles of more than one item in order, and of how many.
    """

    def __init__(self, items: list[tuple[int, str]], size: int = SIZE, radius: int = RADIUS, whole: tuple[int, np.ndarray, np.ndarray] | None = None):
        raw = [t.encode() for _, t in items]
        ends = np.concatenate(([0], np.cumsum([len(r) for r in raw], dtype=np.int64)))
        w = words(np.frombuffer(b"".join(raw), np.uint8), ends)
        h, doc, _ = shingles(w, size)
        count = np.diff(w.first)
        used = [i for i in range(len(items)) if count[i]]
        self.ids = [items[i][0] for i in used]
        self.words = np.array([int(count[i]) for i in used], np.int64)
        self.bags = [set(h[doc == i].tolist()) for i in used] if len(used) < 64 else self._bags(h, doc, used)
        shared = Counter(t for b in self.bags for t in b)
        self.whole = whole or (len(self.bags), np.zeros(0, U64), np.zeros(0, np.int64))
        n = self.whole[0]
        self.other = math.log1p(n)
        self.weight = {t: self._whole_weight(t) for t in shared} if whole else {t: math.log1p(n / k) for t, k in shared.items()}
        self.totals = [sum(self.weight[t] for t in b) for b in self.bags]
        self.of: dict[int, list[int]] = defaultdict(list)
        for i, b in enumerate(self.bags):
            for t in b:
                self.of[t].append(i)
        self.filter = np.zeros(_FILTER, bool)
        known = np.fromiter(self.of, U64, len(self.of))
        self.filter[(known & U64(_FILTER - 1)).astype(np.int64)] = True
        prints = [_fingerprint((np.array([[self.weight[t]] for t in b]) * _signs(np.fromiter(b, U64, len(b)))).sum(axis=0, keepdims=True))[0] for b in self.bags]
        self.index = HammingIndex(np.array(prints, U64), radius)
        self.short = sorted({int(k) for k in self.words if k < size})

    @staticmethod
    def _bags(h: np.ndarray, doc: np.ndarray, used: list[int]) -> list[set]:
        cuts = np.searchsorted(doc, np.arange((used[-1] if used else 0) + 2))
        return [set(h[cuts[i] : cuts[i + 1]].tolist()) for i in used]

    def _whole_weight(self, t: int) -> float:
        n, known, count = self.whole
        at = int(np.searchsorted(known, U64(t)))
        return math.log1p(n / int(count[at])) if at < len(known) and int(known[at]) == t else self.other

    def weigh(self, t: int) -> float:
        """The weight of any shingle; one that no item has weighs as one of a single item."""
        w = self.weight.get(t)
        return w if w is not None else self._whole_weight(t) if len(self.whole[1]) else self.other

    def hits(self, h: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.filter[(h & U64(_FILTER - 1)).astype(np.int64)])
        return np.array([i for i in maybe if int(h[i]) in self.of], np.int64)

    def similarity(self, item: int, window: set) -> float:
        """Weighted Jaccard similarity; 1 for equal bags."""
        bag = self.bags[item]
        both = sum(self.weight[t] for t in bag & window)
        return both / (self.totals[item] + sum(self.weigh(t) for t in window - bag))


def matches(items: Items, h: np.ndarray, size: int, percent: int) -> dict[int, tuple[float, int]]:
    """item number -> (best similarity, first word) in one document, given the shingles h of its windows of ``size``."""
    places: dict[int, set[int]] = defaultdict(set)  # window length in shingles -> starts to look at
    for p in items.hits(h).tolist():
        for i in items.of[int(h[p])]:
            k = min(max(1, int(items.words[i]) - size + 1), len(h))
            places[k].update(range(max(0, p - k + 1), min(p, len(h) - k) + 1))
    best: dict[int, tuple[float, int]] = {}
    for k, starts in places.items():
        at = np.array(sorted(starts), np.int64)
        low = int(at[0])
        part = h[low : int(at[-1]) + k]
        # A window is a set: what it holds twice counts once, so sums over runs of windows leave repeats to the exact bag.
        weights = np.array([items.weigh(t) for t in part.tolist()])
        sums = np.concatenate((np.zeros((1, 64)), np.cumsum(weights[:, None] * _signs(part), axis=0)))
        diff = sums[at - low + k] - sums[at - low]
        if len(set(part.tolist())) < len(part):
            for row, a in enumerate(at - low):
                inside = part[a : a + k]
                unique, first = np.unique(inside, return_index=True)
                if len(unique) < k:
                    diff[row] = (weights[a : a + k][first][:, None] * _signs(unique)).sum(axis=0)
        for q, i in zip(*(x.tolist() for x in items.index.near(_fingerprint(diff))), strict=True):
            if min(max(1, int(items.words[i]) - size + 1), len(h)) != k:
                continue
            start = int(at[q])
            sim = items.similarity(i, set(h[start : start + k].tolist()))
            if sim * 100 >= percent - 1e-9 and (i not in best or (-sim, start) < (-best[i][0], best[i][1])):
                best[i] = (sim, start)
    return best


def _whole(items: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """What Items asks about the whole benchmark. It takes 16 bytes for each shingle that several items have."""

    def count(batches):
        for part in slices(batches):
            w = words(*text_buffer(part.column(1)))
            h, doc, _ = shingles(w, SIZE)
            each = np.unique(np.stack([doc.astype(np.int64), h.view(np.int64)]), axis=1)
            found, k = np.unique(each[1], return_counts=True)
            used = int((np.diff(w.first) > 0).sum())
            yield pa.RecordBatch.from_arrays([pa.array([None, *found.tolist()], pa.int64()), pa.array([used, *k.tolist()], pa.int64())], names=["t", "k"])

    got = items.where("item_id IS NOT NULL").mapInArrow(trimmed(count), "t long, k long").groupBy("t").agg(F.sum("k").alias("k")).where("t IS NULL OR k > 1").toArrow()
    total = sum(k for t, k in zip(got["t"].to_pylist(), got["k"].to_pylist(), strict=True) if t is None) if got["t"].null_count else 0
    got = got.filter(got["t"].is_valid())
    known, k = got["t"].to_numpy().view(U64), got["k"].to_numpy()
    order = np.argsort(known)
    return total, known[order], k[order]


def contaminated(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, radius: int = RADIUS, held: int = HELD) -> DataFrame:
    """(doc_id, item_id, similarity, start_word): each document and benchmark item (item_id, text) that it holds.

    An item is held where a window of as many words (the whole text, if shorter) has a weighted Jaccard similarity of
    percent / 100 or more; the best window is told, the first of equals. Words are lower-cased (A-Z) runs of non-space
    bytes. Items of under five words are held where exactly their words follow one another. Null, empty and wordless
    texts and items match nothing. Repeated rows give a row each, repeated items one for each item_id; other columns
    are ignored; an empty table on either side gives an empty result. Items with a null item_id are left out. Blocks of a
    large benchmark weigh shingles by the whole of it, so the result doesn't depend on ``held``.
    """
    docs = documents(df, id_col, text_col)
    ddl = "doc_id long,item_id long,similarity double,start_word long"
    out = None
    for items in _blocks(benchmark, radius, held):

        def run(batches, items=items):
            index = items()
            if not index.ids:
                return
            for part in slices(batches):
                found = _found(index, part.column(1), percent)
                if found:
                    rows, *rest = map(list, zip(*found, strict=True))
                    yield record(ddl, part.column(0).take(pa.array(rows, pa.int64())), *rest)

        more = docs.mapInArrow(trimmed(run), ddl)
        out = more if out is None else out.unionAll(more)
    return out


def uncontaminated(df: DataFrame, benchmark: DataFrame, text_col: str = "text", percent: int = PERCENT, radius: int = RADIUS, held: int = HELD) -> DataFrame:
    """The rows of df that hold no benchmark item, with all columns; each row is judged by its own text, whatever its id."""
    for items in _blocks(benchmark, radius, held):

        def run(batches, items=items):
            index = items()
            for part in slices(batches, text_col):
                keep = np.ones(part.num_rows, bool)
                if index.ids:
                    keep[[f[0] for f in _found(index, part.column(text_col), percent)]] = False
                yield part.filter(pa.array(keep))

        df = df.mapInArrow(trimmed(run), df.schema)
    return df


def _blocks(benchmark: DataFrame, radius: int, held: int) -> list:
    """For each block of the benchmark a function that gives its Items on an executor."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    blocks = -(-total // (held * 6)) or 1  # about six bytes a word
    whole = spark.sparkContext.broadcast(_whole(items) if blocks > 1 else None)
    out = []
    for block in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast(sorted(tuple(r) for r in own.collect() if r.item_id is not None))  # a block's texts are bounded by ``held``

        out.append(lambda sent=sent: Items(sent.value, SIZE, radius, whole.value))
    return out


def _found(index: Items, texts: pa.Array, percent: int) -> list[tuple]:
    """(row, item_id, similarity, start_word) of texts."""
    w = words(*text_buffer(texts))
    found: list[tuple] = []
    count = np.diff(w.first)
    h, doc, _ = shingles(w, SIZE)
    hit = np.unique(doc[index.hits(h)])
    low, high = np.searchsorted(doc, hit), np.searchsorted(doc, hit, side="right")
    for d, a, b in zip(hit.tolist(), low.tolist(), high.tolist(), strict=True):
        for i, (sim, start) in matches(index, h[a:b], SIZE, percent).items():
            if index.words[i] >= SIZE or count[d] < SIZE:
                found.append((d, index.ids[i], sim, start))
    for k in index.short:
        found += _short(index, w, k)
    return found


def _short(index: Items, w, k: int) -> list[tuple]:
    """Matches of items of k < SIZE words in texts of SIZE words and more, by their exact word sequence."""
    count = np.diff(w.first)
    n = len(w.start)
    if n < k:
        return []
    value = sequences(w, k)
    inside = (w.doc[: n - k + 1] == w.doc[k - 1 :]) & (count[w.doc[: n - k + 1]] >= SIZE)
    found: dict[tuple, tuple] = {}
    for p in index.hits(value).tolist():
        if not inside[p]:
            continue
        for i in index.of[int(value[p])]:
            if index.words[i] == k:
                d = int(w.doc[p])
                found.setdefault((d, i), (d, index.ids[i], 1.0, int(p - w.first[d])))
    return list(found.values())


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
