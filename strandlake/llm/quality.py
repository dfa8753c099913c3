"""Quality verdicts: rule statistics of whole texts, and an isolation forest over them calibrated on labelled documents."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, record, slices, stored, table, text_buffer, trimmed
from .words import U64, mix, shingles, words

#: Trees, good documents that a tree's path lengths are those of, depth, and the share of good labelled documents that may lie beyond the threshold.
TREES, SIZE, DEPTH, LOST = 100, 256, 12, 0.004
_SPACES = " \t\n\x0b\x0c\r"

STATS = "doc_id long,n_words long,word_chars long,n_symbols long,n_dup_lines long,n_repeat_words long"
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _per_text(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[ends[1:]] - total[ends[:-1]]


def _repeated_lines(text: str) -> int:
    seen: set[str] = set()
    again = 0
    for line in text.split("\n"):
        if line.strip(_SPACES):
            again += line in seen
            seen.add(line)
    return again


def rule_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """STATS of every row: words, code points in them, symbols, repeated lines, and words in repeated 5-word windows.

    Null and empty texts have zeros. Repeated rows and null ids each give a row; other columns are ignored.
    """

    def run(batches):
        for part in slices(batches):
            data, ends = text_buffer(part.column(1))
            w = words(data, ends)
            h, doc, at = shingles(w, 5, lower=False)
            whole = np.diff(w.first)[doc] >= 5
            h, doc, at = h[whole], doc[whole], at[whole]
            key = h ^ mix(doc.astype(U64))
            order = np.argsort(key, kind="stable")
            same = key[order][1:] == key[order][:-1]
            again = at[order[np.unique(np.concatenate((np.flatnonzero(same), np.flatnonzero(same) + 1)))]] if same.any() else at[:0]
            marks = np.zeros(len(w.start) + 6, np.int64)
            np.add.at(marks, again, 1)
            np.add.at(marks, again + 5, -1)
            covered = np.cumsum(marks)[: len(w.start)] > 0
            space = (data == 32) | ((data >= 9) & (data <= 13))
            letters = ~space & ((data & 0xC0) != 0x80)
            yield record(STATS, part.column(0), np.diff(w.first), _per_text(letters, ends), _per_text(_SYMBOL[data], ends), [_repeated_lines(t) for t in part.column(1).to_pylist()], _per_text(covered, w.first))

    return documents(df, id_col, text_col).mapInArrow(trimmed(run), STATS)


def features(stats: list[np.ndarray]) -> np.ndarray:
    """Mean word length, symbols per word, repeated lines and repeated words per word; shares are square-rooted."""
    n_words, chars, symbols, lines, repeats = (np.asarray(x, float) for x in stats)
    per = np.maximum(n_words, 1)
    return np.stack([chars / per, np.sqrt(symbols / per), np.sqrt(lines / per), np.sqrt(repeats / per)], axis=1)


def _path(n: np.ndarray) -> np.ndarray:
    """The mean path length of an unsuccessful search among n values, of any n that is not whole too."""
    n = np.maximum(np.asarray(n, float), 1)
    return np.where(n > 1, np.maximum(2 * (np.log(n - 0.5) + 0.5772156649 + 1 / (24 * (n - 0.5) ** 2)) - 2 * (n - 1) / n, 0), 0.0)


class Splits:
    """Whole binary trees whose splits are drawn from the box [low, high] that rows may lie in, whatever the rows.

    Node k of a tree has the children 2k + 1 (up to the split) and 2k + 2.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = 11):
        rng = np.random.RandomState(seed)
        self.trees, self.depth, self.feature, self.split = trees, depth, np.zeros((trees, (1 << depth) - 1), np.int8), np.zeros((trees, (1 << depth) - 1))
        low, high = (np.broadcast_to(x, (trees, 1, len(x))).copy() for x in (low, high))
        for level in range(depth):
            f = rng.randint(low.shape[2], size=(trees, 1 << level))[..., None]
            a, b = np.take_along_axis(low, f, 2), np.take_along_axis(high, f, 2)
            split = a + (b - a) * rng.random_sample(f.shape)
            own = slice((1 << level) - 1, (2 << level) - 1)
            self.feature[:, own], self.split[:, own] = f[..., 0], split[..., 0]
            below, above = high.copy(), low.copy()
            np.put_along_axis(below, f, split, 2)
            np.put_along_axis(above, f, split, 2)
            low, high = (np.stack(x, 2).reshape(trees, 2 << level, -1) for x in ((low, above), (below, high)))

    def counts(self, rows: np.ndarray) -> np.ndarray:
        """Rows in each tree's parts at the full depth."""
        every, out = np.arange(len(rows)), np.zeros((self.trees, 1 << self.depth), np.int64)
        for k in range(self.trees):
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (rows[every, self.feature[k, at]] > self.split[k, at])
            out[k] = np.bincount(at - (1 << self.depth) + 1, minlength=1 << self.depth)
        return out


class IsolationForest:
    """score(rows): 2 ** -(mean path length / that of a random search); near 1 for rows that few splits isolate.

    ``counts`` are how many of all ordinary rows lie in each tree's parts. A path ends where of ``size`` ordinary rows
    at most one is to be expected: what is unlike all ordinary rows falls early into such a part.
    """

    def __init__(self, splits: Splits, counts: np.ndarray, size: int = SIZE):
        self.size, self.depth, self.trees = int(min(size, counts[0].sum())), splits.depth, []
        for k in range(splits.trees):
            levels = [counts[k]]
            while len(levels[0]) > 1:
                levels.insert(0, levels[0].reshape(-1, 2).sum(axis=1))
            expected = np.concatenate(levels) * (self.size / max(counts[k].sum(), 1))
            inner = len(splits.feature[k])
            ends = expected <= 1
            ends[inner:] = True
            reached = np.zeros(len(ends), bool)
            reached[0] = True
            for level in range(self.depth):
                own = np.arange((1 << level) - 1, (2 << level) - 1)
                reached[2 * own + 1] = reached[2 * own + 2] = reached[own] & ~ends[own]
            kept = np.flatnonzero(reached)
            place = np.cumsum(reached) - 1
            goes = ~ends[kept]
            child = np.where(goes, 2 * kept + 1, 0)
            depth = np.floor(np.log2(kept + 1))
            parent = np.minimum(kept, inner - 1)
            self.trees.append((np.where(goes, splits.feature[k][parent], -1), splits.split[k][parent], place[child], place[np.where(goes, child + 1, 0)], depth + _path(expected[kept])))

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, split, left, right, length in self.trees:
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                f = feature[at]
                go = rows[every, np.maximum(f, 0)] <= split[at]
                at = np.where(f < 0, at, np.where(go, left[at], right[at]))
            total += length[at]
        return 2.0 ** (-total / len(self.trees) / max(float(_path(self.size)), 1e-9))


def _batch_features(batch: pa.RecordBatch) -> np.ndarray:
    return features([batch.column(i).to_numpy() for i in range(1, 6)])


def _placed(scores: DataFrame, place: int) -> float:
    """The value at a place of the sorted ``score`` column, 0 to 1: told from counts of ever smaller bins, so that nothing is sorted as a whole."""
    low: Column = F.lit(True)
    for bits in (12, 24, 0):
        key = F.floor(F.col("score") * (1 << bits)) if bits else F.col("score")
        for row in sorted(scores.where(low).groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()):  # 4097 bins at most, and the values of one of 2^-24
            if place < row.n:
                break
            place -= row.n
        low = low & (key == F.lit(row.k))
    return float(row.k)


def fit_forest(stats: DataFrame, labels: DataFrame, lost: float = LOST) -> tuple[IsolationForest | None, float]:
    """(forest, threshold) from all labelled documents (doc_id, quality 0/1) that the base rules keep.

    The trees' splits lie in the box that all of them span, and their parts count the good ones, each task for its own
    rows. The threshold is the score that a share of ``lost`` of the good ones exceed. Without good labelled documents
    there is no forest, and the base rules decide alone.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label")).dropna().groupBy("doc_id").agg(F.min("label").alias("label"))
    names = [c.split()[0] for c in STATS.split(",")[1:]]
    each = stats.where("NOT base_failed").join(known, "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct(*names)).alias("s"))
    each = stored(each.select("doc_id", "s.*", "label"), "labelled")
    good = each.where("label = 1")

    def box(batches):
        for batch in batches:
            if batch.num_rows:
                x = _batch_features(batch)
                yield record("f int,low double,high double", list(range(x.shape[1])), x.min(axis=0), x.max(axis=0))

    edges = sorted(each.mapInArrow(trimmed(box), "f int,low double,high double").groupBy("f").agg(F.min("low"), F.max("high")).collect())
    n = good.count()
    if not n:
        return None, math.inf
    splits = Splits(np.array([r[1] for r in edges]), np.array([r[2] for r in edges]))
    sent = stats.sparkSession.sparkContext.broadcast(splits)

    def count(batches):
        total = np.zeros((TREES, 1 << DEPTH), np.int64)
        for batch in batches:
            total += sent.value.counts(_batch_features(batch))
        tree, part = np.nonzero(total)
        yield record("tree int,part int,n long", tree, part, total[tree, part])

    counts = np.zeros((TREES, 1 << DEPTH), np.int64)
    for r in good.mapInArrow(trimmed(count), "tree int,part int,n long").groupBy("tree", "part").agg(F.sum("n").alias("n")).toLocalIterator():  # a row for each part of each tree
        counts[r.tree, r.part] = r.n
    forest = IsolationForest(splits, counts)
    judge_ = stats.sparkSession.sparkContext.broadcast(forest)

    def score(batches):
        for batch in batches:
            yield record("score double", judge_.value.score(_batch_features(batch)))

    scores = stored(good.mapInArrow(trimmed(score), "score double"), "scores")
    return forest, _placed(scores, min(n - 1, math.ceil((1 - lost) * n)))


def judge(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """STATS, base_failed, anomaly (isolation score, 0 to 1) and kept of every row.

    base_failed: under 10 words, or over 20 in 100 words in repeated windows. kept: the base rules pass and the anomaly
    is no greater than the threshold calibrated on ``labels``. An empty table gives an empty result.
    """
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    stats = stored(rule_statistics(df, id_col, text_col).withColumn("base_failed", base), "statistics")
    model = fit_forest(stats, labels)
    sent = df.sparkSession.sparkContext.broadcast(model)
    ddl = STATS + ",base_failed boolean,anomaly double,kept boolean"

    def run(batches):
        forest, limit = sent.value
        for batch in batches:
            rows = features([batch.column(i).to_numpy() for i in range(1, 6)])
            score = forest.score(rows) if forest else np.zeros(len(rows))
            failed = batch.column(6).to_numpy(zero_copy_only=False).astype(bool)
            yield record(ddl, *batch.columns, score, ~failed & (score <= limit))

    return stats.mapInArrow(trimmed(run), ddl)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    names = [c.split()[0] for c in STATS.split(",")]
    return rows.select(*names, "base_failed", "kept", "anomaly")
