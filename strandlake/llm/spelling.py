"""Spelling variants: words one inserted, deleted or replaced letter apart, by a dictionary of trie-node pairs.

The vocabulary is sorted twice, as it is and with words reversed, and one scan of each order numbers the nodes of the
forward and of the reversed trie: a prefix or suffix gets its number where it first appears. Ranges are scanned apart;
where a range begins inside a branch, the numbers of the range before it hold, which a row for each range tells. A word
then has, at each position, two keys: (prefix node, suffix node) with the letter between them skipped, and without a
skip. Words that share a skip key differ by that letter alone; a word whose plain key equals another's skip key lacks
it. So all near words meet on pairs of integers, with nothing to verify, and no key has more words than there are letters.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, scratch, slices, stored, table, trimmed

SHORTEST, LEAST, RATIO, TYPO = 7, 2, 10, 31
#: Different words that a task counts before it passes their counts on.
COUNTED = 1 << 16
#: Bits of a number within its range.
LOCAL = 36
_KEYS = pa.schema([("p", pa.int64()), ("s", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("skip", pa.bool_()), ("head", pa.bool_())])


def word_counts(df: DataFrame, shortest: int = SHORTEST, typo: int = TYPO, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): occurrences of the words of at least ``shortest`` letters in whole texts, A-Z lower-cased.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF. Where ``typo`` divides the crc32 of '<doc_id>:<run>', the
    run loses its letter at that number modulo its length. A null id stands as an empty string.
    """
    runs = re.compile("[a-zÀ-ÿ]{%d,}" % shortest).findall

    def run(batches):
        held: Counter = Counter()

        def flush():
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return out

        for batch in slices(batches):
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                salt = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word, n in Counter(runs(text.encode().lower().decode())).items():  # bytes lower A-Z alone
                    h = zlib.crc32(word.encode(), salt)
                    if not h % typo:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < shortest:
                            continue
                    held[word] += n
                if len(held) >= COUNTED:
                    yield flush()
        if held:
            yield flush()

    return documents(df, id_col, text_col).mapInArrow(trimmed(run), "word string,n long").groupBy("word").agg(F.sum("n").alias("n"))


def _common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def _path_numbers(words: DataFrame, word: str, name: str) -> DataFrame:
    """words in order of ``word`` with id (their place, by range) and the array ``name``: the trie nodes of its prefixes, shortest first.

    A range numbers its nodes as they appear, so those of its first word are 0, 1, 2, ... in it.
    """
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in words.schema]

    def run(batches):
        part = TaskContext.get().partitionId() << LOCAL
        place, made, last, path = 0, 0, "", []
        for batch in batches:
            ids, paths = [], []
            for w in batch.column(batch.schema.get_field_index(word)).to_pylist():
                keep = _common(last, w) + 1 if path else 0
                fresh = range(part + made, part + made + len(w) + 1 - keep)
                path = path[:keep] + list(fresh)
                made += len(fresh)
                last = w
                ids.append(part + place)
                paths.append(path)
                place += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.int64()), pa.array(paths, pa.list_(pa.int64()))], names=[*batch.schema.names, f"{name}_id", name])

    ordered = words.repartitionByRange(word).sortWithinPartitions(word)
    return stored(ordered.mapInArrow(trimmed(run), ",".join([*fields, f"{name}_id long", f"{name} array<long>"])), name)


def _shared_nodes(numbered: DataFrame, word: str, name: str) -> dict[int, int]:
    """The nodes that a range numbered anew though an earlier range has them, and the earlier numbers.

    They lie on the path of the range's first word, as far as it agrees with the last word before the range. One row for
    each range comes to the driver.
    """
    edge = numbered.groupBy(F.shiftright(f"{name}_id", LOCAL).alias("part")).agg(F.min_by(word, f"{name}_id").alias("first"), F.max_by(F.struct(word, name), f"{name}_id").alias("last"))
    same: dict[int, int] = {}
    before = None
    for r in sorted(edge.collect(), key=lambda r: r.part):
        if before is not None:
            for d in range(_common(before[0], r.first) + 1):
                same[(r.part << LOCAL) + d] = same.get(before[1][d], before[1][d])
        before = r.last
    return same


def _keys(words: DataFrame) -> DataFrame:
    """(p, s, id, n, skip, head) of words (word, n, id, pre, suf) at each position, with the letter there skipped and not.

    head marks the first of equal letters in a row: skipping any of them gives the same word.
    """

    def run(batches):
        for batch in batches:
            cols: list[list] = [[] for _ in _KEYS]
            for w, n, id_, pre, suf in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                size = len(w)
                cols[0] += pre[:-1] + pre
                cols[1] += suf[size - 1 :: -1] + suf[::-1]
                cols[2] += [id_] * (2 * size + 1)
                cols[3] += [n] * (2 * size + 1)
                cols[4] += [True] * size + [False] * (size + 1)
                cols[5] += [not i or w[i] != w[i - 1] for i in range(size)] + [False] * (size + 1)
                if len(cols[0]) > 1 << 16:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _KEYS, strict=True)], schema=_KEYS)
                    cols = [[] for _ in _KEYS]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _KEYS, strict=True)], schema=_KEYS)

    return words.select("word", "n", "id", "pre", "suf").mapInArrow(trimmed(run), "p long,s long,id long,n long,skip boolean,head boolean")


def _resolved(df: DataFrame, name: str, same: dict[int, int]) -> DataFrame:
    """df with the nodes of ``same`` (a few for each range) replaced in the array ``name``."""
    if not same:
        return df
    sent = df.sparkSession.sparkContext.broadcast(same)
    at = df.columns.index(name)

    def run(batches):
        for batch in batches:
            fixed = [[sent.value.get(x, x) for x in path] for path in batch.column(at).to_pylist()]
            yield batch.set_column(at, name, pa.array(fixed, pa.list_(pa.int64())))

    return df.mapInArrow(trimmed(run), df.schema)


def near_words(words: DataFrame) -> DataFrame:
    """(id, n_near, best): how many words are near a word, and (n, -id) of the most frequent; words (word, n, id, pre, suf).

    Ids follow code point order, so the greatest (n, -id) is the smallest of equally frequent words. Words without
    near ones are not there.
    """
    keys = _keys(words).repartition("p", "s")
    pair, kind = Window.partitionBy("p", "s"), Window.partitionBy("p", "s", "skip").orderBy(F.desc("n"), "id")
    value = F.struct("n", (-F.col("id")).alias("back"))
    all_ = kind.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    keys = keys.withColumns({"place": F.row_number().over(kind), "next": F.lead(value).over(kind), "top": F.first(value).over(all_), "held": F.count(F.lit(1)).over(all_)})
    longer = F.when(F.col("skip") & F.col("head"), value)
    keys = keys.withColumns({"plain": F.max(F.when(~F.col("skip"), value)).over(pair), "longer": F.max(longer).over(pair), "n_longer": F.count(longer).over(pair)})
    replaced = F.col("skip") & (F.col("held") > 1)
    shorter = F.col("skip") & F.col("head") & F.col("plain").isNotNull()
    grown = ~F.col("skip") & (F.col("n_longer") > 0)
    met = keys.where(replaced | shorter | grown)
    count = F.when(replaced, F.col("held") - 1).otherwise(0) + F.when(shorter, 1).otherwise(0) + F.when(grown, F.col("n_longer")).otherwise(0)
    best = F.greatest(F.when(replaced, F.when(F.col("place") == 1, F.col("next")).otherwise(F.col("top"))), F.when(shorter, F.col("plain")), F.when(grown, F.col("longer")))
    return met.select("id", count.alias("count"), best.alias("best")).groupBy("id").agg(F.sum("count").alias("n_near"), F.max("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, root) of forms (id, form): the last word that following forms leads to. Each round doubles the steps taken.

    A form is ``RATIO`` times as frequent, so that chains are short and end.
    """
    now = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        now = stored(now.join(step, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not now.where("moved").limit(1).count():
            return stored(now.select("id", "root"), "roots", keep=True)
        now = now.select("id", "root")


def spelling_variants(df: DataFrame, shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO, typo: int = TYPO, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of the words of at least ``shortest`` letters that occur ``least`` times or more.

    Near words differ by one inserted, deleted or replaced letter. form is the most frequent near word (ties: the
    smallest), if it is at least ``ratio`` times as frequent, else null; root is what following forms leads to. Null and
    empty texts have no words; repeated rows count each time; other columns are ignored; an empty table gives an empty result.
    """
    spark = df.sparkSession
    with scratch(spark):
        counted = stored(word_counts(df, shortest, typo, id_col, text_col).where(F.col("n") >= least), "words")
        forward = _path_numbers(counted, "word", "pre")
        back = _path_numbers(forward.select(F.reverse("word").alias("drow"), F.col("pre_id").alias("id")), "drow", "suf")
        forward, back = _resolved(forward, "pre", _shared_nodes(forward, "word", "pre")), _resolved(back, "suf", _shared_nodes(back, "drow", "suf"))
        words = stored(forward.withColumnRenamed("pre_id", "id").join(back.select("id", "suf"), "id"), "vocabulary")
        near = stored(near_words(words), "near")
        plain = stored(words.select("id", "word", "n"), "plain", keep=True)
        linked = plain.join(near, "id", "left").withColumn("form", F.when(F.col("best.n") >= ratio * F.col("n"), -F.col("best.back")))
        linked = stored(linked.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", F.when(F.col("form").isNotNull(), F.col("best.n")).alias("form_n")), "linked", keep=True)
        roots = _roots(linked.where("form IS NOT NULL"))
    names = lambda c: plain.select(F.col("id").alias(c), F.col("word").alias(f"{c}_word"))
    some = linked.where("form IS NOT NULL").join(roots, "id").join(names("form"), "form").join(names("root"), "root")
    changed = some.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n")
    return linked.where("form IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n").unionByName(changed)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
