"""Operators with exact results against brute force on the small corpus."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strandlake.llm import dac, decontaminate, jaccard_join, packing, quality, repeats, token_count, token_files
from strandlake.llm.common import new_path
from strandlake.llm.tokens import vocabulary


def words(text, lower=True):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text) if lower else text)


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return lambda name: Tokenizer.from_file(vocabulary(name))


def test_components_equal_their_sql(spark, docs, rows, tmp_path):
    """On the given tables, and on the small corpus, whose repeated rows each get a row."""
    for folder in ("/root/testdata/sf0.001", str(tmp_path)):
        if folder == str(tmp_path):
            spark.createDataFrame([r for r in rows if r[0] is not None], "doc_id long, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
        elif not os.path.isdir(folder):
            continue
        con = duckdb.connect()
        where = f"{folder}/documents.parquet"
        con.execute(f"create view documents as select * from '{where + '/*.parquet' if os.path.isdir(where) else where}'")
        got = jaccard_join.op4_jaccard_join(spark, folder)
        assert Counter(map(tuple, got.collect())) == Counter(con.execute(f"select {', '.join(got.columns)} from ({jaccard_join.OP4_SQL})").fetchall())


@pytest.mark.parametrize("dense", [2, 32])
def test_components_of_near_copies(docs, rows, nothing, dense):
    sets = [shingle_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    low = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        low[root(i)].append(doc)
    want = Counter((doc, len(sets[i]), min((d for d in low[root(i)] if d is not None), default=None)) for i, (doc, _) in enumerate(rows))
    got = Counter(tuple(r) for r in jaccard_join.jaccard_components(docs, dense=dense).collect())
    assert got == want
    if dense == 32:
        assert jaccard_join.jaccard_components(nothing).count() == 0
        kept = jaccard_join.keep_one(docs)
        assert kept.columns == docs.columns
        kept = kept.collect()
        assert {r.doc_id for r in kept} == {c for _, _, c in want}
        by = Counter(root(i) for i, s in enumerate(sets) if s)
        assert len(kept) == len(by) + sum(not s for s in sets)
        texts = {t: root(i) for i, (_, t) in enumerate(rows)}
        assert Counter(texts[r.text] for r in kept if shingle_set(r.text)) == Counter(by.keys())


def test_rows_that_share_an_id_or_have_none_are_judged_by_their_text(spark):
    a, other = " ".join(f"a{k}" for k in range(60)), " ".join(f"b{k}" for k in range(60))
    near, far = a + " end", " ".join(f"c{k}" for k in range(60))
    rows = [(3, a), (5, near), (5, far), (None, a), (None, near + " x"), (None, other), (None, other), (None, other + " y"), (7, ""), (7, ""), (7, None), (8, far.upper()), (9, "q r s"), (9, "q r s"), (9, "q r t")]
    kept = jaccard_join.keep_one(spark.createDataFrame([(i, t, k % 2) for k, (i, t) in enumerate(rows)], "doc_id long, text string, n long").repartition(3))
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    ends = {(i, t): n for (i, t), n in got.items() if t and t.startswith("b0")}
    assert list(ends.values()) == [1] and set(ends) <= {(None, other), (None, other + " y")}
    assert got - Counter(ends) == Counter({(3, a): 1, (5, far): 1, (7, ""): 2, (7, None): 1, (9, "q r s"): 1, (9, "q r t"): 1})


def test_multi_match_prefix_keeps_similar_sets_together():
    rng = np.random.RandomState(1)
    counts = rng.randint(1, 50, jaccard_join.SKETCH).astype(np.int32)
    for _ in range(50):
        x = np.unique(rng.randint(0, 2**62, 200).astype(np.uint64))
        y = np.sort(np.concatenate((x[rng.permutation(len(x))[:180]], rng.randint(0, 2**62, 10).astype(np.uint64))))
        if len(np.intersect1d(x, y)) * 100 < 80 * len(np.union1d(x, y)):
            continue
        (p, m), (q, n) = (jaccard_join.prefix(s, counts, 1.0, 80, 4) for s in (x, y))
        assert len(np.intersect1d(p, q)) >= min(m, n)


@pytest.mark.parametrize("most", [repeats.MOST, 1])
def test_repeated_bytes(docs, rows, nothing, most):
    length = 400
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(t[p : p + length] for t in raw for p in range(len(t) - length + 1))
    want = Counter()
    for (doc, _), t in zip(rows, raw, strict=True):
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if seen[t[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and (not k or not gone[k - 1]))
        want[doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    out = repeats.remove_repeats(docs, most=most).select("doc_id", "n_bytes", F.col("n_bytes") - F.octet_length("kept"), F.size("starts"), F.sha2("kept", 256))
    assert Counter(tuple(r) for r in out.collect()) == want
    assert sum(k[2] > 0 for k in want) > 10
    if most > 1:
        assert repeats.remove_repeats(nothing).count() == 0
        cut = repeats.with_text_kept(docs.withColumn("n_chars", F.length("text")))
        assert cut.count() == len(rows) and cut.where("text IS NULL").count() == 1
        assert cut.where("length(text) <> n_chars").count() == 0


def test_maximal_repeats_have_all_their_occurrences():
    left, right = [b"abcX", b"ZbcX", b"ZbcX", b"qqqq"], [b"12345", b"12345", b"129", b"000"]
    got = {(l, r, tuple(sorted(m))) for l, r, m in repeats.maximal_repeats(left, right, 5)}
    assert got == {(3, 5, (0, 1)), (3, 2, (0, 1, 2)), (4, 2, (1, 2))}


def test_maximal_repeats_equal_brute_force():
    rng = random.Random(3)
    for _ in range(60):
        left, right = ([bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 6))) for _ in range(9)] for _ in range(2))
        want = set()
        for l in range(7):
            for r in range(1, 7):
                groups = defaultdict(list)
                for i, (x, y) in enumerate(zip(left, right, strict=True)):
                    if len(x) >= l and len(y) >= r and l + r >= 4:
                        groups[x[len(x) - l :], y[:r]].append(i)
                for g in groups.values():
                    before = {left[i][len(left[i]) - l - 1 : len(left[i]) - l] if len(left[i]) > l else i for i in g}
                    after = {right[i][r : r + 1] or i for i in g}
                    if len(g) > 1 and len(before) > 1 and len(after) > 1:
                        want.add((l, r, tuple(g)))
        assert {(l, r, tuple(sorted(m))) for l, r, m in repeats.maximal_repeats(left, right, 4)} == want


def test_token_files_round_trip(spark, docs, rows, nothing, library):
    coder = library("word_bpe_49k.json")
    path = new_path(spark, "tokens")
    token_files.write_tokens(docs, path)
    got = sorted(((r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) for r in token_files.document_tokens(token_files.read_tokens(spark, path)).collect()), key=lambda r: r[1])
    want = [(i, coder.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))]
    assert [(i, ids) for i, _, ids in got] == want
    assert [s for _, s, _ in got] == np.cumsum([0] + [len(ids) for _, ids in want])[:-1].tolist()
    empty = new_path(spark, "tokens")
    token_files.write_tokens(nothing, empty)
    assert token_files.document_tokens(token_files.read_tokens(spark, empty)).count() == 0


@pytest.mark.parametrize("top", [1, 15, 16, 255, 256, 50_000, 2**32 - 1])
def test_codes_give_any_value_without_decoding_the_rest(top):
    rng = np.random.RandomState(top % 1000)
    values = (rng.randint(0, top + 1, 5000, dtype=np.int64) >> rng.randint(0, 20, 5000)).astype(np.uint32)
    for part in (values, values[:0], values[:1], values[:513]):
        reader = dac.Reader(dac.encode(part))
        assert reader.all().tolist() == part.tolist()
        assert [reader[i] for i in range(0, len(part), 97)] == part[::97].tolist()


def test_packing_loses_and_repeats_nothing(docs, rows, nothing, library):
    coder = library("word_bpe_49k.json")
    pieces = packing.pack(docs).collect()
    windows, texts = defaultdict(list), defaultdict(list)
    for p in pieces:
        windows[p.sequence_id].append(p)
        texts[p.doc_id].append(p)
    for own in windows.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0] + [p.length for p in own])[:-1].tolist() and sum(p.length for p in own) <= 4096
    want = Counter()
    for doc, t in rows:
        want[doc] += len(coder.encode(t or "", add_special_tokens=False).ids) + 1
    assert Counter({d: sum(p.length for p in ps) for d, ps in texts.items()}) == want
    long_ = sorted(texts[500], key=lambda p: p.start)
    assert b"".join(p.ids for p in long_) == np.array(coder.encode(dict(rows)[500], add_special_tokens=False).ids + [2], "<u4").tobytes()
    assert len(windows) <= -(-sum(want.values()) // 4096) + 2
    assert packing.pack(nothing).count() == 0


def test_packer_fills_windows():
    packer = packing.Packer(100, 4, 5, cut=lambda p, k: (p, p))
    for n in np.random.RandomState(0).randint(1, 250, 500).tolist():
        packer.put("p", n)
    assert len(packer.gaps) <= 4


def test_token_counts_equal_the_library(docs, rows, nothing, library):
    coder = library("byte_bpe_50k.json")
    want = Counter((i, len((t or "").encode()), n := len(coder.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in rows)
    assert Counter(tuple(r) for r in token_count.token_counts(docs).collect()) == want
    assert token_count.token_counts(nothing).count() == 0


def test_rule_statistics(docs, rows, nothing):
    want = Counter()
    for doc, t in rows:
        t = t or ""
        w = words(t, lower=False)
        n = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {p for k in range(len(w) - 4) if n[tuple(w[k : k + 5])] > 1 for p in range(k, k + 5)}
        lines, seen = 0, set()
        for line in t.split("\n"):
            if words(line):
                lines += line in seen
                seen.add(line)
        want[doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), lines, len(covered)] += 1
    assert Counter(tuple(r) for r in quality.rule_statistics(docs).collect()) == want
    assert quality.rule_statistics(nothing).count() == 0


def test_quality_rejects_what_no_good_document_looks_like(spark, docs, rows):
    junk = spark.createDataFrame([(1000 + k, " | ".join(["word"] * 5 + [f"w{k}{j}" for j in range(30)])) for k in range(20)], "doc_id long, text string")
    both = docs.select("doc_id", "text").unionAll(junk)
    labels = both.select("doc_id", (F.col("doc_id") < 1000).cast("int").alias("quality"))
    got = {r.doc_id: r for r in quality.judge(both, labels).collect()}
    assert sum(got[1000 + k].kept for k in range(20)) <= 2
    good = [got[i] for i in range(60) if not got[i].base_failed]
    assert sum(r.kept for r in good) >= 0.9 * len(good)
    none = {r.doc_id: r for r in quality.judge(both, labels.limit(0)).collect()}
    assert all(r.kept != r.base_failed for r in none.values())


def test_the_forest_and_its_threshold_are_of_all_labelled_documents(spark):
    rows = [(k, 20 + k % 50, 100 + 7 * (k % 90), k % 3, k % 4, 0, False) for k in range(12000)]
    stats = spark.createDataFrame(rows, quality.STATS + ",base_failed boolean")
    labels = stats.select("doc_id", (F.col("doc_id") % 10 != 0).cast("int").alias("quality"))
    forest, limit = quality.fit_forest(stats, labels)
    x = quality.features(list(np.array([r[1:6] for r in rows if r[0] % 10], float).T))
    scores = np.sort(forest.score(x))
    assert limit == scores[min(len(scores) - 1, math.ceil((1 - quality.LOST) * len(scores)))]
    every = quality.features(list(np.array([r[1:6] for r in rows], float).T))
    splits = quality.Splits(every.min(axis=0), every.max(axis=0))
    assert splits.counts(x).sum() == quality.TREES * 10800
    assert np.array_equal(np.sort(quality.IsolationForest(splits, splits.counts(x)).score(x)), scores)
    assert float(quality._path(2)) == pytest.approx(1, abs=0.01) and float(quality._path(1)) == 0


def test_held_items_are_found(spark, docs, item, nothing):
    bench = spark.createDataFrame([(1, item), (2, "one"), (3, None), (4, "never said anywhere in here"), (5, "x " + item)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, bench).collect()}
    assert got[210, 1] == 1.0 and got[211, 1] == 1.0 and got[212, 1] >= 0.8
    assert (213, 1) not in got and got[303, 2] == 1.0 and got[304, 2] == 1.0
    assert {i for _, i in got} <= {1, 2, 5} and all(s >= 0.8 for s in got.values())
    blocks = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench, held=20).collect()}
    assert blocks == set(got)
    assert decontaminate.contaminated(nothing, bench).count() == 0 and decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_blocks_of_a_benchmark_weigh_by_the_whole_of_it(spark):
    """Against all item-sized windows, scored exactly; items share passages, and texts are near the limit."""
    rng = np.random.RandomState(11)
    word = lambda: f"w{rng.randint(10**6)}"
    shared = [[word() for _ in range(14)] for _ in range(3)]
    items = [shared[i % 3] + [word() for _ in range(12 + i % 9)] for i in range(24)]
    texts = []
    for i, it in enumerate(items):
        for cut in range(0, 9, 2):
            other = items[(i + 7) % 24][14 - cut : 14] if i % 2 else [word() for _ in range(cut)]
            texts.append([word() for _ in range(6)] + it[: len(it) - cut] + other + [word() for _ in range(6)])
            texts.append([word() for _ in range(3)] + it[cut:] + shared[(i + 1) % 3][:cut])
    bag = lambda w: {tuple(w[p : p + 5]) for p in range(len(w) - 4)}
    count = {}
    for it in items:
        for t in bag(it):
            count[t] = count.get(t, 0) + 1
    weight = lambda bags: sum(np.log1p(len(items) / count.get(t, 1)) for t in bags)
    want = {}
    for d, text in enumerate(texts):
        for i, it in enumerate(items):
            best = max(weight(b & bag(it)) / weight(b | bag(it)) for b in (bag(text[p : p + len(it)]) for p in range(max(1, len(text) - len(it) + 1))))
            if best >= 0.8 - 1e-11:
                want[d, i] = pytest.approx(best)
    docs = spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(None, " ".join(items[0])), (99, " ")], "item_id long, text string")
    assert 24 < len(want) < 24 * 10
    for held in (decontaminate.HELD, 200):
        assert {(r.doc_id, r.item_id): r.similarity for r in decontaminate.contaminated(docs, bench, held=held).collect()} == want


def test_near_fingerprints_are_all_found():
    rng = np.random.RandomState(2)
    entries = rng.randint(0, 2**62, 300, dtype=np.int64).astype(np.uint64)
    queries = entries[:100].copy()
    for k in range(100):
        for b in rng.choice(64, rng.randint(0, 24), replace=False):
            queries[k] ^= np.uint64(1) << np.uint64(b)
    q, e = decontaminate.HammingIndex(entries).near(queries)
    want = {(i, j) for i in range(100) for j in range(300) if bin(int(queries[i]) ^ int(entries[j])).count("1") <= decontaminate.RADIUS}
    assert set(zip(q.tolist(), e.tolist(), strict=True)) == want
