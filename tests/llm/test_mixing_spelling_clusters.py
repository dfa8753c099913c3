"""Mixing, spelling variants and centroid clusters against plain versions, on odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from strandlake.llm import clustering, mixing, spelling


def shares(sizes, weights, share, epochs):
    """Targets by sharing again and again what the limits cut off."""
    target, left = {}, share * sum(sizes.values())
    free = dict(weights)
    while free:
        over = {s for s, w in free.items() if left * w / sum(free.values()) >= epochs * sizes[s]}
        if not over:
            return target | {s: left * w / sum(free.values()) for s, w in free.items()}
        for s in over:
            target[s] = epochs * sizes[s]
        left = left - sum(target[s] for s in over)
        free = {s: w for s, w in free.items() if s not in over}
    return target


def mix_rows():
    rng = random.Random(5)
    rows = [(k, " ".join("w" * rng.randint(1, 5) for _ in range(rng.randint(0, 60))), f"src{int(rng.random() ** 3 * 7)}") for k in range(900)]
    rows += [(None, "a null id", "src1"), (None, None, None), (4000, "", None), (4001, "no source here", None), (4002, "\t\n", "empty"), (4003, "é\x1cb c\x0bd", "Zebra")]
    return rows + [(5000, "the same row again", "hot")] * 300 + [(5001, " ".join(["long"] * 30_000), "src2")]


def test_mix_takes_each_source_to_its_target(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 64)
    rows = mix_rows()
    df = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "doc_id long, text string, source string, size long, key string, target double")
    got = mixing.mix(df).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    want = shares(sizes, {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, 1.5, 2)
    assert Counter((r.doc_id, r.source, r["size"]) for r in got) == Counter((i, s, size(t)) for i, t, s in rows)
    taken = Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r["size"] and r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source])
        taken[r.source] += r.taken
    assert all(taken[s] == math.floor(want[s] + 1e-6) or sizes[s] == 0 for s in sizes)
    for s in sizes:  # whole epochs for all, one more for those before the cut, at most one row in part
        part = [r for r in got if r.source == s and r["size"] and r.taken % r["size"]]
        assert len(part) <= 1
    again = mixing.mix(df.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixture_spells_the_mix_out(spark):
    rows = mix_rows()[:200]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {r.doc_id: r.taken for r in mixing.mix(df).collect() if r.taken}
    got, texts = Counter(), {i: t for i, t, _ in rows}
    for r in mixing.mixture(df).collect():
        assert len(r.text.split()) == r.n_words and texts[r.doc_id].startswith(r.text)
        got[r.doc_id] += r.n_words
    assert got == want


def test_mix_agrees_with_its_sql(spark, tmp_path):
    rows = [(k, t, s) for k, (_, t, s) in enumerate(mix_rows())]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = mixing.op11_mixing(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(f"select {', '.join(got.columns)} from ({mixing.OP11_SQL})").fetchall())


def variants(rows):
    """Brute force: words, counts, near words by comparing every two, forms and roots."""
    n = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            n[w[: h % len(w)] + w[h % len(w) + 1 :] if h % 31 == 0 else w] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
    near = defaultdict(list)
    for a in n:
        for b in n:
            if len(a) == len(b):
                if sum(x != y for x, y in zip(a, b)) == 1:
                    near[a].append(b)
            elif len(a) == len(b) + 1 and any(a[:k] + a[k + 1 :] == b for k in range(len(a))):
                near[a].append(b)
                near[b].append(a)
    form = {w: min(x, key=lambda v: (-n[v], v)) for w, x in near.items()}
    form = {w: f for w, f in form.items() if n[f] >= 10 * n[w]}
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def test_variants_equal_brute_force(spark, rows):
    rng = random.Random(8)
    words = ["".join(rng.choice("aé") for _ in range(rng.randint(6, 9))) for _ in range(250)]
    chain = [("letters", 2400), ("lettersa", 160), ("lettersab", 9), ("lettersabc", 1), ("Étagère", 20), ("étagère", 2), ("aaaaaaa", 4), ("aaaaaaaa", 40), ("x" * 3000, 2), ("x" * 3001, 2)]
    more = [(7000 + k, " ".join(rng.choice(words) for _ in range(rng.randint(1, 40)))) for k in range(300)]
    more += [(8000 + 31 * k + j, w) for k, (w, n) in enumerate(chain) for j in range(n)] + [(9000, "a_b-cdefghi×jklmnoÿ÷p ĀĀĀbcdefgh CAPITALS capitals")]
    every = rows + more
    df = spark.createDataFrame([(i, t, "k", 5) for i, t in every], "doc_id long, text string, word string, n long").repartition(5)
    got = spelling.spelling_variants(df)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = got.collect()
    want = variants(every)
    assert len(got) == len(want) and set(map(tuple, got)) == want
    assert ("lettersab", "lettersa", "letters") in {r[:3] for r in want} and sum(r[4] > 5 for r in want) > 20


def test_trie_nodes_are_numbered_alike_across_ranges(spark):
    words = sorted({a + b + c for a in ("inter", "international", "inte") for b in ("", "net", "nets", "al") for c in ("work", "works", "play", "")})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        table = spelling._path_numbers(df, "word", "pre")
        table = spelling._resolved(table, "pre", spelling._shared_nodes(table, "word", "pre")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len({r.pre_id >> spelling.LOCAL for r in table}) > 1
    node = {}
    for r in table:
        for d, k in enumerate(r.pre):
            assert node.setdefault(r.word[:d], k) == k
    assert len(set(node.values())) == len(node)
    assert [r.word for r in sorted(table, key=lambda r: r.pre_id)] == words


def test_no_words_no_variants(spark, nothing):
    assert spelling.spelling_variants(nothing).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (2, ""), (3, "short one")], "doc_id long, text string")).count() == 0


def lloyd(vectors, ids, k=8, rounds=10):
    """(cluster, distance) of each vector and the centroids, in Python's own integers."""
    sha = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    raw = lambda v: np.array(v, "<i4").tobytes()
    first = sorted(range(len(ids)), key=lambda j: (sha(ids[j]), raw(vectors[j])))[:k]
    centroids = [list(vectors[j]) for j in first]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        held = defaultdict(list)
        for v in vectors:
            held[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(held[j]) for x in zip(*held[j])] if held[j] else c for j, c in enumerate(centroids)]
    return [nearest(v)[::-1] for v in vectors], centroids


@pytest.mark.parametrize("n", [3, 150])
def test_clusters_equal_plain_rounds(spark, n):
    rng = np.random.RandomState(n)
    base = rng.normal(0, 0.4, (6, 64))
    x = (base[rng.randint(0, 6, n)] + rng.normal(0, 0.05, (n, 64))).astype(np.float32)
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)] + [(int(i), x[i].tolist()) for i in range(n // 10)]
    if n > 100:
        rows += [(None, x[0].tolist()), (901, [3e38] * 64), (902, [-3e38] + [0.0] * 63)]
    bad = [(910, None), (911, []), (912, [0.5] * 63), (913, [float("nan")] + [0.0] * 63), (914, [float("inf")] * 64), (915, [None] + [0.0] * 63), (916, [0.5] * 65)]
    df = spark.createDataFrame([(i, v, 1, "y") for i, v in rows + bad], "vec_id long, embedding array<float>, cluster int, v string").repartition(4)
    got, centroids = clustering.cluster(df)
    got = got.collect()
    whole = [[max(-clustering.MOST, min(clustering.MOST, math.floor(1024 * c))) for c in np.array(v, np.float32).astype(float)] for _, v in rows]
    want, last = lloyd(whole, [i for i, _ in rows])
    assert centroids.tolist() == last
    assert Counter((r.vec_id, r.cluster, r.distance) for r in got) == Counter((i, c, d) for (i, _), (c, d) in zip(rows, want))
    by = Counter()
    for c, d in want:
        by[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in last]
    assert all(r.cluster_inertia == by[r.cluster] and r.inertia == sum(by.values()) and r.centroid_sha256 == sha[r.cluster] for r in got)


def test_bounds_spare_distances_and_settle_ties_exactly():
    rng = np.random.RandomState(1)
    v = np.concatenate([rng.randint(-20, 20, (400, 64)) + 400 * (k % 4) for k in range(4)]).astype(np.int64)
    history = v[[0, 400, 800, 1200]][None].astype(np.int64)
    cluster, seen, at, distance, all_ = clustering.assigned(v, history, None, None, None)
    spent = 0
    for _ in range(6):
        history = np.concatenate([history, np.stack([v[cluster == j].sum(axis=0) // (cluster == j).sum() for j in range(4)])[None]])
        cluster, seen, at, distance, count = clustering.assigned(v, history, cluster, seen, at)
        spent += count
        exact = ((v[:, None] - history[-1]) ** 2).sum(axis=2)
        assert (cluster == exact.argmin(axis=1)).all() and ((distance < 0) | (distance == exact.min(axis=1))).all()
    assert spent < all_  # six rounds cost less than one would without bounds
    same = np.stack([history[-1][0], history[-1][0], history[-1][2], history[-1][3]])
    cluster, *_ = clustering.assigned(v, np.concatenate([history, same[None]]), cluster, seen, at, last=True)
    assert (cluster == ((v[:, None] - same) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_no_vectors_no_clusters(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    got, centroids = clustering.cluster(df)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and got.count() == 0 and not len(centroids)


def test_cluster_sql_agrees(spark, tmp_path):
    rng = np.random.RandomState(9)
    rows = [(int(i), rng.normal(0, 1, 64).astype(np.float32).tolist()) for i in range(60)] + [(99, None), (98, [float("nan")] * 64)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    got = clustering.op13_centroids(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(f"select {', '.join(got.columns)} from ({clustering.OP13_SQL})").fetchall())
