"""Interval algebra against sets of single positions."""

import random

import pytest

from strandlake.operators import intervals as iv

COLUMNS = "seqnames string, start_pos long, end_pos long"


def rows(seed, n, longest=40):
    rng = random.Random(seed)
    return [(rng.choice("xy"), s := rng.randint(1, 300), s + rng.randint(0, longest)) for _ in range(n)]


def bases(intervals):
    return {(c, p) for c, s, e, *_ in intervals for p in range(s, e + 1)}


@pytest.fixture(scope="module")
def two(spark):
    a, b = rows(1, 40), rows(2, 15)
    return a, b, spark.createDataFrame(a, COLUMNS), spark.createDataFrame(b, COLUMNS)


def test_merge_is_the_union_and_idempotent(two):
    a, _, x, _ = two
    once = iv.merge(x, tile=64)
    got = [tuple(r) for r in once.collect()]
    assert bases(got) == bases(a) and len(bases(got)) == sum(e - s + 1 for _, s, e in got)
    assert sorted(got) == sorted(tuple(r) for r in iv.merge(once).collect())


def test_subtract_and_intersect_make_up_x(two):
    a, b, x, y = two
    left = [tuple(r) for r in iv.subtract(x, y, bin_size=16).select(*x.columns).collect()]
    both = [tuple(r) for r in iv.intersect(x, iv.merge(y), bin_size=16).select(*x.columns).collect()]
    assert bases(left) == bases(a) - bases(b)
    assert bases(both) == bases(a) & bases(b)
    assert sum(e - s + 1 for _, s, e in left + both) == sum(e - s + 1 for _, s, e in a)


@pytest.mark.parametrize("tile", [4, 64, 1000])
def test_tiles_change_nothing(spark, tile):
    a = [("x", 1, 900), *rows(3, 60, 12), ("y", 290, 289)]
    b = rows(4, 90, 5)
    x, y = spark.createDataFrame(a, COLUMNS), spark.createDataFrame(b, COLUMNS)
    merged = [tuple(r) for r in iv.merge(y, tile=tile).collect()]
    assert bases(merged) == bases(b)
    assert all(("x", e + 1) not in bases(b) for c, _, e in merged if c == "x") and len(set(merged)) == len(merged)
    left = [tuple(r) for r in iv.subtract(x, y, bin_size=16, tile=tile).collect()]
    want = [(c, p) for c, s, e in a for p in range(s, e + 1) if (c, p) not in bases(b)]
    assert sorted((c, p) for c, s, e in left for p in range(s, e + 1)) == sorted(want)
    assert (("y", 290, 289) in left) == (not any(c == "y" and s <= 289 and e >= 290 for c, s, e in merged))


def test_null_contigs_stay_together(spark):
    x = spark.createDataFrame([(None, 1, 5), (None, 6, 9), ("x", 1, 2)], COLUMNS)
    assert sorted(map(str, iv.merge(x, tile=4).collect())) == sorted(map(str, spark.createDataFrame([(None, 1, 9), ("x", 1, 2)], COLUMNS).collect()))
    assert iv.subtract(x, x).count() == 2  # null keys meet nothing


def test_coverage_sums_to_total_width_across_tiles(two):
    a, _, x, _ = two
    runs = iv.coverage(x, tile=32).collect()
    assert sum((r.end_pos - r.start_pos + 1) * r.depth for r in runs) == sum(e - s + 1 for _, s, e in a)
    depth = {(r.seqnames, p): r.depth for r in runs for p in range(r.start_pos, r.end_pos + 1)}
    assert all(depth[c, p] == sum(c == d and s <= p <= e for d, s, e in a) for c, p in bases(a))


def test_zero_width_hits_only_strictly_inside(spark):
    q = spark.createDataFrame([("x", 10, 9), ("x", 5, 4), ("x", 16, 15)], COLUMNS)
    s = spark.createDataFrame([("x", 5, 15)], COLUMNS)
    got = {r.start_pos: r.hit for r in iv.overlaps_any(q, s, bin_size=4).collect()}
    assert got == {10: True, 5: False, 16: False}
    beside = {r.start_pos: r.hit for r in iv.overlaps_any(q, s, adjacent=True, bin_size=4).collect()}
    assert beside == {10: True, 5: True, 16: True}


def test_null_keys_meet_nothing_and_empty_tables_work(spark):
    q = spark.createDataFrame([(None, 1, 9), ("x", 1, 9)], COLUMNS)
    none = spark.createDataFrame([], COLUMNS)
    assert [r.hit for r in iv.overlaps_any(q, q).orderBy("seqnames").collect()] == [False, True]
    assert iv.merge(none).count() == 0 and iv.subtract(q, none).count() == 2 and iv.coverage(none).count() == 0
