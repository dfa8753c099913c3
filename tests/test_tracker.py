"""The tracker's sweep against base by base, and masks with one array for each read."""

from pyspark.sql import functions as F

from strandlake.operators import tracker as tr
from strandlake.plans import fixtures as fx

SPAN = "seqnames string, start_pos long, end_pos long"


def test_failing_bases_are_one_row_for_each_read(spark):
    rows = [("r", 1, "c", 10, "2S3=1I2=2D2=", [9, 9, 1, 1, 5, 1, 1, 5, None, 5]), ("r", 2, "c", 3, "3=", [1, 5]), ("r", 3, "c", 3, "2=", [5, 5]), ("r", 4, "c", 3, "1=", None)]
    reads = spark.createDataFrame(rows, "run_id string, zm long, seqnames string, start_pos long, cigar string, qual array<int>")
    got = {r.zm: [tuple(x) for x in r.spans] for r in tr.quality_mask(reads, 3).collect()}
    assert got == {1: [(10, 10), (11, 11), (13, 13), (17, 17)], 2: [(3, 3), (5, 5)], 3: [], 4: [(3, 3)]}


def test_subread_limits_take_nulls_and_missing_places_for_failures(spark):
    rows = [("r", 1, "c", 1, "6=", [10, 1, 10, 10, None, 10], [5, 5, 0, 1, 5, 5], [0, 0, 5, 3, 0])]
    reads = spark.createDataFrame(rows, "run_id string, zm long, seqnames string, start_pos long, cigar string, sa array<int>, sm array<int>, sx array<int>")
    assert [tuple(x) for x in tr.subread_mask(reads, 0.2, 1, 0.3).first().spans] == [(k, k) for k in range(2, 7)]


def test_sweep_is_the_set_of_masks_over_each_base(spark):
    reads = [("r", 1, "+", "c", 5, 60), ("r", 1, "-", "c", 8, 61), ("r", 2, "+", "c", 30, 30), ("r", 3, "+", "d", 5, 20), ("r", 4, "+", "c", 9, 8)]
    everywhere = [("c", 1, 6), ("c", 15, 17), ("c", 18, 40), ("c", 59, 90), ("e", 1, 9), ("c", 35, 34)]
    own = [("r", 1, "c", 7, 9), ("r", 1, "c", 9, 12), ("r", 1, "c", 33, 32), ("r", 2, "d", 1, 99), ("r", 3, "d", 20, 25)]
    spans = [("r", 1, "c", [(10, 11), (31, 50)]), ("r", 3, "d", [])]
    masks = [
        ("a", spark.createDataFrame(everywhere, SPAN)),
        ("b", spark.createDataFrame(own, "run_id string, zm long, " + SPAN)),
        ("s", spark.createDataFrame(spans, "run_id string, zm long, seqnames string, spans array<struct<start_pos:long,end_pos:long>>")),
    ]
    table = spark.createDataFrame(reads, "run_id string, zm long, strand string, " + SPAN)
    for tile, size in ((1 << 20, 512), (16, 8)):
        pieces = tr.sweep(table, masks, tile, size).collect()
        got = sorted((p.zm, p.strand, p.seqnames, x, p.bits) for p in pieces for x in range(p.start_pos, p.end_pos + 1))
        want = []
        for _, zm, strand, ctg, s, e in reads:
            for x in range(s, e + 1):
                a = any(c == ctg and lo <= x <= hi for c, lo, hi in everywhere)
                b = any((z, c) == (zm, ctg) and lo <= x <= hi for _, z, c, lo, hi in own)
                c3 = any((z, c) == (zm, ctg) and lo <= x <= hi for _, z, c, l in spans for lo, hi in l)
                want.append((zm, strand, ctg, x, a + 2 * b + 4 * c3))
        assert got == sorted(want)


def test_joins_of_fixtures_take_more_tasks_as_tables_grow(spark, monkeypatch):
    monkeypatch.setattr(fx, "PART", 10)
    a, b = spark.range(95).withColumnRenamed("id", "k"), spark.range(5).withColumnRenamed("id", "k")
    left, right = fx._dealt(a, a, b, "k")
    assert left.rdd.getNumPartitions() == right.rdd.getNumPartitions() == 10
    assert left.join(right, "k").agg(F.count(F.lit(1))).first()[0] == 5
