"""Tiles and trinucleotides: time in proportion to a contig's length, and counts against plain strings."""

import random
import time
from collections import Counter

from strandlake.operators import genome, pileup


def contig(n, seed=1):
    rng = random.Random(seed)
    return "".join(rng.choice("ACGT") for _ in range(n))


def test_tiles_of_a_long_contig_take_time_in_proportion(spark):
    took = {}
    genome.tiled(spark.createDataFrame([("w", contig(5000))], "seqnames string, seq string")).count()
    for n in (400_000, 800_000):
        df = spark.createDataFrame([("c", contig(n))], "seqnames string, seq string")
        best = 1e9
        for _ in range(2):
            began = time.perf_counter()
            assert genome.tiled(df).selectExpr("sum(length(seq)) AS n").first().n >= n
            best = min(best, time.perf_counter() - began)
        took[n] = best
    assert took[800_000] < 3 * max(took[400_000], 0.2)


def test_weighted_trinucleotides_at_edges_and_unknown_bases(spark):
    seq = contig(2503).replace("TAC", "TNC", 3)
    spans = [(1, 1, 2, "x"), (1, 1200, 1, "y"), (999, 1002, 3, "x"), (2000, 2503, 1, "x"), (2503, 2503, 7, "y"), (1500, 1499, 9, "y")]
    want = Counter()
    for s, e, depth, k in spans:
        for p in range(s, e + 1):
            t = seq[p - 2 : p + 1] if p > 1 else ""
            if len(t) == 3 and "N" not in t:
                want[(k, t)] += depth
    runs = spark.createDataFrame([("c", *x) for x in spans if x[0] <= x[1]], "seqnames string, start_pos long, end_pos long, depth long, k string")
    tiles = genome.tiled(spark.createDataFrame([("c", seq), ("d", "AC"), ("e", "")], "seqnames string, seq string"))
    got = genome.weighted_trinucleotides(runs, tiles, ["k"])
    assert Counter({(r.k, r.tnc): r.n for r in got.collect()}) == want
    whole = Counter(seq[k : k + 3] for k in range(len(seq) - 2) if "N" not in seq[k : k + 3])
    got = genome.trinucleotide_counts(spark.createDataFrame([("c", seq), ("d", "ac")], "seqnames string, seq string"))
    assert Counter({r.tnc: r.n for r in got.collect()}) == whole
    assert genome.weighted_trinucleotides(runs.limit(0), tiles).count() == 0


def test_base_coverage_is_derived_once_and_right_at_a_contigs_ends(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    schema = "seqnames string, start_pos long, end_pos long, depth long"
    runs = spark.createDataFrame([("c", 1, 3, 2), ("c", 6, 9, 1)], schema).mapInArrow(count, schema)
    tiles = genome.tiled(spark.createDataFrame([("c", "ACGTNACGT")], "seqnames string, seq string"), 4, 2)
    pileup.base_coverage(runs, tiles, 4).createOrReplaceTempView("each")
    assert [tuple(r) for r in spark.sql("select pos, depth, reftnc from each order by pos").collect()] == [(1, 2, None), (2, 2, "ACG"), (3, 2, "CGT"), (6, 1, None), (7, 1, "ACG"), (8, 1, "CGT"), (9, 1, None)]
    seen.value = 0
    pileup.write_base_coverage(runs, genome.tiled(spark.createDataFrame([("c", "ACGTNACGT")], "seqnames string, seq string")), str(tmp_path / "out"))
    assert seen.value == 2 and pileup.read_base_coverage(spark, str(tmp_path / "out")).count() == 7
