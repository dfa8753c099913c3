"""Hand-computed values."""

import pytest

from strandlake.functions import sequences as sq
from strandlake.operators import spectra as sp

# Exact Poisson 95 % intervals.
KNOWN = {0: (0, 3.688879), 1: (0.025318, 5.571643), 2.5: (0.415606, 8.006382), 5: (1.623486, 11.668332), 10: (4.795389, 18.390356), 100: (81.363991, 121.626794)}


def test_poisson_intervals(spark):
    got = {r.k: (r.k_lci, r.k_uci) for r in sp.poisson_ci(spark.createDataFrame([(float(k),) for k in KNOWN], "k double"), "k").collect()}
    for k, (low, high) in KNOWN.items():
        assert got[k] == pytest.approx((low, high), abs=1e-6)


def test_one_base_deletions(spark):
    rows = [("GGGGGGGGGA" + "C" + "CCCTTTTTTT",), ("AAAAAAAACC" + "C" + "CTTTTTTTTT",), ("TTTTTTTTTT" + "A" + "CCCCCCCCCC",)]
    got = [r.channel for r in sp.deletion_1bp(spark.createDataFrame(rows, "context string")).collect()]
    assert got == ["1:Del:C:3", "1:Del:C:2", "1:Del:T:0"]


def test_repeats_and_microhomology(spark):
    df = spark.createDataFrame([("AC", "GGGG", "ACACACTT"), ("ACG", "GGCG", "ATTT"), ("ACG", "TTTT", "GGGG")], "u string, b string, a string")
    c = {n: df[n] for n in "uba"}
    got = df.select(sp.repeat_class(c["u"], c["a"]).alias("r"), sp.microhomology(c["u"], c["b"], c["a"]).alias("m")).collect()
    assert [(x.r, x.m) for x in got][0][0] == 3 and got[1].m == 2 and (got[2].r, got[2].m) == (0, 0)


def test_sequence_functions(spark):
    r = spark.createDataFrame([("ACGTN", [2, 7, 0, 5, 1, 3])], "s string, a array<int>").select(sq.reverse_complement("s").alias("rc"), sq.rle_decode("a").alias("d"), sq.pyrimidine("s").alias("p")).first()
    assert r.rc == "NACGT" and r.d == [7, 7, 3]
