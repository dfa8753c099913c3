"""Steps that must not grow faster than their input: what they give, and what their plans move."""

import pytest

from strandlake.functions import sequences as sq
from strandlake.operators import calls as cl
from strandlake.operators import evidence as ev
from strandlake.operators import genome as gn
from strandlake.operators import intervals as iv
from strandlake.operators import spectra as sp
from strandlake.operators import strands as st
from strandlake.plans import catalog
from strandlake.sources import text as tx

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


CALL = "run_id string, zm long, strand string, seqnames string, call_type string, start_pos long, end_pos long"


def test_sbs_flank_meets_a_molecule_once(spark):
    calls = [("r", 1, "+", "c", "SBS", 10, 10), ("r", 1, "-", "c", "SBS", 12, 12), ("r", 1, "+", "c", "insertion", 15, 14), ("r", 1, "+", "c", "insertion", 16, 15), ("r", 1, "+", "c", "deletion", 20, 22), ("r", 2, "+", "c", "SBS", 11, 11), (None, 3, "+", "c", "SBS", 5, 5), (None, 3, "+", "c", "SBS", 6, 6)]
    df = cl.sbs_flank(spark.createDataFrame(calls, CALL), 2)
    passed = {(r.zm, r.start_pos): r.flank_pass for r in df.collect()}
    assert passed == {(1, 10): False, (1, 12): False, (1, 15): False, (1, 16): True, (1, 20): True, (2, 11): True, (3, 5): True, (3, 6): True}
    assert plan(df).count("Exchange ") == 1


@pytest.mark.parametrize("name", ["f10_sbs_flank", "g26_germline_calls"])
def test_calls_are_dealt_to_tasks_of_one_size(spark, name):
    shown = plan(catalog.QUERIES[name](spark, SF))
    assert "REPARTITION_BY_NUM" in shown and "ENSURE_REQUIREMENTS" not in shown


def test_sam_ends_without_python(spark):
    line = lambda cigar, start=100: ("\t".join(["q/fwd", "0", "c", str(start), "60", cigar, "*", "0", "0", "AC", "!!", "ec:f:3"]),)
    df = tx.parse_sam(spark.createDataFrame([line("5S10=2I3D4X7S"), line("*"), line("4S6I"), line("10M5N10M2H")], "value string"))
    assert rows(df.na.fill(-1, ["end_pos"]), "cigar", "end_pos") == [("*", -1), ("10M5N10M2H", 124), ("4S6I", 99), ("5S10=2I3D4X7S", 116)]
    assert "EvalPython" not in plan(df)


READ = "run_id string, zm long, seqnames string, strand string, start_pos long, end_pos long"


def test_strands_of_a_molecule_meet_once(spark):
    k = ["run_id", "zm", "seqnames"]
    some = [("r", 1, "c", "+", 1, 100), ("r", 1, "c", "-", 50, 60), ("r", 1, "c", "-", 61, 70), ("r", 1, "c", "-", 65, 68), ("r", 1, "c", "-", 90, 120), ("r", 2, "c", "+", 1, 9), ("r", 3, "c", "-", 5, 9), (None, 4, "c", "+", 1, 9), (None, 4, "c", "-", 1, 9)]
    df = spark.createDataFrame(some, READ)
    both, one = iv.duplex(df, k), iv.non_duplex(df, k)
    assert rows(both, "zm", "strand", "start_pos", "end_pos") == [(1, "+", 50, 70), (1, "+", 90, 100), (1, "-", 50, 60), (1, "-", 61, 70), (1, "-", 65, 68), (1, "-", 90, 100)]
    assert rows(one, "zm", "strand", "start_pos", "end_pos") == [(1, "+", 1, 49), (1, "+", 71, 89), (1, "-", 101, 120), (2, "+", 1, 9), (3, "-", 5, 9), (4, "+", 1, 9), (4, "-", 1, 9)]
    assert plan(both).count("Exchange ") == 1 and plan(one).count("Exchange ") == 1


def test_zero_width_rows_of_one_strand_stay_unless_inside_the_other(spark):
    some = [("r", 1, "c", "+", 5, 4), ("r", 1, "c", "+", 8, 7), ("r", 1, "c", "-", 5, 9)]
    assert rows(iv.non_duplex(spark.createDataFrame(some, READ), ["run_id", "zm", "seqnames"]), "strand", "start_pos", "end_pos") == [("+", 5, 4), ("-", 5, 9)]


def test_waterfall_is_one_sweep(spark):
    at = lambda *x: spark.createDataFrame(list(x), "seqnames string, start_pos long, end_pos long")
    whole = at(("a", 1, 100), ("a", 91, 110), ("b", 1, 10), (None, 1, 5))
    masks = [("one", at(("a", 11, 20), ("a", 15, 30), ("a", 200, 300), (None, 1, 5), ("a", 3, 2))), ("two", at(("a", 21, 40), ("a", 95, 95), ("b", 10, 30))), ("none", at())]
    for tile in (1 << 20, 8):
        df = iv.waterfall(whole, masks, tile)
        assert [tuple(r) for r in df.orderBy("step").collect()] == [(0, "one", 20, 115), (1, "two", 23, 102), (2, "none", 0, 102)]
    assert plan(df).count("Exchange ") == plan(iv.waterfall(whole, masks[:1])).count("Exchange ")


def test_scores_at_least(spark):
    df = spark.createDataFrame([(1, [0.5, 0.9, None, float("nan"), 0.97]), (2, []), (3, None), (4, [1.0])], "k int, s array<double>").select("k", sq.at_least("s", 0.9).alias("h"))
    assert {r.k: r.h and [x.q for x in r.h] for r in df.collect()} == {1: [2, 4, 5], 2: [], 3: None, 4: [1]}


ALIGNED = "run_id string, zm long, strand string, seqnames string, bc_orientation string, start_pos long, end_pos long, cigar string, seq string, qual array<int>, sa array<int>, sm array<int>, sx array<int>, score array<double>"


def reads(spark):
    some = []
    for zm, start in ((1, 1), (2, 6)):
        for strand, cigar, seq in (("+", "2I3=1X2D4=", "GGACGAACGT"), ("-", "10=", "ACGTACGTAC")):
            n = list(range(len(seq)))
            some.append(("r", zm, strand, "c", "a-b", start, start + 9, cigar, seq, n, n, n, n, [0.98 if k % 3 == 0 else 0.1 for k in n]))
    return spark.createDataFrame(some, ALIGNED)


def test_modified_bases_alone_are_those_of_all_calls(spark):
    r = reads(spark)
    for opposite in ({}, {"mC": "G"}, {"mC": "C"}):
        every = st.extract_with_evidence(r, {"mC": ("score", 0.97)}, opposite).where("kind = 'MDB'")
        alone = st.extract_with_evidence(r, {"mC": ("score", 0.97)}, opposite, changes=False)
        assert rows(alone, *alone.columns[:9]) == rows(every, *every.columns[:9]) and alone.count() > 0
    moved = plan(alone.select("zm", "strand", "start_pos"))
    assert "score" not in "".join(x for x in moved.splitlines() if "Exchange" in x or "Sort " in x)
    assert moved.count("Exchange ") == 1


def test_alleles_come_to_the_reads(spark):
    r, tiles = reads(spark), gn.tiled(spark.createDataFrame([("c", "ACGTACGTACGTACGTACGT")], "seqnames string, seq string"))
    here = ev.vcf_alleles(st.calls_with_alleles(r, tiles))
    joined = ev.vcf_alleles(st.with_reference(st.extract_with_evidence(r), tiles), tiles)
    names = ["zm", "strand", "call_type", "start_pos", "end_pos", "pos", "ref", "alt"]
    assert rows(here, *names) == rows(joined, *names)
    assert (1, "+", "insertion", 1, 0, 0, "N", "NGG") in rows(here, *names) and (2, "+", "insertion", 6, 5, 5, "A", "AGG") in rows(here, *names)
    moved = plan(here)
    assert "Exchange" not in moved[: moved.index("Generate explode(") if "Generate explode(" in moved else moved.index("Generate ")]


def test_contexts_are_cut_in_one_join_without_a_sort(spark):
    tiles = gn.tiled(spark.createDataFrame([("c", "ACGTNCGTAC")], "seqnames string, seq string"), 4, 2)
    points = spark.createDataFrame([("c", 1, "x"), ("c", 10, "y"), ("c", 5, "z"), ("c", 5, "z"), ("d", 5, "w"), (None, 5, "v")], "seqnames string, start_pos long, tile string")
    df = gn.context(points, tiles, 1, 1, tile=4)
    assert sorted((r.tile, r.context) for r in df.collect()) == [("v", None), ("w", None), ("x", "NAC"), ("y", "ACN"), ("z", "TNC"), ("z", "TNC")]
    shown = plan(df)
    assert shown.count("Exchange ") == 2 and "Sort " not in shown


def test_error_probability_reads_burdens_once(spark):
    burden = spark.createDataFrame([("ACA>ATA", 2.0), ("TGT>TAT", 3.0), ("ACC>ATC", 5.0)], "channel string, burden double")
    shares = spark.createDataFrame([("ACA", 0.5), ("TGT", 0.25), ("ACC", 0.1), ("GGT", 0.15)], "tnc string, share double")
    assert rows(sp.error_probability(burden, shares), "channel", "error") == [("ACA>ATA", 4.5)]
