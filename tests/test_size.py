"""Steps that took too long or too much disk on large tables: what they give at edges, and what they no longer make rows of."""

import pytest
from pyspark.sql import functions as F

from strandlake.operators import calls as calls_module
from strandlake.operators import evidence, genome, pileup, strands, tracker


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]


READ = "run_id string, zm long, strand string, seqnames string, start_pos long, cigar string, seq string, qual array<int>, flag int"


@pytest.mark.parametrize("held", [2048, 1])
def test_bases_of_a_pileup_are_counted_across_tiles_and_are_rows_nowhere(spark, monkeypatch, held):
    monkeypatch.setattr(pileup, "_HELD", held)
    rows = [
        ("r", 1, "+", "c", 998, "1S3=2D1X2=", "TACGTAC", [9] * 7, 0),  # over a tile's edge
        ("r", 2, "+", "c", 1000, "2M3000N1M", "GTA", [9, 9, 9], 0),
        ("r", 3, "+", "c", 1000, "2M", "GN", [9, 9], 0),
        ("r", 4, "+", "d", 1000, "1M2I2M", "GTTCA", [9, 9, 9, None, 2], 0),
        ("r", 5, "+", "c", 1000, "3M", "GT", [9], 0),  # neither bases nor qualities for all places
        ("r", 6, "+", "c", 1000, "1M", None, [9], 0), ("r", 7, "+", "c", 1000, "1M", "G", None, 0), ("r", 8, "+", "c", 1000, None, "G", [9], 0), ("r", 9, "+", "c", 1000, "1M", "G", [9], 1024),
        ("r", 10, "+", None, 5, "1M", "A", [9], 0),
    ]
    counts = pileup.allele_counts(spark.createDataFrame(rows, READ), 3)
    want = {("c", 998): (1, 0, 0, 0), ("c", 999): (0, 1, 0, 0), ("c", 1000): (0, 0, 4, 0), ("c", 1001): (0, 0, 0, 1), ("c", 1003): (0, 0, 0, 1), ("c", 1004): (1, 0, 0, 0), ("c", 1005): (0, 1, 0, 0), ("c", 4002): (1, 0, 0, 0), ("d", 1000): (0, 0, 1, 0), (None, 5): (1, 0, 0, 0)}
    assert {(r.seqnames, r.pos): (r.n_a, r.n_c, r.n_g, r.n_t) for r in counts.collect()} == want
    assert "sequence(" not in plan(counts)


def test_call_places_with_alleles_need_no_other_read(spark):
    rows = [("r", 1, "+", "c", 3, "2S2=2X1I2=3D1=", "AAGTAACGAC", [9] * 10, 0), ("r", 2, "-", "c", 5, "4=", "TGCA", [9] * 4, 0)]
    reads = spark.createDataFrame(rows, READ).withColumns({n: F.col("qual") for n in ("sa", "sm", "sx")} | {"bc_orientation": F.lit("a-b")})
    names = ["zm", "call_type", "start_pos", "end_pos", "w", "alt_plus_strand"]
    some = strands.call_sites(reads, alleles=True).select(*names)
    assert sorted(some.collect()) == sorted(strands.extract_with_evidence(reads).select(*names).collect()) and some.count() == 4
    assert "Window" not in plan(some)


CALL = "run_id string, zm long, strand string, seqnames string, call_type string, start_pos long, end_pos long"


def test_calls_are_told_beside_the_masks_of_their_molecule(spark):
    calls = [("r", 1, "+", "c", "insertion", 10, 9), ("r", 1, "+", "c", "insertion", 12, 11), ("r", 1, "-", "c", "deletion", 20, 22), ("r", 1, "-", "c", "deletion", 20, 22), ("r", 2, "+", "c", "SBS", 9, 9), (None, 3, "+", "c", "SBS", 5, 5), ("r", 4, "+", "d", "insertion", 31, 30)]
    span = "run_id string, zm long, seqnames string, start_pos long, end_pos long"
    masks = [
        ("low", spark.createDataFrame([("r", 1, "c", [9, 10, 11]), ("r", 2, "c", [8, 10]), ("r", 5, "c", [])], "run_id string, zm long, seqnames string, places array<long>")),
        ("wide", spark.createDataFrame([("r", 1, "c", 11, 12), ("r", 1, "c", 22, 21), ("r", 1, "c", 23, 22), (None, 3, "c", 1, 9), ("r", 1, "c", None, 30)], span)),
        ("beside", spark.createDataFrame([("r", 1, "c", 12, 15), ("r", 1, "c", 23, 30)], span)),
        ("all", spark.createDataFrame([("c", 20, 20), ("c", 5, 5), ("d", 31, 40)], "seqnames string, start_pos long, end_pos long")),
    ]
    out = tracker.failed_filters(spark.createDataFrame(calls, CALL), masks, ["beside"], {"all": "zm = 3"}, ["all"])
    # an insertion between two single places is in neither; a deletion holds the place of an interval without width
    assert sorted((r.zm, r.start_pos, r.bits) for r in out.collect()) == [(1, 10, 0), (1, 12, 2 + 4), (1, 20, 2 + 8), (1, 20, 2 + 8), (2, 9, 0), (3, 5, 0), (4, 31, 8)]
    assert not any("Join" in line and "zm" in line for line in plan(out).splitlines())


@pytest.mark.parametrize("rows", [3, 10_000])
def test_summed_pieces_are_those_of_the_sweep(spark, rows):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    try:
        reads = spark.createDataFrame([("r", 1, "+", "c", 5, 60), ("r", 1, "-", "c", 8, 61), ("r", 2, "+", "c", 30, 30), ("r", None, "+", "c", 1, 3), ("r", None, "-", "c", 1, 3)], "run_id string, zm long, strand string, seqnames string, start_pos long, end_pos long")
        masks = [("a", spark.createDataFrame([("r", 1, "c", [7, 9, 10, 61]), ("r", 2, "c", [30])], "run_id string, zm long, seqnames string, places array<long>")), ("b", spark.createDataFrame([("c", 2, 9), ("c", 40, 45)], "seqnames string, start_pos long, end_pos long"))]
        each = tracker.sweep(reads, masks).select("zm", "strand", "bits", F.explode(F.sequence("start_pos", "end_pos")).alias("p")).groupBy("zm", "strand", "bits").agg(F.count("p").alias("bases"), F.sum("p").alias("places"))
        got, want = (sorted(map(str, x.collect())) for x in (tracker.sweep(reads, masks, summed=True).select("zm", "strand", "bits", "bases", "places"), each))
        assert got == want and len(got) == 13
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_own_masks_are_those_told_one_by_one(spark):
    rows = [("r", 1, "+", "c", 3, "2S2=2X1I2=3D1=", "AAGTAACGAC", [9, 9, 1, None, 9, 9, 2, 9, 9, 1], 0), ("r", 2, "-", "d", 5, "4=", "TGCA", [1, 9], 0), ("r", 3, "+", "c", 1, "1I3=", "TGCA", None, 0), ("r", 4, "+", "c", 1, None, None, [9], 0)]
    reads = spark.createDataFrame(rows, READ).withColumns({"sa": F.col("qual"), "sm": F.transform("qual", lambda x, i: x % (i + 2)), "sx": F.col("qual"), "end_pos": F.col("start_pos") + 9})
    calls = strands.call_sites(reads)
    each = [("q", tracker.quality_mask(reads, 3)), ("t", tracker.trim_mask(reads, 4)), ("f", tracker.flank_mask(calls, 2)), ("i", tracker.indel_mask(calls, "m2b1", "m1b3")), ("s", tracker.subread_mask(reads, 0.2, 1, 0.3))]
    names = [n for n, _ in each]
    own = tracker.own_masks(reads, names, {"subreads": ("s", 0.2, 1, 0.3), "quality": ("q", 3), "trim": ("t", 4), "flank": ("f", 2), "indels": ("i", "m2b1", "m1b3")})
    got = []
    for r in own.collect():
        got += [(r.zm, r.own_spans[k].bit_length() - 1, r.own_spans[k + 1], r.own_spans[k + 2]) for k in range(0, len(r.own_spans), 3)] + [(r.zm, p % 64, p // 64, p // 64) for p in r.own_places]
    want = [(r.zm, k, r.start_pos, r.end_pos) for k, (_, m) in enumerate(each) for r in tracker._intervals(m).select("zm", "start_pos", "end_pos").collect()]
    assert sorted(got) == sorted(want) and len(got) > 30
    span = reads.select("run_id", "zm", "strand", "seqnames", "start_pos", "end_pos")
    a, b = (sorted(map(tuple, x.collect())) for x in (tracker.sweep(span, each, summed=True), tracker.sweep(span, [(n, None) for n in names], summed=True, own=own)))
    assert a == b


def test_coverage_rows_come_from_tasks_that_numpy_fills(spark, monkeypatch):
    monkeypatch.setattr(pileup, "_ROWS", 3)
    seq = "ACGTNACGTAC"
    tiles = genome.tiled(spark.createDataFrame([("c", seq), ("d", "AC")], "seqnames string, seq string"), 4, 2)
    runs = [("c", 1, 2, 5), ("c", 3, 3, 1), ("c", 6, 11, 2), ("d", 1, 3, 7)]  # the last ends beyond its contig
    df = pileup.base_coverage(spark.createDataFrame(runs, "seqnames string, start_pos long, end_pos long, depth long"), tiles, 4, tasks=5)
    known = {"c": seq, "d": "AC"}
    tnc = lambda c, p: t if len(t := known[c][max(p - 2, 0) : p + 1]) == 3 and p > 1 and "N" not in t else None
    want = sorted((c, p, n, str(tnc(c, p))) for c, s, e, n in runs for p in range(s, min(e, (len(known[c]) + 3) // 4 * 4) + 1))
    assert sorted((r.seqnames, r.pos, r.depth, str(r.reftnc)) for r in df.collect()) == want
    shown = plan(df)
    assert "sequence(low" not in shown and shown.count("REPARTITION_BY_NUM") == 2


def test_low_quality_of_a_read_is_one_row(spark):
    reads = spark.createDataFrame([("r", 1, "c", 5, [9, 1, None, 1, 9]), ("r", 1, "c", 6, [9, 9, 9, 9, 1]), ("r", 2, "c", 5, None), ("r", 3, "d", 1, [])], "run_id string, zm long, seqnames string, start_pos long, qual array<int>")
    low = evidence.low_places(reads, "qual", 4)
    assert sorted((r.zm, r.places) for r in low.collect()) == [(1, [6, 8]), (1, [10]), (2, []), (3, [])]
    calls = [("r", 1, "+", "c", "SBS", k, k) for k in range(5, 12)] + [("r", 1, "-", "c", "deletion", 9, 10), ("r", 2, "+", "c", "SBS", 6, 6), (None, 1, "+", "c", "SBS", 6, 6)]
    df = spark.createDataFrame(calls, CALL)
    each = calls_module.positions_below(reads, "qual", 4)
    a, b = (sorted(map(str, evidence.low_quality_filter(df, x).select(*df.columns, "qual_pass").collect())) for x in (low, each))
    assert a == b and sum("qual_pass=False" in x for x in a) == 4


def test_contexts_of_calls_come_with_the_reads(spark):
    genome_seq = "ACGTTGCAACGGNTTCCAGT"
    tiles = genome.tiled(spark.createDataFrame([("c", genome_seq)], "seqnames string, seq string"))
    rows = [("r", 1, "+", "c", 1, "1X2=1X2=1I3=", "TCGATGACAA", [9] * 10, 0), ("r", 1, "-", "c", 1, "1X2=1X4=", "TCGATGCA", [9] * 8, 0), ("r", 2, "+", "c", 9, "3=1X1=1X2D1=1X3=", "ACGANACCAGT"[:11], [9] * 11, 0), ("r", 3, "+", "c", 18, "2=1X", "AGA", [9] * 3, 0)]
    reads = spark.createDataFrame(rows, READ).withColumns({n: F.col("qual") for n in ("sa", "sm", "sx")} | {"bc_orientation": F.lit("a-b"), "end_pos": F.col("start_pos")})
    names = ["zm", "strand", "call_type", "start_pos", "end_pos", "call_class", "ref_plus_strand", "reftnc", "reftnc_pyr"]
    here = strands.all_calls(reads, tiles, contexts=True).where("kind <> 'indel'").select(*names)
    joined = genome.trinucleotides(strands.all_calls(reads, tiles), tiles).where("kind <> 'indel'").select(*names)
    a, b = (sorted(map(str, x.collect())) for x in (here, joined))
    assert a == b and any("reftnc=None" in x for x in a) and any("reftnc='GTT'" in x for x in a)
    assert plan(here).count("Join") < plan(joined).count("Join")
