"""Calls from both strands' reads: places through CIGAR, values across, classes; hand-made reads."""

from strandlake.operators import genome, strands

GENOME = "ACGTTGCAACGGATTCCAGT"


def reads(spark, *rows):
    """(zm, strand, start, cigar, seq) as reads whose qualities are 1, 2, 3, ... from the left, plus 100 on the - strand."""
    full = []
    for zm, strand, start, cigar, seq in rows:
        q = [k + 1 + (100 if strand == "-" else 0) for k in range(len(seq))]
        full.append(("r", zm, strand, "c", start, start, cigar, seq, q, q, q, q, "a-b"))
    return spark.createDataFrame(full, "run_id string, zm long, strand string, seqnames string, start_pos long, end_pos long, cigar string, seq string, qual array<int>, sa array<int>, sm array<int>, sx array<int>, bc_orientation string")


def chain(spark, *rows, **more):
    tiles = genome.tiled(spark.createDataFrame([("c", GENOME)], "seqnames string, seq string"), 7, 2)
    found = strands.classify(strands.opposite_calls(strands.with_reference(strands.extract_with_evidence(reads(spark, *rows), **more), tiles, 7)))
    return {(r.zm, r.strand, r.call_type, r.start_pos): r for r in strands.partners_evidence(found).collect()}


def test_a_change_on_both_strands_takes_the_partners_values(spark):
    got = chain(spark, (1, "+", 3, "2=1X3=", "GTAGCA"), (1, "-", 2, "3=1X4=", "CGTAGCAA"))
    a, b = got[(1, "+", "SBS", 5)], got[(1, "-", "SBS", 5)]
    assert (a.ref_plus_strand, a.alt_plus_strand, a.call_class) == ("T", "A", "mutation") and b.call_class == "mutation"
    assert a.qual == [3] and a.qual_opposite == [104] and b.qual_opposite == [3]


def test_values_across_from_indels_and_changes(spark):
    got = chain(
        spark,
        (1, "+", 3, "2=2X2=", "GTAACA"), (1, "-", 3, "2=3D2=", "GTAA"),  # changes across from a deletion
        (2, "+", 3, "3=2I3=", "GTTGGGCA"), (2, "-", 3, "6=", "GTTGCA"),  # an insertion across from none
        (3, "+", 3, "2=2D2=", "GTCA"), (3, "-", 3, "1=3D2=", "GCA"),  # deletions that overlap
        (4, "+", 3, "3=1X3=", "GTTACAA"), (4, "-", 3, "3=", "GTT"),  # the other read ends before
        (5, "+", 3, "3=1X3=", "GTTACAA"),  # no other read
    )
    x = got[(1, "+", "SBS", 5)]
    assert x.call_class == "mismatch-ds" and x.opp_type == "deletion" and x.qual_opposite is None
    d = got[(1, "-", "deletion", 5)]
    assert d.ref_plus_strand == "TGC" and d.alt_plus_strand == "" and d.qual == [102, 103] and d.qual_opposite == [3, 4, 5] and d.call_class == "mismatch-ds"
    i = got[(2, "+", "insertion", 6)]
    assert (i.ref_plus_strand, i.alt_plus_strand, i.w, i.end_pos) == ("", "GG", 2, 5) and i.qual == [4, 5] and i.qual_opposite == [103, 104] and i.call_class == "mismatch-ss"
    p, m = got[(3, "+", "deletion", 5)], got[(3, "-", "deletion", 4)]
    assert p.deletion_match is False and m.deletion_match is False and p.call_class == m.call_class == "mismatch-ds"
    assert p.qual_opposite == [101, 102]  # nothing of the other read lies there: both of its neighbours
    assert m.qual_opposite == [2]
    assert got[(4, "+", "SBS", 6)].qual_opposite is None and got[(5, "+", "SBS", 6)].qual_opposite is None


def test_modified_bases_and_the_base_across(spark):
    rows = (1, "+", 3, "1S4=1I2=", "AGTTGACA"), (1, "-", 3, "2=1X3=", "GTAGCA")
    score = {"m": ("qual", 4)}
    got = {k: r for k, r in chain(spark, *rows, modified=score).items() if r.kind == "MDB" and r.strand == "+"}
    assert sorted(k[3] for k in got) == [5, 6, 7, 8]  # not the inserted base
    assert got[(1, "+", "m", 5)].call_class == "mismatch-os" and got[(1, "+", "m", 6)].call_class == "match"
    some = chain(spark, *rows, modified=score, opposite_bases={"m": "C"})
    assert sorted(k[3] for k, r in some.items() if r.kind == "MDB" and r.strand == "+") == [6]


def test_reference_bases_of_any_length(spark):
    got = chain(spark, (1, "+", 2, "1=16D1=", "CG"))
    assert got[(1, "+", "deletion", 3)].ref_plus_strand == GENOME[2:18]


def test_maps_of_positions_keep_each_point_once_and_send_no_table_to_every_task(spark):
    from strandlake.operators import calls

    r = reads(spark, (1, "+", 3, "2=2D2=", "GTCA"))
    places = spark.createDataFrame([("r", 1, "+", 4), ("r", 1, "+", 4), ("r", 1, "+", 5), ("r", 2, "+", 4)], "run_id string, zm long, strand string, pos long")
    found = calls.map_to_query(places, r)
    assert sorted((x.zm, x.pos, x.query) for x in found.collect() if x.query) == [(1, 4, 2), (1, 4, 2)] and found.count() == 4
    back = strands.map_to_reference(found.drop("pos"), r)
    for df in (found, back):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_aligned_reads_meet_each_other_before_their_contig(spark):
    from strandlake.plans import fixtures

    plan = fixtures._alignments.__wrapped__(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 1 and "seqnames" in joins[0] and "zm" not in joins[0]


def test_calls_of_a_read_are_found_once_and_stay_with_their_molecule(spark):
    tiles = genome.tiled(spark.createDataFrame([("c", GENOME)], "seqnames string, seq string"))
    rows = (1, "+", 3, "2=1X3=", "GTAGCA"), (1, "-", 2, "3=1X4=", "CGTAGCAA"), (2, "+", 3, "2=3D2=", "GTAA")
    out = strands.all_calls(reads(spark, *rows), tiles)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("insertion") and sum("Generate" in line and "flatten" in line for line in plan.splitlines()) == 1
    got = {(r.zm, r.strand, r.call_type, r.start_pos): r for r in out.collect()}
    assert {k: v.asDict() for k, v in chain(spark, *rows).items()} == {k: v.asDict() for k, v in got.items()} and len(got) == 3


def test_ranges_of_odd_strings(spark):
    from strandlake.functions.sequences import cigar_ranges

    rows = spark.createDataFrame([(1, "3S10=2X", 5), (2, "", 6), (3, None, 7), (4, "M5Q7D", 8)], "k long, cigar string, s long")
    got = {r.k: r.o and [tuple(x) for x in r.o] for r in rows.select("k", cigar_ranges("cigar", "s").alias("o")).collect()}
    assert got == {1: [("S", 3, 1, 3, 5, 4), ("=", 10, 4, 13, 5, 14), ("X", 2, 14, 15, 15, 16)], 2: [], 3: None, 4: [("D", 7, 1, 0, 8, 14)]}


def test_reads_of_a_pileup_move_once_by_place_and_count_as_before(spark):
    from pyspark.sql import functions as F

    from strandlake.operators import pileup

    rows = reads(spark, *[(k, "+", 3, "2=1X3=", "GTAGCA") for k in range(50)], (90, "-", 2, "3=2D2=", "CGTCA")).withColumn("flag", F.lit(0))
    counts = pileup.allele_counts(rows, 2)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert any("RepartitionByExpression" in line and "seqnames" in line and "start_pos" in line for line in plan.splitlines())
    got = {r.pos: (r.n_a, r.n_c, r.n_g, r.n_t) for r in counts.collect()}
    assert got == {2: (0, 1, 0, 0), 3: (0, 0, 1, 0), 4: (0, 0, 0, 51), 5: (50, 0, 0, 0), 6: (0, 0, 50, 0), 7: (0, 51, 0, 0), 8: (51, 0, 0, 0)}


def test_call_places_need_no_values(spark):
    some = reads(spark, (1, "+", 3, "2S2=2X1I2=3D1=", "AAGTAACGAC"), (1, "-", 2, "3=1X4=", "CGTAGCAA"), (2, "+", 5, "4=", "TGCA"))
    names = ["zm", "strand", "kind", "call_type", "start_pos", "end_pos", "w"]
    assert sorted(strands.call_sites(some).select(*names).collect()) == sorted(strands.extract_with_evidence(some).select(*names).collect())
