"""VCF files, run metadata, sensitivity variants, error probabilities, genome filters: edge cases by hand."""

import glob

import pytest
from pyspark.sql import functions as F

from strandlake.operators import calls as cl
from strandlake.operators import evidence as ev
from strandlake.operators import genome as gn
from strandlake.operators import spectra as sp
from strandlake.operators import tracker as tr
from strandlake.sources import text as tx

CALLS = "seqnames string, pos long, ref string, alt string, n int, share double, forward boolean, note string"


def test_vcf_parts_one_after_the_other_are_one_sorted_file(spark, tmp_path):
    rows = [("b", 5, "A", "C", 1, 0.5, True, "x y;z"), ("a", 9, "AT", "A", None, None, None, None), ("a", 9, "A", "G", 2, None, False, "100%"), ("gone", 1, "A", "C", 1, None, None, None), ("b", 5, "A", "C", 1, 0.5, True, "x y;z")]
    lengths = spark.createDataFrame([(1, "a", 50), (0, "b", 40)], "contig_idx long, seqnames string, len long")
    tx.vcf_document(spark.createDataFrame(rows, CALLS).repartition(4), lengths, ["n", "share", "forward", "note"], "made").write.text(str(tmp_path / "out"))
    lines = [line.rstrip("\n") for part in sorted(glob.glob(f"{tmp_path}/out/part-*")) for line in open(part)]
    assert lines[0] == "##fileformat=VCFv4.3"
    assert [x for x in lines if x.startswith("##INFO")] == [f'##INFO=<ID={n},Number={k},Type={t},Description="{n}">' for n, k, t in (("n", 1, "Integer"), ("share", 1, "Float"), ("forward", 0, "Flag"), ("note", 1, "String"))]
    assert [x for x in lines if x.startswith("##contig")] == ["##contig=<ID=b,length=40>", "##contig=<ID=a,length=50>"]
    head = lines.index("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")
    b = "b\t5\t.\tA\tC\t.\tPASS\tn=1;share=0.5;forward;note=x%20y%3Bz"
    assert lines[head + 1 :] == [b, b, "a\t9\t.\tA\tG\t.\tPASS\tn=2;note=100%25", "a\t9\t.\tAT\tA\t.\tPASS\t."]


def test_vcf_of_no_calls_is_a_header(spark):
    lengths = spark.createDataFrame([], "contig_idx long, seqnames string, len long")
    lines = [r.value for r in tx.vcf_document(spark.createDataFrame([], CALLS), lengths, [], "made").collect()]
    assert lines == ["##fileformat=VCFv4.3", "##source=strandlake", "##reference=made", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]


def test_movies_meet_whole_parts_of_file_names(spark):
    groups = spark.createDataFrame([("g1", "m1"), ("g2", "m10"), ("g3", "m2"), ("g4", None)], "id string, movie string")
    runs = spark.createDataFrame([("r1", "/d/m10.reads.bam"), ("r2", "m1/m1.bam"), ("r3", None)], "run_id string, reads_file string")
    assert {(r.id, r.run_id) for r in tx.run_metadata(groups, runs).collect()} == {("g1", "r2"), ("g2", "r1"), ("g3", None), ("g4", None)}


VARIANTS = "germline_file string, seqnames string, start_pos long, end_pos long, ref string, alt string, call_class string, call_type string, depth int, gq double, qual double, vaf double, gt string"
LIMITS = {"SBS": {"depth": 0.5, "gq": 0, "qual": 0, "min_vaf": 0.2, "max_vaf": 0.8}}


def _variant(file, pos, depth=10, vaf=0.5, gt="0/1", kind="SBS", qual=5.0):
    return (file, "a", pos, pos, "A", "C", kind, kind, depth, 9.0, qual, vaf, gt)


@pytest.mark.parametrize("genotype, want", [("heterozygous", [1]), ("homozygous", [3])])
def test_sensitivity_variants(spark, genotype, want):
    rows = [_variant(f, p, **more) for f in "xy" for p, more in ((1, {"gt": "1|0"}), (2, {"depth": 3}), (3, {"gt": "1/1"}), (4, {"vaf": 0.9}), (5, {"vaf": None}), (6, {"kind": "indel"}), (8, {"gt": "0/2"}), (9, {"qual": None}), (10, {"gt": None}), (11, {"depth": None}))]
    rows += [_variant("x", 7), _variant("x", 7)]  # twice in one file is not in both
    v = spark.createDataFrame(rows, VARIANTS)
    contigs = spark.createDataFrame([("a",), ("a",)], "seqnames string")
    got = sp.sensitivity_variants(v, LIMITS, genotype, 2, contigs, v).collect()
    assert sorted(r.start_pos for r in got) == want
    assert sp.sensitivity_variants(v, LIMITS, genotype, 2, contigs, v.limit(0)).count() == 0
    assert sp.sensitivity_variants(v.limit(0), LIMITS, genotype, 2, contigs, v).count() == 0


def test_error_probabilities_by_hand(spark):
    counts = spark.createDataFrame([("ACA>AAA", 2), ("TGT>TTT", 3), ("ACA>ATA", 5)], "channel string, n long")
    bases = spark.createDataFrame([("ACA", 100), ("TGT", 300), ("AAA", 0)], "tnc string, n long")
    genome = spark.createDataFrame([("ACA", 1), ("CCC", 3)], "tnc string, n long")
    got = {(r.target, r.channel): r.error for r in sp.error_probabilities(counts, bases, {"seen": bases, "genome": genome}).collect()}
    assert len(got) == 2 * 97
    assert got["seen", "ACA>AAA"] == pytest.approx(0.02 * 0.01)
    assert got["genome", "ACA>AAA"] == got["genome", "total"] == pytest.approx(0.02 * 0.01 / 4)
    assert got["seen", "ACA>ATA"] == 0  # the other strand shows none


def test_intervals_of_repeated_counts_and_nulls(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (5.0,), (None,), (2.5,)], "n double")
    got = {r.n: (r.n_lci, r.n_uci) for r in sp.poisson_ci(df, "n").collect()}
    assert got[0.0] == (0.0, pytest.approx(3.688879, abs=1e-5)) and got[5.0] == (pytest.approx(1.623486, abs=1e-5), pytest.approx(11.668332, abs=1e-5))
    assert all(v is None or v != v for v in got[None])


def test_insertions_fail_by_either_base_beside_them(spark):
    calls = spark.createDataFrame([("r", 1, "a", p, p - 1) for p in (10, 11, 21, 22)], "run_id string, zm long, seqnames string, start_pos long, end_pos long")
    mask = spark.createDataFrame([("a", 11, 20)], "seqnames string, start_pos long, end_pos long")
    bits = lambda **k: {r.start_pos: r.bits for r in tr.failed_filters(calls, [("depth", mask)], **k).collect()}
    assert bits() == {10: 0, 11: 0, 21: 0, 22: 0}
    assert bits(flanks=["depth"]) == {10: 0, 11: 1, 21: 1, 22: 0}


def test_germline_calls_of_one_strand_and_null_filters(spark):
    rows = [("+", 1, 7, False, True, True), ("-", 1, 8, False, True, False), ("+", 2, 7, True, True, True), ("+", 3, 7, False, None, True), ("-", 4, 9, False, True, True), ("+", 5, 7, None, True, True)]
    calls = spark.createDataFrame(rows, "strand string, zm long, q int, germline_pass boolean, trim_pass boolean, germline_region_pass boolean")
    got = cl.germline_calls(calls, ["germline_region_pass"], ["zm"], ["q"]).collect()
    assert sorted((r.zm, r.q_plus, r.q_minus) for r in got) == [(1, 7, 8), (4, None, 9)]


def test_anchored_alleles_at_a_contigs_start(spark):
    tiles = gn.tiled(spark.createDataFrame([("a", "GATTC")], "seqnames string, seq string").withColumn("len", F.length("seq").cast("long")))
    rows = [("a", "deletion", 3, 4, "TT", ""), ("a", "insertion", 2, 1, "", "C"), ("a", "SBS", 2, 2, "A", "C"), ("a", "deletion", 1, 1, "G", "")]
    calls = spark.createDataFrame(rows, "seqnames string, call_type string, start_pos long, end_pos long, ref_plus_strand string, alt_plus_strand string")
    got = sorted((r.pos, r.ref, r.alt) for r in ev.vcf_alleles(calls, tiles).collect())
    assert got == [(0, "NG", "N"), (1, "G", "GC"), (2, "A", "C"), (2, "ATT", "A")]
