"""Barcode sheets by hand, and values that the queries' stand-in inputs don't have."""

from strandlake.functions.sequences import softclip
from strandlake.operators import barcodes as bc
from strandlake.operators import evidence as ev
from strandlake.plans.pileup_queries import CONFIG
from strandlake.sources import config, text

SHEET = "run_id string, sample string, barcode_ids string, barcode_ids_round2 string"
KNOWN = "barcode string, sequence string"


def test_reads_go_to_the_second_round_first(spark):
    sheet = spark.createDataFrame([("r", "a", "b2-b1", None), ("r", "b", "b1-b3", "c1"), ("r", "c", "b3-b1", "c2-c1"), ("r", "d", "b4", ""), ("q", "e", "b1-b2", None), ("r", "f", "b!", None)], SHEET)
    rows = [("r", "b1-b2", None), ("r", "b1-b2", "c1"), ("r", "b1-b3", "c1"), ("r", "b1-b3", "c1-c2"), ("r", "b1-b3", None), ("r", "b1-b3", "c9"), ("r", "b4", "c1"), ("q", "b1-b2", "x"), ("q", "b4", None), (None, "b4", None), ("r", None, None)]
    reads = spark.createDataFrame([(k, *r, "old") for k, r in enumerate(rows)], "k int, run_id string, pair string, pair2 string, sample string")
    got = {r.k: (r.sample, r.barcodes, r.round) for r in bc.assign_rounds(reads, sheet).collect()}
    assert got == {0: ("a", "b2-b1", 1), 1: ("a", "b2-b1", 1), 2: ("b", "b1-b3.c1", 2), 3: ("c", "b3-b1.c2-c1", 2), 6: ("d", "b4", 1), 7: ("e", "b1-b2", 1)}
    assert bc.assign_rounds(reads, sheet.where("false")).count() == 0


def test_a_pair_of_both_rounds_prefers_the_second(spark):
    sheet = spark.createDataFrame([("r", "a", "b1", None), ("r", "b", "b1", "c1")], SHEET)
    reads = spark.createDataFrame([(1, "r", "b1", "c1"), (2, "r", "b1", "c2")], "k int, run_id string, pair string, pair2 string")
    assert {r.k: r.sample for r in bc.assign_rounds(reads, sheet).collect()} == {1: "b", 2: "a"}


def test_each_rule_of_sheets(spark):
    known = spark.createDataFrame([("b1", "A"), ("b2", "C"), ("b2", "G"), ("b3", "A"), ("b-4", "T")], KNOWN)
    rows = [("r", "a", "b1-b2", None), ("r", "b", "b2-b1", None), ("r", "c", "b1-b2", "b1"), ("r", "d", "b3-b2", "b1"), ("r", "e", "b2-b3", "b1"), ("r", "f", "b9", "b1-b2"), ("q", "a", "b1", "b1")]
    rows += [("q", "g", None, None), ("q", "h", "", None), ("q", "i", "b1-b1", None), ("q", "j", "b1-b2-b3", "b1\n")]
    got = sorted(tuple(r) for r in bc.sheet_rules(spark.createDataFrame(rows, SHEET), known).fillna("-", ["run_id"]).fillna(0, ["round"]).collect())
    assert got == sorted([
        ("undefined", "q", 1, "g"), ("undefined", "q", 1, "h: "), ("equal ids", "q", 1, "i: b1-b1"), ("malformed", "q", 1, "j: b1-b2-b3"), ("malformed", "q", 2, "j: b1\n"),
        ("unknown barcode", "r", 1, "b9"), ("pair given twice", "r", 1, "b1-b2"), ("pair in both rounds", "r", 1, "b1-b2"), ("combination given twice", "r", 2, "b2-b3|b1"),
        ("mixed modes", "r", 1, "different, same"), ("mixed modes", "r", 2, "different, same"), ("second round in some runs", "-", 2, "a"),
        ("malformed barcode", "-", 0, "b-4"), ("barcode with two sequences", "-", 0, "b2"), ("sequence with two barcodes", "-", 0, "A"),
    ])
    assert bc.sheet_rules(spark.createDataFrame([], SHEET), spark.createDataFrame([], KNOWN)).count() == 0


def test_sheet_of_a_configuration(spark):
    tables = config.config_tables(spark, CONFIG)
    assert bc.sheet_rules(tables["sheet"], tables["barcodes"]).count() == 0
    assert {(r.sample, r.pair, r.pair2) for r in bc.sheet_pairs(tables["sheet"]).collect()} == {("s1", "bc1-bc2", None), ("s2", "bc1-bc9", "bc9"), ("s3", "bc1-bc2", None)}


def test_soft_clips_of_both_ends(spark):
    rows = spark.createDataFrame([("5S10=3S",), ("10=",), ("",), (None,), ("12S",)], "cigar string")
    assert [r[0] for r in rows.select(softclip("cigar")).collect()] == [8, 0, 0, None, 12]


def test_statistics_that_no_class_needs(spark):
    stats = spark.createDataFrame([("a.indelanalysis.x",), ("a.nonindelanalysis.x",), ("a",), (None,)], "stat string")
    kept = lambda *classes: {r.stat for r in ev.prune_stats(stats, list(classes)).collect()}
    assert kept("indel") == {"a.indelanalysis.x", "a", None} and kept("MDB") == kept("SBS") == {"a.nonindelanalysis.x", "a", None}
    assert len(kept("SBS", "indel")) == 4 and kept() == {"a", None}


def test_tab_separated_values_come_back(spark, tmp_path):
    rows = [("k", 'a"b', 1), ("k", "", 2), ("k", None, 3), (None, "x\ty", 4), ("l m", "line\nline", 5), ("k", "back\\", 6)]
    df = spark.createDataFrame(rows, "by string, note string, n int")
    text.write_tsv(df, f"{tmp_path}/t", ["by"])
    assert {tuple(r) for r in text.read_tsv(spark, f"{tmp_path}/t", df.schema).collect()} == set(rows)
