"""Indel classes of units of every length."""

import os

import pytest
import test_catalog

from strandlake.operators import genome as gn
from strandlake.operators import spectra as sp
from strandlake.plans import catalog

tables = test_catalog.tables
needs_tables = pytest.mark.skipif(not os.path.isdir(test_catalog.SF), reason="no test tables")


@needs_tables
@pytest.mark.parametrize("name", ["g7_deletion_repeats_all", "g6_insertion_1bp", "g9_insertion_repeats", "g11_indel_spectrum", "g11_indel_template", "g12_combine_indel_spectra"])
def test_query_equals_sql(spark, tables, name):
    test_catalog.test_query_equals_sql(spark, tables, name)


@needs_tables
def test_deletions_of_all_lengths_are_counted(spark, tables):
    got = catalog.QUERIES["g7_deletion_repeats_all"](spark, test_catalog.SF).collect()
    n = tables.execute(catalog.SQL["d1_overlaps_any"].split(" SELECT ")[0] + " SELECT count(*) from fx_call where call_type = 'deletion' and w >= 2").fetchone()[0]
    assert {r.w for r in got} == {2, 3, 4, 5, 6} and sum(r.calls for r in got) == n


def test_five_copies_of_long_units_and_microhomology_of_five(spark):
    unit = "ACGTTGCAAG" * 3
    contigs = spark.createDataFrame([("a", "C" * 990 + unit * 6 + "T" * 9), ("b", "GTACC" + "GTACC" + "TTTTT" * 6)], "seqnames string, seq string")
    points = spark.createDataFrame([("a", 991, 30), ("a", 990, 3), ("a", 1021, 30), ("b", 6, 5), ("b", 2, 2)], "seqnames string, start_pos long, w long")
    x = gn.beside_units(points, contigs).selectExpr("*", "substr(ahead, 1, int(w)) AS unit", "substr(ahead, 1 + int(w), 5 * int(w)) AS after")
    got = {(r.seqnames, r.start_pos): r for r in x.select("*", sp.repeat_class(x.unit, x.after).alias("r"), sp.microhomology(x.unit, x.before, x.after).alias("m")).collect()}
    assert got["a", 991].r == 5 and got["a", 1021].r == 4 and got["a", 990].unit == "CAC"
    assert (got["b", 6].r, got["b", 6].m) == (0, 5) and got["b", 2].before == "NNNNNNNNNG"


def test_channels_of_insertions_and_deletions(spark):
    rows = [
        ("insertion", "-", 1, "A", "TTTTTTTTAA", "AAAC", "1:Ins:T:3", "1:Ins:A:3"),
        ("insertion", "+", 1, "A", "TTTTTTTTTC", "GGGGG", "1:Ins:T:0", "1:Ins:T:0"),
        ("deletion", "+", 1, "C", "TTTTTTTTTT", "CCCCC", "1:Del:C:5", "1:Del:G:5"),
        ("insertion", "+", 2, "AC", "TTTTTTTTTT", "ACACGGGGGG", "2:Ins:R:2", "2:Ins:R:2"),
        ("insertion", "+", 3, "ACG", "TTTTTTTACG", "ACTTTTTTTTTTTTT", "3:Ins:R:0", "3:Ins:R:0"),
        ("deletion", "+", 3, "ACG", "TTTTTTTTTT", "ACTTTTTTTTTTTTT", "3:Del:M:2", "3:Del:M:2"),
        ("insertion", "-", 7, "ACGTTGA", "TTTTTTTTTT", "ACGTTGA" * 5, "5:Ins:R:5", "5:Ins:R:5"),
        ("deletion", "-", 2, "NA", "TTTTTTTTTT", "ACACGGGGGG", None, None),
    ]
    df = spark.createDataFrame(rows, "call_type string, strand string, w long, unit string, before string, after string, pyr string, tem string")
    assert [r.channel for r in sp.indel_channel(df).collect()] == [r[6] for r in rows]
    assert [r.channel for r in sp.indel_channel(df, template=True).collect()] == [r[7] for r in rows]
    assert (sp.indel_channels(spark).count(), sp.indel_channels(spark, True).count()) == (83, 107)
