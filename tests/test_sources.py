"""Text sources with missing values, sites without genotypes and unmapped records."""

from strandlake.sources import text


def test_variants_with_missing_values(spark):
    lines = ["#CHROM", "c\t5\t.\tA\tG\t.\tPASS\t.\tGT:AD:DP:GQ\t0/1:.:.:.", "c\t7\t.\tA\tAT\t30\tPASS\t.\tGT:AD:DP\t0/1:3,4:7", "c\t9\t.\tA\tC\t50\tPASS\tAF=0.1", "c\t11\t.\tA\tC\t50\tPASS\t.\tGT:AD\t1/1"]
    rows = {r.start_pos: r for r in text.parse_vcf(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert set(rows) == {5, 8, 11}
    assert rows[5].qual is None and rows[5].ad1 is None and rows[5].depth is None and rows[5].vaf is None and rows[5].gq is None
    assert (rows[8].qual, rows[8].ad1, rows[8].ad2, rows[8].depth, rows[8].gq) == (30.0, 3, 4, 7, None)
    assert rows[11].ad2 is None


def test_unmapped_records(spark):
    lines = ["@HD", "m/1/ccs/fwd\t4\t*\t0\t0\t*\t*\t0\t0\tACGT\t*", "m/2/ccs/rev\t16\tc\t10\t60\t2=1X\t*\t0\t0\tACG\t*\tec:f:5"]
    rows = {r.qname: r for r in text.parse_sam(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert rows["m/1/ccs/fwd"].end_pos is None and rows["m/1/ccs/fwd"].seqnames == "*"
    assert rows["m/2/ccs/rev"].end_pos == 12 and rows["m/2/ccs/rev"].tags == {"ec": "5"}
