"""Registered queries against their SQL on the smallest tables."""

import decimal
import os

import duckdb
import pytest

from strandlake.plans import catalog

SF = "/root/testdata/sf0.001"
SOME = (
    "c13_classify_counts d1_overlaps_any d1_overlaps_adjacent d3_subtract d4_subtract_keyed d5_merge d9_non_duplex e6_coverage e9_coverage_at e11_threshold_track e12_low_depth "
    "c10_trinucleotides c1_cigar_ranges c2_extract_calls g1_sbs96 g7_deletion_repeats g22_borrow_sensitivity f10_sbs_flank f17_region_read_filter b7_assign_chunk a3_parse_vcf c7_opposite_quality c9_modified_bases c13_chained_classes c14_partners_evidence "
    "b12_allele_counts b11_depth_runs f13_germline_support a10_base_coverage a4_germline_set a3_germline_in_regions f4_configured_germline a7_configured_scope g16_burden_grid "
    "f7_tracker_remaining f21_tracker_left g15_tracked_bases f_call_filters f16_germline_sources f8_f14_evidence_filters e26_union_chunks "
    "b3_two_rounds b4_sheet_rules f1_softclip g2_template_grid a6_read_fasta a8_write_tsv a11_write_bundle e24_prune_stats e5_summed_stats f1_molecule_quality "
    "g26_germline_pairs g24_error_by_target f12_f18_genome_filters f12_f18_genome_left g19_sensitivity_variants a2_run_metadata g4_vcf_alleles a9_vcf_document "
    "e17_weighted_trinucleotides e17_oriented_trinucleotides e8_coverage_by_bc"
).split()


def value(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    return float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"create view {name.split('.')[0]} as select * from '{SF}/{name}'")
    return con


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", SOME)
def test_query_equals_sql(spark, tables, name):
    df = catalog.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(str(value(row[c])) for c in columns) for row in df.collect())
    result = tables.execute(catalog.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(tuple(str(value(row[names.index(c)])) for c in columns) for row in result.fetchall())
    assert got == want


def test_every_query_but_the_exact_intervals_has_sql():
    assert set(catalog.QUERIES) - set(catalog.SQL) == {"g17_poisson_intervals"}
