"""Queries that run the text parsers on lines derived from the tables, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import text as tx
from . import fixtures as fx

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name], SQL[name] = f, fx.with_views(sql)
        return f

    return keep


def _tabs(df, *cols):
    return df.select(F.concat_ws("\t", *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols]).alias("value"))


def _vcf(s, d):
    o = s.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderkey").alias("k"))
    k = F.col("k")
    ref = F.when(k % 3 == 1, "AC").otherwise("A")
    alt = F.when(k % 3 == 0, "G,T").when(k % 3 == 1, "A,*").otherwise("ATT")
    gt = F.when(k % 6 == 0, "1/2").when(k % 2 == 0, "0/1").otherwise("1|1")
    sample = F.concat(gt, F.lit(":"), (10 + k % 30).cast("string"), F.lit(","), (k % 40).cast("string"), F.lit(",3:"), (20 + k % 50).cast("string"), F.lit(":"), (k % 99).cast("string"))
    info = F.concat(F.lit("AF="), (k % 10).cast("string"), F.lit("e-4,0.5;DP=7"))
    return _tabs(o, F.concat(F.lit("chr"), k % 5), k, F.lit("."), ref, alt, k % 60, F.when(k % 7 == 0, "LowQual").otherwise("PASS"), info, F.lit("GT:AD:DP:GQ"), sample)


_V = """v as (select o_orderkey as k, case when o_orderkey % 3 = 1 then 'AC' else 'A' end as r from orders),
 e as (select k, r, 'G' as a, 1 as i from v where k % 3 = 0 union all select k, r, 'T', 2 from v where k % 3 = 0 and k % 6 = 0 union all select k, r, 'A', 1 from v where k % 3 = 1 union all select k, r, 'ATT', 1 from v where k % 3 = 2)"""


@query("a3_parse_vcf", _V + """ select 'chr' || (k % 5)::varchar as seqnames, k + case when k % 3 = 0 then 0 else 1 end as start_pos, case when k % 3 = 1 then k + 1 else k end as end_pos, case when k % 3 = 0 then 'A' when k % 3 = 1 then 'C' else '' end as ref, case when k % 3 = 0 then a when k % 3 = 1 then '' else 'TT' end as alt,
 (k % 60)::double as qual, case when k % 7 = 0 then 'LowQual' else 'PASS' end as filter, case when k % 6 = 0 then '1/2' when k % 2 = 0 then '0/1' else '1|1' end as gt, (k % 99)::double as gq, 10 + k % 30 as ad1, case when i = 1 then k % 40 else 3 end as ad2, 20 + k % 50 as depth,
 round((case when i = 1 then k % 40 else 3 end)::double / (10 + k % 30 + case when i = 1 then k % 40 else 3 end), 9) as vaf, case when k % 3 = 0 then 'SBS' else 'indel' end as call_class, case k % 3 when 0 then 'SBS' when 1 then 'deletion' else 'insertion' end as call_type from e""")
def a3_parse_vcf(s, d):
    return tx.parse_vcf(_vcf(s, d)).withColumn("vaf", F.round("vaf", 9))


@query("b13_population_variants", """SELECT 'chr' || (k % 5)::varchar as seqnames, k as pos, r as ref, a as alt from (select o_orderkey as k, case when o_orderkey % 3 = 1 then 'AC' else 'A' end as r, unnest(case o_orderkey % 3 when 0 then ['G', 'T'] when 1 then ['A', '*'] else ['ATT'] end) as a, unnest(case o_orderkey % 3 when 2 then [1] else [1, 2] end) as i from orders) t where k % 7 <> 0 and (i = 2 or k % 10 >= 5)""")
def b13_population_variants(s, d):
    return tx.population_variants(_vcf(s, d), 0.0005)


@query("b14_variants_to_bed", """SELECT case when k % 3 = 0 then 'snv' else 'indel' end as kind, 'chr' || (k % 5)::varchar as seqnames, case when k % 3 = 1 then k else k - 1 end as bed_start, case when k % 3 = 0 then k when k % 3 = 1 then k + 1 else k + 1 end as bed_end from (select o_orderkey as k, unnest(case o_orderkey % 3 when 0 then ['G', 'T'] when 1 then ['A'] else ['ATT'] end) as a, unnest(case o_orderkey % 3 when 0 then [1, 2] else [1] end) as i from orders) t where k % 7 <> 0 and (i = 2 or k % 10 >= 5)""")
def b14_variants_to_bed(s, d):
    return tx.variants_to_bed(tx.population_variants(_vcf(s, d), 0.0005))


@query("a5_parse_bed", "SELECT seqnames, start_pos, end_pos, round(score, 6) as score from fx_region")
def a5_parse_bed(s, d):
    r = fx.regions(s, d)
    return tx.parse_bed(_tabs(r, "seqnames", F.col("start_pos") - 1, "end_pos", "score")).withColumn("score", F.round("score", 6))


@query("a1_parse_sam", """SELECT 'm/' || zm::varchar || '/' || case when strand = '+' then 'fwd' else 'rev' end as qname, case when strand = '+' then 0 else 16 end as flag, seqnames, start_pos, start_pos + 59 + zm % 5 as end_pos, mapq, strand, case when strand = '+' then 'fwd' else 'rev' end as ccs_strand, ec::varchar as ec from fx_read""")
def a1_parse_sam(s, d):
    r = fx.reads(s, d)
    plus = F.col("strand") == "+"
    cigar = F.concat(F.lit("5S30=2I"), (F.col("zm") % 5 + 10).cast("string"), F.lit("D20="))
    lines = _tabs(r, F.concat(F.lit("m/"), F.col("zm"), F.lit("/"), F.when(plus, "fwd").otherwise("rev")), F.when(plus, 0).otherwise(16), "seqnames", "start_pos", "mapq", cigar, F.lit("*"), F.lit("0"), F.lit("0"), F.lit("ACGT"), F.lit("!!!!"), F.concat(F.lit("ec:f:"), F.col("ec")))
    return tx.parse_sam(lines).select("qname", "flag", "seqnames", "start_pos", "end_pos", "mapq", "strand", "ccs_strand", F.col("tags")["ec"].alias("ec"))


@query("a2_parse_read_groups", "SELECT 'rg' || c_custkey::varchar as id, 'mv' || (c_custkey % 9)::varchar as movie, 'CCS' as readtype from customer")
def a2_parse_read_groups(s, d):
    c = s.read.parquet(f"{d}/customer.parquet")
    lines = _tabs(c, F.lit("@RG"), F.concat(F.lit("ID:rg"), F.col("c_custkey")), F.concat(F.lit("PU:mv"), F.col("c_custkey") % 9), F.lit("DS:READTYPE=CCS;BINDINGKIT=1"))
    return tx.parse_read_groups(lines).select("id", "movie", F.col("description")["READTYPE"].alias("readtype"))


@query("a9_vcf_lines", "SELECT seqnames || chr(9) || start_pos::varchar || chr(9) || '.' || chr(9) || 'A' || chr(9) || substr('CGT', alt_code::int, 1) || chr(9) || '.' || chr(9) || 'PASS' || chr(9) || case when zm % 2 = 0 then 'zm=' || zm::varchar || ';' else '' end || 'strand=' || strand as value from fx_call where call_type = 'SBS'")
def a9_vcf_lines(s, d):
    c = fx.calls(s, d).where("call_type = 'SBS'").withColumn("ref", F.lit("A")).withColumn("alt", F.substr(F.lit("CGT"), F.col("alt_code").cast("int"), F.lit(1)))
    return tx.to_vcf_lines(c.withColumn("zm", F.when(F.col("zm") % 2 == 0, F.col("zm"))), ["zm", "strand"])
