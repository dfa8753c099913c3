"""Queries of the evidence operators, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.sequences import reverse_complement
from ..operators import calls as cl
from ..operators import evidence as ev
from ..operators import genome as gn
from ..operators import intervals as iv
from ..operators import spectra as sp
from . import fixtures as fx
from .call_queries import _INDEL, _OPP, _SBS, _SITE, _VAR, SITE, _classified, _indels, _sbs, _variants
from .interval_queries import _RUNS
from .molecule_queries import _AT, _RC

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name], SQL[name] = f, fx.with_views(sql)
        return f

    return keep


@query("b1_filter_adapter", "SELECT run_id, zm, strand from fx_read where zm % 4 = 0")
def b1_filter_adapter(s, d):
    return ev.filter_adapter(fx.reads(s, d).withColumn("ma", F.col("zm") % 4)).select("run_id", "zm", "strand")


@query("b5_bc_orientation", "SELECT zm, strand, 'bc' || (zm % 3)::varchar || '-bc' || (zm % 4)::varchar as bc_orientation from fx_read")
def b5_bc_orientation(s, d):
    codes = s.range(4).select(F.explode(F.array(F.lit("run0"), F.lit("run1"))).alias("run_id"), F.concat(F.lit("bc"), "id").alias("barcode"))
    r = fx.reads(s, d).withColumns({"bc_i": (F.col("zm") % 3).cast("int"), "bc_j": (F.col("zm") % 4).cast("int")})
    return ev.bc_orientation(r, codes).select("zm", "strand", "bc_orientation")


@query("b8_merge_runs", "SELECT run_id, zm, strand, seqnames, start_pos from fx_read")
def b8_merge_runs(s, d):
    r = fx.reads(s, d).select("run_id", "zm", "strand", "seqnames", "start_pos")
    return ev.merge_runs([r.where("run_id = 'run0'"), r.where("run_id = 'run1'")])


@query("b11_pileup_depth", _RUNS.replace("where strand = '+'", "where zm % 9 <> 0") + " select seqnames, start_pos, end_pos, depth from runs")
def b11_pileup_depth(s, d):
    flag = F.when(F.col("zm") % 9 == 0, 1024).otherwise(F.when(F.col("strand") == "+", 0).otherwise(16))
    return ev.pileup_depth(fx.reads(s, d).withColumn("flag", flag))


@query("b12_pileup_alleles", "SELECT seqnames, start_pos, count(*) filter (where alt_code = 1) as n1, count(*) filter (where alt_code = 2) as n2, count(*) filter (where alt_code = 3) as n3 from fx_call where call_type = 'SBS' group by all")
def b12_pileup_alleles(s, d):
    return ev.pileup_alleles(fx.calls(s, d))


@query("c5_alleles", f"t as (select c.*, {_AT.format(0, 1)} as r from fx_call c join fx_contig g using (seqnames) where call_type = 'SBS') select {SITE}, r as ref_plus_strand, substr('ACGT', ((strpos('ACGT', r) - 1 + alt_code) % 4 + 1)::int, 1) as alt_plus_strand from t c")
def c5_alleles(s, d):
    return ev.alleles(fx.calls(s, d).where("call_type = 'SBS'"), gn.tiled(fx.contigs(s, d))).select(*_SITE, "ref_plus_strand", "alt_plus_strand")


@query("c14_partner_values", f"SELECT {SITE}, o.w as w_opposite from fx_call c left join fx_call o on o.run_id = c.run_id and o.zm = c.zm and o.seqnames = c.seqnames and o.call_type = c.call_type and o.start_pos = c.start_pos and o.end_pos = c.end_pos and o.alt_code = c.alt_code and o.strand = case c.strand when '+' then '-' else '+' end")
def c14_partner_values(s, d):
    return ev.partner_values(fx.calls(s, d), ["run_id", "zm", "seqnames", "call_type", "start_pos", "end_pos", "alt_code"], ["w"]).select(*_SITE, "w_opposite")


@query("c15_attach_orientation", f"SELECT {SITE}, case when c.strand = '+' then 'a-b' else 'b-a' end as bc_orientation from fx_call c")
def c15_attach_orientation(s, d):
    r = fx.reads(s, d).withColumn("bc_orientation", F.when(F.col("strand") == "+", "a-b").otherwise("b-a"))
    return ev.attach_orientation(fx.calls(s, d), r).select(*_SITE, "bc_orientation")


@query("f3_max_mutations", _OPP + ", n as (select run_id, zm, count(distinct (seqnames, call_type, start_pos, end_pos, alt_code)) as n from cls where call_class = 'mutation' group by all) select m.run_id, m.zm, coalesce(n, 0) <= 1 as pass from (select distinct run_id, zm from fx_read) m left join n on n.run_id = m.run_id and n.zm = m.zm")
def f3_max_mutations(s, d):
    return ev.max_mutations(fx.reads(s, d), _classified(s, d).where("call_class = 'mutation'"), 1)


@query("f7_unknown_bases", f"SELECT {SITE}, not (c.call_type <> 'insertion' and ctg.contig_idx % 10 = 0 and contains(substr(ctg.seq, c.start_pos::int, (c.end_pos - c.start_pos + 1)::int), 'G')) as known_pass from fx_call c join fx_contig ctg using (seqnames) where c.call_type <> 'insertion'")
def f7_unknown_bases(s, d):
    masked = gn.unknown_regions(fx.contigs(s, d).where("contig_idx % 10 = 0").withColumn("seq", F.translate("seq", "G", "N")))
    return cl.region_filter(fx.calls(s, d).where("call_type <> 'insertion'"), masked, "known_pass").select(*_SITE, "known_pass")


@query("f8_min_quality", f"SELECT {SITE}, not exists (select 1 from fx_read r, lateral (select unnest(generate_series(c.start_pos, c.end_pos)) as p) t where r.run_id = c.run_id and r.zm = c.zm and t.p between r.start_pos and r.end_pos and (r.zm + t.p - r.start_pos) % 94 < 4) as qual_pass from fx_call c where c.call_type <> 'insertion'")
def f8_min_quality(s, d):
    qual = F.transform(F.sequence(F.lit(0).cast("long"), F.col("end_pos") - F.col("start_pos")), lambda i: ((F.col("zm") + i) % 94).cast("int"))
    low = ev.low_places(fx.reads(s, d).withColumn("qual", qual), "qual", 4)
    return ev.low_quality_filter(fx.calls(s, d).where("call_type <> 'insertion'"), low).select(*_SITE, "qual_pass")


@query("f13_germline_reads", f"p as (select seqnames, start_pos, alt_code, count(*) as n from fx_call where call_type = 'SBS' and zm % 2 = 0 group by all) select {SITE}, c.call_type <> 'SBS' or coalesce(p.n, 0) <= 1 as germline_reads_pass from fx_call c left join p on p.seqnames = c.seqnames and p.start_pos = c.start_pos and p.alt_code = c.alt_code")
def f13_germline_reads(s, d):
    c = fx.calls(s, d)
    return ev.germline_reads(c, ev.pileup_alleles(c.where("zm % 2 = 0")), 1).select(*_SITE, "germline_reads_pass")


@query("f16_germline_indels", "i as (select distinct 'vcf' || (zm % 2)::varchar as source, seqnames, start_pos, end_pos, w from fx_call where call_type <> 'SBS' and zm % 5 = 0) select " + SITE + ", " + ", ".join(f"not exists (select 1 from i where source = 'vcf{k}' and i.seqnames = c.seqnames and c.start_pos <= i.end_pos + greatest(2 * i.w, 5) and c.end_pos >= greatest(i.start_pos - greatest(2 * i.w, 5), 1)) as vcf{k}_pass" for k in (0, 1)) + " from fx_call c")
def f16_germline_indels(s, d):
    c = fx.calls(s, d)
    indels = c.where("call_type <> 'SBS' AND zm % 5 = 0").select(F.concat(F.lit("vcf"), F.col("zm") % 2).alias("source"), "seqnames", "start_pos", "end_pos", "w").distinct()
    return ev.germline_indel_regions(c, indels, ["vcf0", "vcf1"], "m2b5").select(*_SITE, "vcf0_pass", "vcf1_pass")


_MATCH = _VAR + ", g as (select distinct seqnames, start_pos, end_pos, call_type, alt_code from vars), m as (select c.*, g.seqnames is null as germline_pass, c.zm % 5 <> 0 as other_pass from fx_call c left join g using (seqnames, start_pos, end_pos, call_type, alt_code))"


@query("f21_exempt_copies", _MATCH + " select run_id, call_type, false as germline_exempt, count(*) as calls from m where germline_pass and other_pass group by all union all select run_id, call_type, true, count(*) from m where other_pass group by all")
def f21_exempt_copies(s, d):
    m = cl.match_variants(fx.calls(s, d), _variants(s, d), ["seqnames", "start_pos", "end_pos", "call_type", "alt_code"]).withColumn("other_pass", F.col("zm") % 5 != 0)
    return ev.with_exempt_copies(m, ["germline_pass"], ["other_pass"]).groupBy("run_id", "call_type", "germline_exempt").agg(F.count(F.lit(1)).alias("calls"))


@query("g26_germline_calls", _MATCH + f" select {SITE} from m c where not germline_pass and other_pass")
def g26_germline_calls(s, d):
    on = ["seqnames", "start_pos", "end_pos", "call_type", "alt_code"]
    c = fx.calls_by(s, d, *on)
    m = cl.match_variants(c, _variants(s, d, c), on)
    return m.where("NOT germline_pass AND zm % 5 <> 0").select(*_SITE)


@query("g2_sbs192", f"{_SBS} select run_id, case when strand = '-' then t || '>' || a else {_RC.format('t')} || '>' || {_RC.format('a')} end as channel, count(*) as count from ch group by all")
def g2_sbs192(s, d):
    c = cl.oriented(_sbs(s, d).where("reftnc IS NOT NULL"))
    alt = F.when(F.col("strand") == "-", F.col("alttnc")).otherwise(reverse_complement("alttnc"))
    return c.groupBy("run_id", F.concat_ws(">", "reftnc_template", alt).alias("channel")).agg(F.count(F.lit(1)).alias("count"))


@query("g4_vcf_anchor", f"SELECT {SITE}, c.start_pos - 1 as anchor_pos, {_AT.format(1, 1)} as anchor_base from fx_call c join fx_contig g using (seqnames) where c.call_type <> 'SBS'")
def g4_vcf_anchor(s, d):
    return ev.vcf_anchor(fx.calls(s, d).where("call_type <> 'SBS'"), gn.tiled(fx.contigs(s, d))).select(*_SITE, "anchor_pos", "anchor_base")


@query("e25_assemble", "SELECT distinct seqnames, start_pos, 'sbs' as analysis from fx_call where call_type = 'SBS' union all select distinct seqnames, start_pos, 'indel' from fx_call where call_type <> 'SBS'")
def e25_assemble(s, d):
    c = fx.calls(s, d)
    return ev.assemble({"sbs": c.where("call_type = 'SBS'").select("seqnames", "start_pos"), "indel": c.where("call_type <> 'SBS'").select("seqnames", "start_pos")}, "analysis")


@query("c6_call_quality", "SELECT run_id, zm, strand, call_type, array_to_string(list_transform(generate_series(least(a, b), greatest(a, b)), lambda p: (zm + p) % 94), ',') as call_qual from (select run_id, zm, strand, call_type, 10 + zm % 40 as a, case call_type when 'deletion' then 9 + zm % 40 else 9 + zm % 40 + w end as b from fx_call) t")
def c6_call_quality(s, d):
    qual = F.transform(F.sequence(F.lit(1), F.lit(80)), lambda i: ((F.col("zm") + i) % 94).cast("int"))
    at = 10 + F.col("zm") % 40
    c = fx.calls(s, d).withColumns({"start_query": at, "end_query": F.when(F.col("call_type") == "deletion", at - 1).otherwise(at - 1 + F.col("w"))})
    out = ev.call_quality(c, fx.reads(s, d).withColumn("qual", qual), "qual")
    return ev.join_list(out, "call_qual").select("run_id", "zm", "strand", "call_type", "call_qual")


@query("c9_extract_mdb", "SELECT run_id, zm, strand, seqnames, start_pos + i as start_pos, start_pos + i as end_pos, ((zm + i * 7) % 100)::double / 100 as mdb_score from (select *, unnest(generate_series(0, 49)) as i from fx_read) t where ((zm + i * 7) % 100)::double / 100 >= 0.95")
def c9_extract_mdb(s, d):
    score = F.transform(F.sequence(F.lit(0), F.lit(49)), lambda i: ((F.col("zm") + i * 7) % 100).cast("double") / 100)
    return ev.extract_mdb(fx.reads(s, d).withColumn("score", score), "score", 0.95)


@query("f14_subread_support", f"SELECT {SITE}, (c.zm % 20)::double / 19 >= 0.8 and case when c.zm % 7 + c.start_pos % 5 = 0 then false else (c.zm % 7)::double / (c.zm % 7 + c.start_pos % 5) >= 0.6 end as subread_pass from fx_call c")
def f14_subread_support(s, d):
    z = F.col("zm")
    c = fx.calls(s, d).withColumns({"sa": z % 20, "highest_sa": F.lit(19), "sm": F.when(z % 7 + F.col("start_pos") % 5 > 0, z % 7), "sx": F.col("start_pos") % 5})
    return ev.subread_support(c, 0.8, 0.6).select(*_SITE, "subread_pass")


@query("f6_post_germline_limits", _MATCH + ", n as (select run_id, zm, max(n) as n from (select run_id, zm, strand, count(*) as n from m where germline_pass group by all) t group by all) select r.run_id, r.zm, coalesce(n, 0) <= 2 as pass from (select distinct run_id, zm from fx_read) r left join n on n.run_id = r.run_id and n.zm = r.zm")
def f6_post_germline_limits(s, d):
    m = cl.match_variants(fx.calls(s, d), _variants(s, d), ["seqnames", "start_pos", "end_pos", "call_type", "alt_code"])
    return ev.post_germline_limits(fx.reads(s, d), m, "germline_pass", 2)


@query("g15_interrogated", "b as (select sum(end_pos - start_pos + 1)::bigint as bp from fx_read where strand = '+') select k as call_class, case when k = 'mutation' then bp else 2 * bp end as bases from b, (select unnest(['mutation', 'mismatch-ss', 'mismatch-ds']) as k) t")
def g15_interrogated(s, d):
    runs = iv.duplex_coverage(fx.reads(s, d))
    return ev.interrogated(runs, s.createDataFrame([("mutation",), ("mismatch-ss",), ("mismatch-ds",)], "call_class string"))


@query("g12_combine_indels", "SELECT run_id, least(w, 5)::varchar || ':' || call_type as channel, count(*) as count from fx_call where call_type <> 'SBS' group by all")
def g12_combine_indels(s, d):
    c = fx.calls(s, d).where("call_type <> 'SBS'").withColumn("channel", F.concat(F.least("w", F.lit(5)).cast("string"), F.lit(":"), F.col("call_type")))
    per = c.groupBy("run_id", "strand", "channel").agg(F.count(F.lit(1)).alias("count"))
    return ev.combine_indels(per, ["run_id"])


@query("g12_combine_indel_spectra", _INDEL + " select run_id, coalesce(big, pyr) as channel, count(*) as count from ich group by all")
def g12_combine_indel_spectra(s, d):
    """The indel channels of both strands, as filter groups, summed."""
    per = sp.indel_spectrum(_indels(s, d, "true"), ["run_id", "strand"])
    return ev.combine_indels(per, ["run_id"]).where("count > 0")
