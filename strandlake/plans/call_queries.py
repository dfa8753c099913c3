"""Queries of call, filter, spectrum and burden operators, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calls as cl
from ..operators import genome as gn
from ..operators import intervals as iv
from ..operators import spectra as sp
from . import fixtures as fx
from .interval_queries import _MASK, _RUNS
from .molecule_queries import _AT, _PYR, _RC, _TNC

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name], SQL[name] = f, fx.with_views(sql)
        return f

    return keep


SITE = "c.run_id, c.zm, c.strand, c.call_type, c.start_pos, c.end_pos"
_SITE = ["run_id", "zm", "strand", "call_type", "start_pos", "end_pos"]
_OPP = """opp as (select c.run_id, c.zm, c.strand, c.seqnames, c.call_type, c.start_pos, c.end_pos, c.alt_code, o.call_type as opp_type, o.start_pos as opp_start, o.end_pos as opp_end, o.alt_code as opp_alt,
 row_number() over (partition by c.run_id, c.zm, c.strand, c.seqnames, c.call_type, c.start_pos, c.end_pos order by o.call_type, o.start_pos, o.end_pos, o.alt_code) as k
 from fx_call c left join fx_call o on o.run_id = c.run_id and o.zm = c.zm and o.seqnames = c.seqnames and o.strand <> c.strand and (
  (c.call_type <> 'deletion' and o.call_type = c.call_type and o.start_pos = c.start_pos and o.end_pos = c.end_pos)
  or (c.call_type <> 'deletion' and o.call_type = 'deletion' and least(c.start_pos, c.end_pos) >= o.start_pos and greatest(c.start_pos, c.end_pos) <= o.end_pos)
  or (c.call_type = 'deletion' and o.call_type <> 'deletion' and least(o.start_pos, o.end_pos) >= c.start_pos and greatest(o.start_pos, o.end_pos) <= c.end_pos)
  or (c.call_type = 'deletion' and o.call_type = 'deletion' and c.start_pos <= o.end_pos and c.end_pos >= o.start_pos))),
 cls as (select *, case when opp_type is null then 'mismatch-ss' when call_type = opp_type and start_pos = opp_start and end_pos = opp_end and alt_code = opp_alt then 'mutation' else 'mismatch-ds' end as call_class from opp where k = 1)"""


def _classified(s, d):
    return cl.classify(cl.opposite_calls(fx.calls(s, d), "alt_code"), "alt_code")


@query("c12_opposite_calls", _OPP + " select run_id, zm, strand, call_type, start_pos, end_pos, opp_type, opp_start, opp_end, opp_alt from cls")
def c12_opposite_calls(s, d):
    return cl.opposite_calls(fx.calls(s, d), "alt_code").select(*_SITE, "opp_type", "opp_start", "opp_end", "opp_alt")


@query("c13_classify_counts", _OPP + " select run_id, call_type, call_class, count(*) as calls, count(distinct zm) as molecules from cls group by run_id, call_type, call_class")
def c13_classify_counts(s, d):
    """The slice end to end: pair filter, strand overlap, opposite strand, classes, limits, counts."""
    return _classified(s, d).groupBy("run_id", "call_type", "call_class").agg(F.count(F.lit(1)).alias("calls"), F.countDistinct("zm").alias("molecules"))


_EDITS = "(zm % 40 + 20) as a, (zm % 3 + 1) as x, (zm % 4 + 1) as i, (zm % 5 + 1) as b"


def _aligned(s, d):
    z = F.col("zm")
    part = lambda n, op: F.concat(n.cast("string"), F.lit(op))
    return fx.reads(s, d).withColumn("cigar", F.concat(part(z % 40 + 20, "="), part(z % 3 + 1, "X"), F.lit("10="), part(z % 4 + 1, "I"), F.lit("30="), part(z % 5 + 1, "D"), F.lit("20=")))


@query("c2_extract_calls", f"""e as (select run_id, zm, strand, start_pos as p, {_EDITS} from fx_read)
 select run_id, zm, strand, 'SBS' as call_type, p + a + k as start_pos, p + a + k as end_pos, a + k + 1 as start_query, a + k + 1 as end_query, 1 as w from e, lateral (select unnest(generate_series(0, x - 1)) as k) t
 union all select run_id, zm, strand, 'insertion', p + a + x + 10, p + a + x + 9, a + x + 11, a + x + 10 + i, i from e
 union all select run_id, zm, strand, 'deletion', p + a + x + 40, p + a + x + 39 + b, a + x + 41 + i, a + x + 40 + i, b from e""")
def c2_extract_calls(s, d):
    return cl.extract_calls(_aligned(s, d)).drop("seqnames")


@query("c8_map_to_query", f"""e as (select run_id, zm, strand, start_pos as p, {_EDITS} from fx_read), q as (select *, p + (zm % 7) * 15 as pos, (zm % 7) * 15 as o from e)
 select run_id, zm, strand, pos, case when o < a + x + 10 then o + 1 when o < a + x + 40 then o + 1 + i when o < a + x + 40 + b then null when o < a + x + 60 + b then o + 1 + i - b end as query from q""")
def c8_map_to_query(s, d):
    r = _aligned(s, d)
    return cl.map_to_query(r.select("run_id", "zm", "strand", (F.col("start_pos") + F.col("zm") % 7 * 15).alias("pos")), r)


@query("c11_oriented", f"t as (select c.*, {_AT.format(1, 3)} as t from fx_call c join fx_contig g using (seqnames) where c.call_type = 'SBS') select {SITE}, case when strand = '-' then {_RC.format('t')} else t end as reftnc_synthesized, case when strand = '-' then t else {_RC.format('t')} end as reftnc_template, {_PYR.format('t')} as reftnc_pyr from t c")
def c11_oriented(s, d):
    sbs = gn.trinucleotides(fx.calls(s, d).where("call_type = 'SBS'"), gn.tiled(fx.contigs(s, d)))
    return cl.oriented(sbs).select(*_SITE, "reftnc_synthesized", "reftnc_template", "reftnc_pyr")


_VAR = "vars as (select distinct seqnames, start_pos, end_pos, call_type, alt_code, case when zm % 2 = 0 then 'deep' else 'shallow' end as germline_type, 10 + zm % 30 as depth, 20 + zm % 50 as qual, (zm % 100)::double / 100 as vaf from fx_call where zm % 6 = 0)"


def _variants(s, d, calls=None):
    z = F.col("zm")
    return (calls or fx.calls(s, d)).where("zm % 6 = 0").select("seqnames", "start_pos", "end_pos", "call_type", "alt_code", F.when(z % 2 == 0, "deep").otherwise("shallow").alias("germline_type"), (10 + z % 30).alias("depth"), (20 + z % 50).alias("qual"), ((z % 100).cast("double") / 100).alias("vaf")).distinct()


@query("f4_select_germline", _VAR + " select * from vars where (germline_type = 'deep' and depth >= 20 and qual >= 30 and vaf >= 0.1) or (germline_type = 'shallow' and depth >= 15 and qual >= 25 and vaf >= 0.2)")
def f4_select_germline(s, d):
    types = s.createDataFrame([("deep", 20, 30, 0.1), ("shallow", 15, 25, 0.2)], "germline_type string, min_depth int, min_qual int, min_vaf double")
    return cl.select_germline(_variants(s, d), types)


@query("f5_germline_match", _VAR + f", g as (select seqnames, start_pos, end_pos, call_type, alt_code, string_agg(distinct germline_type, ',' order by germline_type) as germline_types from vars group by all) select {SITE}, g.germline_types, g.germline_types is null as germline_pass from fx_call c left join g using (seqnames, start_pos, end_pos, call_type, alt_code)")
def f5_germline_match(s, d):
    return cl.match_variants(fx.calls(s, d), _variants(s, d), ["seqnames", "start_pos", "end_pos", "call_type", "alt_code"]).select(*_SITE, "germline_types", "germline_pass")


@query("d12_allele_overlap", _VAR + f" select {SITE}, exists (select 1 from vars v where v.seqnames = c.seqnames and v.call_type = c.call_type and v.alt_code = c.alt_code and c.start_pos <= v.end_pos and c.end_pos >= v.start_pos) as hit from fx_call c")
def d12_allele_overlap(s, d):
    keys = ["seqnames", "call_type", "alt_code"]
    return iv.overlaps_any(fx.calls(s, d), _variants(s, d), keys).select(*_SITE, "hit")


@query("f9_read_trim", f"SELECT {SITE}, not exists (select 1 from fx_read r where r.run_id = c.run_id and r.zm = c.zm and ((c.start_pos <= r.start_pos + 39 and c.end_pos >= r.start_pos) or (c.start_pos <= r.end_pos and c.end_pos >= r.end_pos - 39))) as trim_pass from fx_call c")
def f9_read_trim(s, d):
    return cl.read_trim(fx.calls(s, d), fx.reads(s, d), 40).select(*_SITE, "trim_pass")


@query("f10_sbs_flank", f"""SELECT {SITE}, not exists (select 1 from fx_call o, lateral (select greatest(o.start_pos - 2, 1) as s, o.start_pos - 1 as e union all select o.end_pos + 1, o.end_pos + 2) f where o.call_type = 'SBS' and o.run_id = c.run_id and o.zm = c.zm and o.seqnames = c.seqnames
 and ((c.start_pos <= f.e and c.end_pos >= f.s) or (c.start_pos = c.end_pos + 1 and f.s <= f.e and c.start_pos <= f.e + 1 and c.end_pos >= f.s - 1))) as flank_pass from fx_call c""")
def f10_sbs_flank(s, d):
    return cl.sbs_flank(fx.calls_by(s, d, "run_id", "zm", "seqnames"), 2).select(*_SITE, "flank_pass")


@query("f11_indel_pad", f"SELECT {SITE}, c.call_type <> 'SBS' or not exists (select 1 from fx_call o where o.call_type <> 'SBS' and o.run_id = c.run_id and o.zm = c.zm and c.start_pos <= o.end_pos + greatest(2 * o.w, 15) and c.end_pos >= greatest(o.start_pos - greatest(2 * o.w, 15), 1)) as indel_pass from fx_call c")
def f11_indel_pad(s, d):
    return cl.indel_pad(fx.calls(s, d), "m2b15").select(*_SITE, "indel_pass")


@query("f12_germline_depth", _RUNS + f" select {SITE}, not exists (select 1 from runs r where r.seqnames = c.seqnames and r.depth >= 4 and c.start_pos <= r.end_pos and c.end_pos >= r.start_pos) as depth_pass from fx_call c")
def f12_germline_depth(s, d):
    return cl.region_filter(fx.calls(s, d), iv.duplex_coverage(fx.reads(s, d)).where("depth >= 4"), "depth_pass").select(*_SITE, "depth_pass")


@query("f15_duplex_only", f"SELECT {SITE}, not exists (select 1 from fx_read a join fx_read b on a.run_id = b.run_id and a.zm = b.zm and a.strand <> b.strand, lateral (select a.start_pos as s, least(b.start_pos - 1, a.end_pos) as e union all select greatest(b.end_pos + 1, a.start_pos), a.end_pos) x where x.s <= x.e and a.run_id = c.run_id and a.zm = c.zm and c.start_pos <= x.e and c.end_pos >= x.s) as duplex_pass from fx_call c")
def f15_duplex_only(s, d):
    return cl.duplex_only(fx.calls(s, d), fx.reads(s, d)).select(*_SITE, "duplex_pass")


@query("f17_region_read_filter", _MASK + """, f as (select r.run_id, r.zm, coalesce(sum(case when m.seqnames is not null then least(r.end_pos, m.end_pos) - greatest(r.start_pos, m.start_pos) + 1 end), 0)::double / max(r.end_pos - r.start_pos + 1) as fraction
 from fx_read r left join mask m on m.seqnames = r.seqnames and r.start_pos <= m.end_pos and r.end_pos >= m.start_pos group by r.run_id, r.zm, r.strand)
 select r.run_id, r.zm, r.strand from fx_read r join (select run_id, zm from f group by run_id, zm having avg(fraction) < 0.2) g using (run_id, zm)""")
def f17_region_read_filter(s, d):
    r = fx.reads(s, d)
    return cl.region_read_filter(r, iv.covered_fraction(r, fx.regions(s, d)), "gte", 0.2).select("run_id", "zm", "strand")


@query("f18_region_genome_filter", f"SELECT {SITE}, not exists (select 1 from fx_region r where r.score > 50 and r.seqnames = c.seqnames and c.start_pos <= r.end_pos + 5 and c.end_pos >= greatest(r.start_pos - 5, 1)) as region_pass from fx_call c")
def f18_region_genome_filter(s, d):
    return cl.region_filter(fx.calls(s, d), iv.pad(fx.regions(s, d).where("score > 50"), 5), "region_pass").select(*_SITE, "region_pass")


@query("f22_final_calls", _VAR + f", g as (select distinct seqnames, start_pos, end_pos, call_type, alt_code from vars) select {SITE} from fx_call c where not exists (select 1 from g where g.seqnames = c.seqnames and g.start_pos = c.start_pos and g.end_pos = c.end_pos and g.call_type = c.call_type and g.alt_code = c.alt_code) and not exists (select 1 from fx_read r where r.run_id = c.run_id and r.zm = c.zm and ((c.start_pos <= r.start_pos + 39 and c.end_pos >= r.start_pos) or (c.start_pos <= r.end_pos and c.end_pos >= r.end_pos - 39)))")
def f22_final_calls(s, d):
    matched = cl.match_variants(fx.calls(s, d), _variants(s, d), ["seqnames", "start_pos", "end_pos", "call_type", "alt_code"])
    return cl.final_calls(cl.read_trim(matched, fx.reads(s, d), 40)).select(*_SITE)


@query("f23_scope", "g as (select seqnames, case when contig_idx % 3 = 0 then 'sex' else 'autosome' end as chromgroup from fx_contig) select g.chromgroup, f.filtergroup, c.call_type, count(*) as calls from fx_call c join g using (seqnames) join (select 'strict' as filtergroup, ['SBS'] as t union all select 'lenient', ['all']) f on list_contains(f.t, c.call_type) or list_contains(f.t, 'all') group by all")
def f23_scope(s, d):
    groups = fx.contigs(s, d).select("seqnames", F.when(F.col("contig_idx") % 3 == 0, "sex").otherwise("autosome").alias("chromgroup"))
    filters = s.createDataFrame([("strict", ["SBS"]), ("lenient", ["all"])], "filtergroup string, call_types array<string>")
    return cl.scope(fx.calls(s, d), groups, filters).groupBy("chromgroup", "filtergroup", "call_type").agg(F.count(F.lit(1)).alias("calls"))


@query("e19_unique_calls", "SELECT distinct seqnames, call_type, start_pos, end_pos, alt_code from fx_call")
def e19_unique_calls(s, d):
    return cl.unique_calls(fx.calls(s, d), ["seqnames", "call_type", "start_pos", "end_pos", "alt_code"])


@query("e20_pivot_strands", "SELECT run_id, zm, call_type, start_pos, end_pos, max(case when strand = '+' then alt_code end) as alt_code_plus, max(case when strand = '-' then alt_code end) as alt_code_minus from fx_call group by run_id, zm, call_type, start_pos, end_pos")
def e20_pivot_strands(s, d):
    return cl.pivot_strands(fx.calls(s, d), ["run_id", "zm", "call_type", "start_pos", "end_pos"], ["alt_code"])


_SBS = f"""sb as (select c.*, {_AT.format(1, 3)} as t from fx_call c join fx_contig g using (seqnames) where c.call_type = 'SBS'),
 alt as (select *, substr(t, 1, 1) || substr('ACGT', ((strpos('ACGT', substr(t, 2, 1)) - 1 + alt_code) % 4 + 1)::int, 1) || substr(t, 3, 1) as a from sb where t not like '%N%'),
 ch as (select *, {_PYR.format('t')} as reftnc_pyr, case when substr(t, 2, 1) in ('C', 'T') then a else {_RC.format('a')} end as alttnc_pyr from alt),
 b4 as (select unnest(['A','C','G','T']) as b), lev as (select x.b || r || y.b || '>' || x.b || n.b || y.b as channel from b4 x, (select unnest(['C','T']) as r) c, b4 y, b4 n where n.b <> r)"""


def _sbs(s, d):
    return sp.with_alt(gn.trinucleotides(fx.calls(s, d).where("call_type = 'SBS'"), gn.tiled(fx.contigs(s, d))))


def _spectrum(source: str) -> str:
    return f"cnt as (select run_id, reftnc_pyr || '>' || alttnc_pyr as channel, count(*) as n from {source} group by all), spec as (select k.run_id, lev.channel, coalesce(n, 0) as count, coalesce(n, 0)::double / tot as fraction from (select run_id, sum(n) as tot from cnt group by run_id) k cross join lev left join cnt on cnt.run_id = k.run_id and cnt.channel = lev.channel)"


@query("g1_sbs96", f"{_SBS}, {_spectrum('ch')} select run_id, channel, count, round(fraction, 9) as fraction from spec")
def g1_sbs96(s, d):
    return sp.sbs96(_sbs(s, d), ["run_id"]).withColumn("fraction", F.round("fraction", 9))


@query("g1_sbs96_unique", f"{_SBS}, {_spectrum('(select distinct run_id, seqnames, start_pos, reftnc_pyr, alttnc_pyr from ch)')} select run_id, channel, count, round(fraction, 9) as fraction from spec")
def g1_sbs96_unique(s, d):
    return sp.sbs96(_sbs(s, d), ["run_id"], unique=True).withColumn("fraction", F.round("fraction", 9))


@query("g3_call_trinucleotides", f"{_SBS} select run_id, t as channel, count(*) as count from ch group by all")
def g3_call_trinucleotides(s, d):
    levels = sp.trinucleotides(s).withColumnRenamed("tnc", "channel")
    return sp.count_complete(_sbs(s, d).where("reftnc IS NOT NULL"), "reftnc", levels, ["run_id"]).where("count > 0").drop("fraction")


_RATIO = f"""{_SBS}, {_spectrum('ch')}, {_TNC}, gen as (select {_PYR.format('tnc')} as tnc, sum(n) as n from t64 group by 1), obs as (select reftnc_pyr as tnc, count(*) as n from ch group by 1),
 ratio as (select tnc, (o.n::double / (select sum(n) from obs)) / (g.n::double / (select sum(n) from gen)) as ratio from obs o join gen g using (tnc))"""


def _ratio(s, d):
    genome = gn.to_pyrimidines(gn.trinucleotide_counts(fx.contigs(s, d)))
    seen = _sbs(s, d).where("reftnc_pyr IS NOT NULL").groupBy(F.col("reftnc_pyr").alias("tnc")).agg(F.count(F.lit(1)).alias("n"))
    return sp.tnc_ratio(seen, genome)


@query("g13_tnc_ratio", _RATIO + " select tnc, round(ratio, 9) as ratio from ratio")
def g13_tnc_ratio(s, d):
    return _ratio(s, d).withColumn("ratio", F.round("ratio", 9))


@query("g14_correct_counts", _RATIO + ", cor as (select s.*, case when ratio > 0 then count / ratio else 0 end as corrected from spec s left join ratio r on r.tnc = substr(s.channel, 1, 3)) select run_id, channel, count, round(fraction, 9) as fraction, round(corrected, 6) as corrected, round(corrected / sum(corrected) over (partition by run_id), 9) as corrected_fraction from cor")
def g14_correct_counts(s, d):
    out = sp.correct_counts(sp.sbs96(_sbs(s, d), ["run_id"]), _ratio(s, d), ["run_id"])
    return out.withColumns({"fraction": F.round("fraction", 9), "corrected": F.round("corrected", 6), "corrected_fraction": F.round("corrected_fraction", 9)})


@query("g5_deletion_1bp", f"dd as (select c.*, {_AT.format(10, 21)} as x from fx_call c join fx_contig g using (seqnames) where c.call_type = 'deletion' and c.w = 1), r as (select *, substr(x, 11, 1) as b, reverse(substr(x, 1, 10)) as u, substr(x, 12, 10) as v from dd) select run_id, '1:Del:' || case when b in ('C','T') then b else translate(b, 'AG', 'TC') end || ':' || least(greatest(length(u) - length(ltrim(u, b)), length(v) - length(ltrim(v, b))), 5)::varchar as channel, count(*) as calls from r group by all")
def g5_deletion_1bp(s, d):
    dels = fx.calls(s, d).where("call_type = 'deletion' AND w = 1")
    return sp.deletion_1bp(gn.context(dels, gn.tiled(fx.contigs(s, d)), 10, 10)).groupBy("run_id", "channel").agg(F.count(F.lit(1)).alias("calls"))


@query("g7_deletion_repeats", f"""dd as (select c.*, {_AT.format(6, 20)} as x from fx_call c join fx_contig g using (seqnames) where c.call_type = 'deletion' and c.w between 2 and 3),
 r as (select *, substr(x, 1, 6) as before, substr(x, 7, w::int) as unit, substr(x, 7 + w::int, 20 - 6 - w::int) as after from dd)
 select run_id, w, case when starts_with(after, repeat(unit, 5)) then 5 when starts_with(after, repeat(unit, 4)) then 4 when starts_with(after, repeat(unit, 3)) then 3 when starts_with(after, unit || unit) then 2 when starts_with(after, unit) then 1 else 0 end as repeats,
 case when w > 2 and (substr(unit, 1, 2) = substr(after, 1, 2) or right(unit, 2) = right(before, 2)) then 2 when substr(unit, 1, 1) = substr(after, 1, 1) or right(unit, 1) = right(before, 1) then 1 else 0 end as homology, count(*) as calls from r group by all""")
def g7_deletion_repeats(s, d):
    dels = fx.calls(s, d).where("call_type = 'deletion' AND w BETWEEN 2 AND 3")
    x = gn.context(dels, gn.tiled(fx.contigs(s, d)), 6, 13).withColumn("before", F.substring("context", 1, 6))
    x = x.withColumn("unit", F.substr("context", F.lit(7), F.col("w").cast("int"))).withColumn("after", F.substr("context", (7 + F.col("w")).cast("int"), (14 - F.col("w")).cast("int")))
    out = x.select("run_id", "w", sp.repeat_class(F.col("unit"), F.col("after")).alias("repeats"), sp.microhomology(F.col("unit"), F.col("before"), F.col("after")).alias("homology"))
    return out.groupBy("run_id", "w", "repeats", "homology").agg(F.count(F.lit(1)).alias("calls"))


_AHEAD = """substr(repeat('N', 20) || g.seq || repeat('N', 6 * c.w::int), c.start_pos::int + 10, 10 + 6 * c.w::int)"""
_REPEATS = "case " + " ".join(f"when starts_with(after, repeat(unit, {k})) then {k}" for k in (5, 4, 3, 2, 1)) + " else 0 end"
_HOMOLOGY = "case " + " ".join(f"when w >= {min(k + 1, 5)} and (left(unit, {k}) = left(after, {k}) or right(unit, {k}) = right(before, {k})) then {k}" for k in (5, 4, 3, 2, 1)) + " else 0 end"


def _indels(s, d, where: str):
    """Indels with ``unit``, ``before`` and ``after``, which holds five more units.

    What is inserted are the next w bases, each alt_code - 1 steps further in ACGT, so alt_code 1 is a duplication.
    """
    x = gn.beside_units(fx.calls(s, d).where("call_type <> 'SBS'").where(where), fx.contigs(s, d))
    w, deleted, next_ = F.col("w").cast("int"), F.col("call_type") == "deletion", F.expr("substr(ahead, 1, int(w))")
    inserted = F.when(F.col("alt_code") == 1, next_).when(F.col("alt_code") == 2, F.translate(next_, "ACGT", "CGTA")).otherwise(F.translate(next_, "ACGT", "GTAC"))
    return x.withColumns({"unit": F.when(deleted, next_).otherwise(inserted), "after": F.substr("ahead", F.when(deleted, w + 1).otherwise(1), 5 * w)})


@query("g7_deletion_repeats_all", f"""dd as (select c.*, {_AHEAD} as x from fx_call c join fx_contig g using (seqnames) where c.call_type = 'deletion' and c.w >= 2),
 r as (select *, substr(x, 1, 10) as before, substr(x, 11, w::int) as unit, substr(x, 11 + w::int, 5 * w::int) as after from dd)
 select run_id, w, {_REPEATS} as repeats, {_HOMOLOGY} as homology, count(*) as calls from r group by all""")
def g7_deletion_repeats_all(s, d):
    """Deletions of every length from 2 bp on; g7_deletion_repeats has 2 and 3 bp alone, in a context of 20 bases."""
    out = _indels(s, d, "call_type = 'deletion' AND w >= 2").select("run_id", "w", sp.repeat_class(F.col("unit"), F.col("after")).alias("repeats"), sp.microhomology(F.col("unit"), F.col("before"), F.col("after")).alias("homology"))
    return out.groupBy("run_id", "w", "repeats", "homology").agg(F.count(F.lit(1)).alias("calls"))


_RUN = "least(greatest(length(before) - length(rtrim(before, unit)), length(after) - length(ltrim(after, unit))), 5)::varchar"
_KIND, _BIG = "case when call_type = 'deletion' then 'Del' else 'Ins' end", "least(w, 5)::varchar"
_INDEL = f"""ix as (select c.*, {_AHEAD} as x from fx_call c join fx_contig g using (seqnames) where c.call_type <> 'SBS'),
 iu as (select *, substr(x, 1, 10) as before, case when call_type = 'deletion' or alt_code = 1 then substr(x, 11, w::int) when alt_code = 2 then translate(substr(x, 11, w::int), 'ACGT', 'CGTA') else translate(substr(x, 11, w::int), 'ACGT', 'GTAC') end as unit,
  case when call_type = 'deletion' then substr(x, 11 + w::int, 5 * w::int) else substr(x, 11, 5 * w::int) end as after from ix),
 ik as (select *, {_REPEATS} as repeats, {_HOMOLOGY} as homology from iu where unit not like '%N%'),
 ich as (select *, case when w > 1 and call_type = 'deletion' and repeats = 0 and homology > 0 then {_BIG} || ':Del:M:' || homology::varchar when w > 1 then {_BIG} || ':' || {_KIND} || ':R:' || repeats::varchar end as big,
  case when w = 1 then '1:' || {_KIND} || ':' || case when unit in ('C', 'T') then unit else translate(unit, 'AG', 'TC') end || ':' || {_RUN} end as pyr,
  case when w = 1 then '1:' || {_KIND} || ':' || case when strand = '-' then unit else translate(unit, 'ACGT', 'TGCA') end || ':' || {_RUN} end as tem from ik)"""


def _indel_levels(bases: str) -> str:
    return f"""one as (select '1:' || k || ':' || b || ':' || n::varchar as channel from (select unnest(['Del','Ins']) as k) x, (select unnest([{bases}]) as b) y, generate_series(0, 5) t(n)),
 rep as (select z::varchar || ':' || k || ':R:' || n::varchar as channel from generate_series(2, 5) s(z), (select unnest(['Del','Ins']) as k) x, generate_series(0, 5) t(n)),
 mh as (select z::varchar || ':Del:M:' || n::varchar as channel from generate_series(2, 5) s(z), generate_series(1, 5) t(n) where n < z or z = 5),
 ilev as (select * from one union all select * from rep union all select * from mh)"""


def _indel_spectrum(column: str) -> str:
    return f"""n as (select run_id, coalesce(big, {column}) as channel, count(*) as n from ich group by all)
 select k.run_id, ilev.channel, coalesce(n.n, 0) as count, round(coalesce(n.n, 0)::double / tot, 9) as fraction from (select run_id, sum(n) as tot from n group by run_id) k cross join ilev left join n on n.run_id = k.run_id and n.channel = ilev.channel"""


@query("g6_insertion_1bp", _INDEL + " select run_id, pyr as channel, count(*) as calls from ich where call_type = 'insertion' and w = 1 group by all")
def g6_insertion_1bp(s, d):
    return sp.indel_channel(_indels(s, d, "call_type = 'insertion' AND w = 1")).where("channel IS NOT NULL").groupBy("run_id", "channel").agg(F.count(F.lit(1)).alias("calls"))


@query("g9_insertion_repeats", _INDEL + " select run_id, w, repeats, count(*) as calls from ich where call_type = 'insertion' and w >= 2 group by all")
def g9_insertion_repeats(s, d):
    x = _indels(s, d, "call_type = 'insertion' AND w >= 2").where("unit RLIKE '^[ACGT]+$'")
    return x.groupBy("run_id", "w", sp.repeat_class(F.col("unit"), F.col("after")).alias("repeats")).agg(F.count(F.lit(1)).alias("calls"))


@query("g11_indel_spectrum", _INDEL + ", " + _indel_levels("'C','T'") + ", " + _indel_spectrum("pyr"))
def g11_indel_spectrum(s, d):
    return sp.indel_spectrum(_indels(s, d, "true"), ["run_id"]).withColumn("fraction", F.round("fraction", 9))


@query("g11_indel_template", _INDEL + ", " + _indel_levels("'C','T','G','A'") + ", " + _indel_spectrum("tem"))
def g11_indel_template(s, d):
    return sp.indel_spectrum(_indels(s, d, "true"), ["run_id"], template=True).withColumn("fraction", F.round("fraction", 9))


@query("e18_group_quantile", "SELECT l_returnflag, l_linestatus, count(*) as kept, round(q, 6) as q from (select *, quantile_cont(l_extendedprice::double, 0.9) over (partition by l_returnflag, l_linestatus) as q from lineitem) t where l_extendedprice >= q group by l_returnflag, l_linestatus, q")
def e18_group_quantile(s, d):
    items = s.read.parquet(f"{d}/lineitem.parquet").select("l_returnflag", "l_linestatus", F.col("l_extendedprice").cast("double").alias("v"))
    out = sp.group_quantile(items, ["l_returnflag", "l_linestatus"], "v", 0.9, "q").where("v >= q")
    return out.groupBy("l_returnflag", "l_linestatus", "q").agg(F.count(F.lit(1)).alias("kept")).withColumn("q", F.round("q", 6))


@query("g16_burdens", _OPP + " , n as (select run_id, call_type, call_class, count(*) as num_calls from cls group by all), b as (select run_id, sum(end_pos - start_pos + 1)::bigint as bases from fx_read group by run_id) select run_id, call_type, call_class, num_calls, bases, round(num_calls::double / bases, 12) as burden from n join b using (run_id)")
def g16_burdens(s, d):
    counts = _classified(s, d).groupBy("run_id", "call_type", "call_class").agg(F.count(F.lit(1)).alias("num_calls"))
    out = sp.burdens(counts, iv.total_width(fx.reads(s, d), ["run_id"]), ["run_id"])
    return out.select("run_id", "call_type", "call_class", "num_calls", "bases", F.round("burden", 12).alias("burden"))


@query("g20_detections", _VAR + ", v as (select distinct seqnames, start_pos, end_pos, call_type, alt_code from vars) select v.*, count(distinct (c.run_id, c.zm)) filter (where c.zm is not null) as detections from v left join fx_call c using (seqnames, start_pos, end_pos, call_type, alt_code) group by all")
def g20_detections(s, d):
    on = ["seqnames", "start_pos", "end_pos", "call_type", "alt_code"]
    return sp.detections(_variants(s, d).select(*on).distinct(), fx.calls(s, d), on)


_SENS = _VAR + """, v as (select distinct seqnames, start_pos, end_pos, call_type, alt_code from vars), det as (select v.*, count(distinct (c.run_id, c.zm)) filter (where c.zm is not null) as d, case when alt_code = 1 then 4 else 3 end as cov, alt_code = 2 as het,
 case when v.start_pos % 3 = 0 then 'sex' else 'autosome' end as chromgroup from v left join fx_call c using (seqnames, start_pos, end_pos, call_type, alt_code) group by all),
 sm as (select chromgroup, call_type, sum(d) as d, sum(cov / case when het then 2.0 else 1.0 end) as c from det group by all),
 sens as (select chromgroup, call_type, case when d >= 200 and c > 0 then least(d / c, 1.0) else 1.0 end as sensitivity, case when d >= 200 and c > 0 then 'calculated' else 'default' end as source from sm)"""


def _sens(s, d):
    on = ["seqnames", "start_pos", "end_pos", "call_type", "alt_code"]
    det = sp.detections(_variants(s, d).select(*on).distinct(), fx.calls(s, d), on)
    det = det.withColumns({"coverage": F.when(F.col("alt_code") == 1, 4).otherwise(3), "heterozygous": F.col("alt_code") == 2, "chromgroup": F.when(F.col("start_pos") % 3 == 0, "sex").otherwise("autosome")})
    return sp.sensitivity(det, ["chromgroup", "call_type"], 200)


@query("g21_sensitivity", _SENS + " select chromgroup, call_type, round(sensitivity, 9)::double as sensitivity, source from sens")
def g21_sensitivity(s, d):
    return _sens(s, d).withColumn("sensitivity", F.round("sensitivity", 9))


@query("g22_borrow_sensitivity", _SENS + ", o as (select call_type, min(chromgroup) as og from sens where source = 'calculated' group by 1), o2 as (select o.call_type, o.og, s.sensitivity as os from o join sens s on s.call_type = o.call_type and s.chromgroup = o.og) select chromgroup, s.call_type, round(case when source = 'default' and og is not null then os else sensitivity end, 9)::double as sensitivity, case when source = 'default' and og is not null then 'borrowed from ' || og else source end as source from sens s left join o2 using (call_type)")
def g22_borrow_sensitivity(s, d):
    return sp.borrowed(_sens(s, d), ["call_type"]).select("chromgroup", "call_type", F.round("sensitivity", 9).alias("sensitivity"), "source")


@query("g23_corrected_burdens", _OPP + """, n as (select call_type, call_class, count(*)::double / 1000000 as burden from cls group by all), sn as (select 'SBS' as call_type, 0.81 as s union all select 'insertion', 0.64 union all select 'deletion', 0.49)
 select call_type, call_class, round(burden, 9) as burden, false as sensitivity_corrected from n union all select call_type, call_class, round(burden / case when call_class like 'mismatch%' then sqrt(s) else s end, 9), true from n join sn using (call_type)""")
def g23_corrected_burdens(s, d):
    sens = s.createDataFrame([("SBS", 0.81), ("insertion", 0.64), ("deletion", 0.49)], "call_type string, sensitivity double")
    n = _classified(s, d).groupBy("call_type", "call_class").agg((F.count(F.lit(1)).cast("double") / 1000000).alias("burden"))
    return sp.corrected_burdens(n, sens, ["call_type"]).withColumn("burden", F.round("burden", 9))


@query("g19_high_confidence", """v as (select distinct seqnames, start_pos, end_pos, alt_code, 'vcf' || (zm % 2)::varchar as source, 10 + (start_pos * 7) % 50 as depth, 20 + (start_pos * 13) % 60 as qual from fx_call where call_type = 'SBS'),
 q as (select source, quantile_cont(depth::double, 0.1) as dl, quantile_cont(depth::double, 0.9) as dh, quantile_cont(qual::double, 0.1) as ql, quantile_cont(qual::double, 0.9) as qh from v group by 1)
 select seqnames, start_pos, end_pos, alt_code from v join q using (source) where depth between dl and dh and qual between ql and qh group by all having count(distinct source) = 2""")
def g19_high_confidence(s, d):
    p = F.col("start_pos")
    v = fx.calls(s, d).where("call_type = 'SBS'").select("seqnames", "start_pos", "end_pos", "alt_code", F.concat(F.lit("vcf"), F.col("zm") % 2).alias("source"), (10 + p * 7 % 50).alias("depth"), (20 + p * 13 % 60).alias("qual")).distinct()
    return sp.high_confidence(v, 2, 0.1)


@query("g19_high_confidence_shared", """k as (select distinct seqnames, start_pos, end_pos, alt_code from fx_call where call_type = 'SBS'),
 v as (select k.*, 'vcf' || i.i::varchar as source, 10 + (start_pos * (7 + 2 * i.i)) % 50 as depth, 20 + (start_pos * (13 + 4 * i.i)) % 60 as qual from k, (select 0 as i union all select 1 union all select 2) i where start_pos % 4 <> i.i),
 q as (select source, quantile_cont(depth::double, 0.1) as dl, quantile_cont(depth::double, 0.9) as dh, quantile_cont(qual::double, 0.1) as ql, quantile_cont(qual::double, 0.9) as qh from v group by 1)
 select seqnames, start_pos, end_pos, alt_code from v join q using (source) where depth between dl and dh and qual between ql and qh group by all having count(distinct source) = 3""")
def g19_high_confidence_shared(s, d):
    """Three sources that share most sites: those sites within the quantiles of all three."""
    p, i = F.col("start_pos"), F.col("i")
    sites = fx.calls(s, d).where("call_type = 'SBS'").select("seqnames", "start_pos", "end_pos", "alt_code").distinct()
    v = sites.withColumn("i", F.explode(F.array(*(F.lit(k) for k in range(3))))).where(p % 4 != i)
    return sp.high_confidence(v.select("seqnames", "start_pos", "end_pos", "alt_code", F.concat(F.lit("vcf"), i).alias("source"), (10 + p * (7 + 2 * i) % 50).alias("depth"), (20 + p * (13 + 4 * i) % 60).alias("qual")), 3, 0.1)


_CHANNELS = f"""{_SBS}, {_TNC}, cn as (select t || '>' || a as channel, count(*)::double / 100000 as burden from ch group by 1), sh as (select tnc, n::double / (select sum(n) from t64) as share from t64)"""


@query("g24_error_probability", _CHANNELS + f" select x.channel, round(x.burden * y.burden * (s1.share + s2.share) * 1e6, 9) as error from cn x join cn y on y.channel = {_RC.format('substr(x.channel, 1, 3)')} || '>' || {_RC.format('substr(x.channel, 5, 3)')} join sh s1 on s1.tnc = substr(x.channel, 1, 3) join sh s2 on s2.tnc = substr(y.channel, 1, 3) where substr(x.channel, 2, 1) in ('C', 'T')")
def g24_error_probability(s, d):
    burden = _sbs(s, d).where("reftnc IS NOT NULL").groupBy(F.concat_ws(">", "reftnc", "alttnc").alias("channel")).agg((F.count(F.lit(1)).cast("double") / 100000).alias("burden"))
    n = gn.trinucleotide_counts(fx.contigs(s, d))
    shares = n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("t")))).select("tnc", (F.col("n").cast("double") / F.col("t")).alias("share"))
    return sp.error_probability(burden, shares).withColumn("error", F.round(F.col("error") * 1e6, 9))


@query("g18_by_orientation", "o as (select *, case when strand = '+' then 'a-b' else 'b-a' end as bc_orientation from fx_call) select call_type, bc_orientation, count(*) as calls from o group by all union all select call_type, 'all_bc_orientations', count(*) from o group by all")
def g18_by_orientation(s, d):
    c = fx.calls(s, d).withColumn("bc_orientation", F.when(F.col("strand") == "+", "a-b").otherwise("b-a"))
    both = c.unionByName(c.withColumn("bc_orientation", F.lit("all_bc_orientations")))
    return both.groupBy("call_type", "bc_orientation").agg(F.count(F.lit(1)).alias("calls"))


def g17_poisson_intervals(s, d):
    """Exact intervals have no SQL; the tests hold them against known values."""
    counts = fx.calls(s, d).groupBy("seqnames", "call_type").agg(F.count(F.lit(1)).alias("num_calls"))
    return sp.poisson_ci(counts, "num_calls")


QUERIES["g17_poisson_intervals"] = g17_poisson_intervals
