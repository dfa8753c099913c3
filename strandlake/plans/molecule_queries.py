"""Queries of reads, molecules, barcodes and the genome table, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequences as sq
from ..operators import genome as gn
from ..operators import intervals as iv
from ..operators import molecules as ml
from . import fixtures as fx
from .interval_queries import _RUNS

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name], SQL[name] = f, fx.with_views(sql)
        return f

    return keep


@query("e1_pair_filter", "SELECT r.run_id, r.zm, r.strand, r.seqnames, r.start_pos, r.end_pos from fx_read r where (r.run_id, r.zm) in (select run_id, zm from fx_read where mapq >= 60 group by run_id, zm having count(*) = 2 and count(*) filter (where strand = '+') = 1 and min(seqnames) = max(seqnames))")
def e1_pair_filter(s, d):
    return ml.pair_filter(fx.reads(s, d).where("mapq >= 60")).select("run_id", "zm", "strand", "seqnames", "start_pos", "end_pos")


@query("d6_strand_overlap", "SELECT a.run_id, a.zm, round(greatest(least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) + 1, 0)::double / greatest(a.end_pos - a.start_pos + 1, b.end_pos - b.start_pos + 1), 9) as overlap from fx_read a join fx_read b on a.run_id = b.run_id and a.zm = b.zm and a.strand = '+' and b.strand = '-' where greatest(least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) + 1, 0)::double / greatest(a.end_pos - a.start_pos + 1, b.end_pos - b.start_pos + 1) >= 0.97")
def d6_strand_overlap(s, d):
    return ml.min_strand_overlap(fx.reads(s, d), 0.97).withColumn("overlap", F.round("overlap", 9))


@query("b6_count_molecules", "SELECT 'reads' as stage, count(distinct (run_id, zm)) as molecules from fx_read union all select 'high_mapq', count(distinct (run_id, zm)) from fx_read where mapq >= 60 union all select 'with_calls', count(distinct (run_id, zm)) from fx_call")
def b6_count_molecules(s, d):
    r = fx.reads(s, d)
    return ml.count_molecules({"reads": r, "high_mapq": r.where("mapq >= 60"), "with_calls": fx.calls(s, d)})


@query("b7_assign_chunk", "SELECT run_id, zm, ntile(60) over (order by run_id, zm)::bigint as chunk from (select distinct run_id, zm from fx_read) t")
def b7_assign_chunk(s, d):
    return ml.assign_chunk(fx.reads(s, d), 60)


_GROUPS = "groups as (select case when contig_idx % 3 = 0 then 'sex' else 'autosome' end as chromgroup, seqnames from fx_contig where contig_idx % 5 <> 0)"


def _groups(s, d):
    return fx.contigs(s, d).where("contig_idx % 5 <> 0").select(F.when(F.col("contig_idx") % 3 == 0, "sex").otherwise("autosome").alias("chromgroup"), "seqnames")


_STATS = _GROUPS + """, lab as (select * from groups union all select 'all_chromgroups', seqnames from groups), ev as (
 select r.run_id, l.chromgroup, r.zm, r.end_pos - r.start_pos + 1 as b from fx_read r join lab l using (seqnames) union all select run_id, 'all_chroms', zm, end_pos - start_pos + 1 from fx_read),
 st as (select run_id, chromgroup, count(distinct zm) as molecules, sum(b)::bigint as bases from ev group by all),
 stats as (select run_id, chromgroup, 'molecules' as stat, molecules as value from st union all select run_id, chromgroup, 'bases', bases from st)"""


@query("e2_molecule_stats", _STATS + " select * from stats")
def e2_molecule_stats(s, d):
    return ml.molecule_stats(fx.reads(s, d), _groups(s, d))


@query("e5_summed_stats", _STATS + " select run_id, chromgroup, stat, value from stats union all select 'all_runs', chromgroup, stat, sum(value)::bigint from stats group by chromgroup, stat")
def e5_summed_stats(s, d):
    return ml.summed_stats(ml.molecule_stats(fx.reads(s, d), _groups(s, d)))


@query("e3_filter_stats", """SELECT run_id, f.filter, count(distinct case when f.ok then zm end) as molecules, coalesce(sum(case when f.ok then end_pos - start_pos + 1 end), 0)::bigint as bases from fx_read,
 lateral (select 'rq' as filter, rq >= 0.97 as ok union all select 'mapq', mapq >= 60 union all select 'all_filters', rq >= 0.97 and mapq >= 60) f group by run_id, f.filter""")
def e3_filter_stats(s, d):
    return ml.filter_stats(fx.reads(s, d), {"rq": F.col("rq") >= 0.97, "mapq": F.col("mapq") >= 60})


@query("e4_tracker_stats", """SELECT run_id, count(distinct zm) as molecules, sum(least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) + 1)::bigint as bases from (
 select run_id, zm, max(start_pos) as start_pos, min(end_pos) as end_pos from fx_read group by run_id, zm) a join (select run_id, zm, max(start_pos) as start_pos, min(end_pos) as end_pos from fx_read group by run_id, zm) b using (run_id, zm) where a.start_pos <= a.end_pos group by run_id""")
def e4_tracker_stats(s, d):
    r = fx.reads(s, d).select("run_id", "zm", "seqnames", "strand", "start_pos", "end_pos")
    keys = ["run_id", "zm", "seqnames"]
    left = iv.duplex(r, keys).where("strand = '+'")
    return left.groupBy("run_id").agg(F.countDistinct("zm").alias("molecules"), F.sum(iv.width()).alias("bases"))


@query("b2_canonical_pair", "SELECT zm, strand, case when a = b then a when a < b then a || '-' || b else b || '-' || a end as pair from (select zm, strand, 'bc' || (zm % 7)::varchar as a, 'bc' || (ec % 5)::varchar as b from fx_read) t")
def b2_canonical_pair(s, d):
    return fx.reads(s, d).select("zm", "strand", F.concat(F.lit("bc"), F.col("zm") % 7).alias("a"), F.concat(F.lit("bc"), F.col("ec") % 5).alias("b")).select("zm", "strand", sq.canonical_pair("a", "b").alias("pair"))


_SHEET = "sheet as (select distinct 'run' || (o_orderkey % 2)::varchar as run_id, case when a = b then a when a < b then a || '-' || b else b || '-' || a end as pair, 's' || (o_orderkey % 7)::varchar as sample from (select o_orderkey, 'bc' || (o_orderkey % 7)::varchar as a, 'bc' || (o_orderkey % 5)::varchar as b from orders where o_orderkey % 4 <> 3) t)"


def _sheet(s, d):
    k = F.col("o_orderkey")
    o = s.read.parquet(f"{d}/orders.parquet").where("o_orderkey % 4 <> 3")
    return o.select(F.concat(F.lit("run"), k % 2).alias("run_id"), sq.canonical_pair(F.concat(F.lit("bc"), k % 7), F.concat(F.lit("bc"), k % 5)).alias("pair"), F.concat(F.lit("s"), k % 7).alias("sample")).distinct()


@query("b3_assign_samples", _SHEET + " select s.sample, count(*) as reads from (select run_id, case when a = b then a when a < b then a || '-' || b else b || '-' || a end as pair from (select run_id, 'bc' || (zm % 7)::varchar as a, 'bc' || (ec % 5)::varchar as b from fx_read) t) r join sheet s using (run_id, pair) group by s.sample")
def b3_assign_samples(s, d):
    r = fx.reads(s, d).withColumns({"bc_a": F.concat(F.lit("bc"), F.col("zm") % 7), "bc_b": F.concat(F.lit("bc"), F.col("ec") % 5)})
    return ml.assign_samples(r, _sheet(s, d)).groupBy("sample").agg(F.count(F.lit(1)).alias("reads"))


@query("b4_sheet_violations", _SHEET + """, known as (select 'bc' || i::varchar as barcode from generate_series(0, 4) t(i))
 select 'unknown' as rule, run_id, barcode as detail from (select distinct run_id, unnest(string_split(pair, '-')) as barcode from sheet) u where barcode not in (select barcode from known)
 union all select 'conflict', run_id, pair from sheet group by run_id, pair having count(distinct sample) > 1""")
def b4_sheet_violations(s, d):
    return ml.sheet_violations(_sheet(s, d), s.range(5).select(F.concat(F.lit("bc"), "id").alias("barcode")))


@query("f1_molecule_quality", "SELECT run_id, zm, strand, min(rq) over w >= 0.96 as rq_each, avg(rq) over w >= 0.96 as rq_avg, min(mapq) over w >= 60 as mapq_each, avg(mapq) over w >= 60 as mapq_avg from fx_read window w as (partition by run_id, zm)")
def f1_molecule_quality(s, d):
    return ml.molecule_quality(fx.reads(s, d), {"rq": 0.96, "mapq": 60}).select("run_id", "zm", "strand", "rq_each", "rq_avg", "mapq_each", "mapq_avg")


@query("f2_max_calls", "SELECT m.run_id, m.zm, coalesce(greatest(p, q) <= 2, true) as max_calls, coalesce(abs(p - q) <= 1, true) as strand_difference from (select distinct run_id, zm from fx_read) m left join (select run_id, zm, count(*) filter (where strand = '+') as p, count(*) filter (where strand = '-') as q from fx_call where call_type = 'SBS' group by run_id, zm) c on c.run_id = m.run_id and c.zm = m.zm")
def f2_max_calls(s, d):
    return ml.max_calls(fx.reads(s, d), fx.calls(s, d).where("call_type = 'SBS'"), 2, 1)


@query("f19_max_final_calls", "SELECT c.run_id, c.zm, c.strand, c.call_type, c.start_pos, c.end_pos from fx_call c where not exists (select 1 from (select run_id, zm, call_type, strand from fx_call group by all having count(*) > 1) b where b.run_id = c.run_id and b.zm = c.zm and b.call_type = c.call_type)")
def f19_max_final_calls(s, d):
    return ml.max_final_calls(fx.calls(s, d), 1, ["call_type"]).select("run_id", "zm", "strand", "call_type", "start_pos", "end_pos")


@query("d10_drop_molecules", "SELECT count(*) as reads, count(distinct zm) as molecules from fx_read r where not exists (select 1 from fx_call c where c.call_type = 'deletion' and c.run_id = r.run_id and c.zm = r.zm)")
def d10_drop_molecules(s, d):
    return ml.drop_molecules(fx.reads(s, d), fx.calls(s, d).where("call_type = 'deletion'")).agg(F.count(F.lit(1)).alias("reads"), F.countDistinct("zm").alias("molecules"))


_TNC = "t64 as (select tnc, count(*) as n from (select substr(seq, p - 1, 3) as tnc from (select seq, unnest(generate_series(2, len - 1)) as p from fx_contig) x) y group by tnc)"
_RC = "translate(reverse({0}), 'ACGT', 'TGCA')"
_PYR = "case when substr({0}, 2, 1) in ('C', 'T') then {0} else " + _RC + " end"


@query("e16_genome_trinucleotides", _TNC + " select tnc, n from t64")
def e16_genome_trinucleotides(s, d):
    return gn.trinucleotide_counts(fx.contigs(s, d))


@query("e14_to_pyrimidines", _TNC + f" select {_PYR.format('tnc')} as tnc, sum(n)::bigint as n from t64 group by 1")
def e14_to_pyrimidines(s, d):
    return gn.to_pyrimidines(gn.trinucleotide_counts(fx.contigs(s, d)))


@query("e15_both_strands", _TNC + f" select tnc, sum(n)::bigint as n from (select tnc, n from t64 union all select {_RC.format('tnc')}, n from t64) u group by tnc")
def e15_both_strands(s, d):
    return gn.both_strands(gn.trinucleotide_counts(fx.contigs(s, d)))


_AT = "substr(repeat('N', 20) || g.seq || repeat('N', 20), (c.start_pos + 20 - {0})::int, {1})"


@query("c10_trinucleotides", f"SELECT c.run_id, c.zm, c.strand, c.call_type, c.start_pos, c.end_pos, case when t not like '%N%' then t end as reftnc, case when t not like '%N%' then {_PYR.format('t')} end as reftnc_pyr from (select c.*, {_AT.format(1, 3)} as t from fx_call c join fx_contig g using (seqnames) where c.call_type = 'SBS') c")
def c10_trinucleotides(s, d):
    return gn.trinucleotides(fx.calls(s, d).where("call_type = 'SBS'"), gn.tiled(fx.contigs(s, d))).select("run_id", "zm", "strand", "call_type", "start_pos", "end_pos", "reftnc", "reftnc_pyr")


@query("g10_context", f"SELECT c.run_id, c.zm, c.strand, c.call_type, c.start_pos, c.end_pos, {_AT.format(10, 21)} as context from fx_call c join fx_contig g using (seqnames)")
def g10_context(s, d):
    return gn.context(fx.calls(s, d), gn.tiled(fx.contigs(s, d)), 10, 10).select("run_id", "zm", "strand", "call_type", "start_pos", "end_pos", "context")


@query("d15_unknown_regions", "base as (select seqnames, p from (select seqnames, translate(seq, 'ACGT', 'ACNT') as q, unnest(generate_series(1, len)) as p from fx_contig where contig_idx % 10 = 0) x where substr(q, p::int, 1) = 'N'), isl as (select seqnames, p, p - row_number() over (partition by seqnames order by p) as g from base) select seqnames, min(p) as start_pos, max(p) as end_pos from isl group by seqnames, g")
def d15_unknown_regions(s, d):
    some = fx.contigs(s, d).where("contig_idx % 10 = 0").withColumn("seq", F.translate("seq", "G", "N"))
    return gn.unknown_regions(some)


@query("e17_weighted_trinucleotides", _RUNS + " select substr(g.seq, (p - 1)::int, 3) as tnc, sum(depth)::bigint as n from (select seqnames, depth, unnest(generate_series(start_pos, end_pos)) as p from runs) r join fx_contig g using (seqnames) where p > 1 and p < g.len group by 1")
def e17_weighted_trinucleotides(s, d):
    return gn.weighted_trinucleotides(iv.duplex_coverage(fx.reads(s, d)), gn.tiled(fx.contigs(s, d)))


_BY = "v as (select seqnames, strand, case when (strand = '+') = (zm % 2 = 0) then 'a-b' else 'b-a' end as bc_orientation, start_pos, end_pos from fx_read)"


@query("e8_coverage_by_bc", _BY + """, ev as (select seqnames, strand, bc_orientation, start_pos as pos, 1 as d from v union all select seqnames, strand, bc_orientation, end_pos + 1, -1 from v),
 ev2 as (select seqnames, strand, bc_orientation, pos, sum(d) as d from ev group by all having sum(d) <> 0)
 select * from (select seqnames, strand, bc_orientation, pos as start_pos, lead(pos) over w - 1 as end_pos, (sum(d) over (w rows unbounded preceding))::bigint as depth from ev2 window w as (partition by seqnames, strand, bc_orientation order by pos)) t where depth > 0""")
def e8_coverage_by_bc(s, d):
    return iv.coverage(_by_bc(s, d), ["seqnames", "strand", "bc_orientation"])


def _by_bc(s, d):
    return fx.reads(s, d).withColumn("bc_orientation", F.when((F.col("strand") == "+") == (F.col("zm") % 2 == 0), "a-b").otherwise("b-a"))


@query("e17_oriented_trinucleotides", _BY + f", b as (select v.strand, bc_orientation, substr(g.seq, (p - 1)::int, 3) as t from (select seqnames, strand, bc_orientation, unnest(generate_series(start_pos, end_pos)) as p from v) v join fx_contig g using (seqnames) where p > 1 and p < g.len) select bc_orientation, case when strand = '+' then {_RC.format('t')} else t end as tnc, count(*) as n from b group by all")
def e17_oriented_trinucleotides(s, d):
    """Interrogated trinucleotides on the template strand, by barcode orientation."""
    return gn.oriented_trinucleotides(iv.coverage(_by_bc(s, d), ["seqnames", "strand", "bc_orientation"]), gn.tiled(fx.contigs(s, d)))


_CIGAR = "(zm % 9 + 3)::varchar || 'S' || (ec + 30)::varchar || '=' || (zm % 4 + 1)::varchar || 'X' || (zm % 6 + 1)::varchar || 'I' || '50=' || (zm % 5 + 1)::varchar || 'D' || '40='"


@query("c1_cigar_ranges", f"""ops as (select zm, strand, start_pos, t.i, regexp_extract(t.o, '[A-Z=]') as op, regexp_extract(t.o, '[0-9]+')::bigint as len from (select zm, strand, start_pos, regexp_extract_all({_CIGAR}, '[0-9]+[MIDNSHP=X]') as l from fx_read) x, lateral (select unnest(l) as o, generate_subscripts(l, 1) as i) t),
 pos as (select *, coalesce(sum(case when op in ('M','I','S','=','X') then len end) over w, 0) + 1 as q, coalesce(sum(case when op in ('M','D','N','=','X') then len end) over w, 0) + start_pos as r from ops window w as (partition by zm, strand order by i rows between unbounded preceding and 1 preceding))
 select zm, strand, op, len, q::bigint as q_start, (q + case when op in ('M','I','S','=','X') then len else 0 end - 1)::bigint as q_end, r::bigint as r_start, (r + case when op in ('M','D','N','=','X') then len else 0 end - 1)::bigint as r_end from pos""")
def c1_cigar_ranges(s, d):
    z = F.col("zm")
    cigar = F.concat((z % 9 + 3).cast("string"), F.lit("S"), (F.col("ec") + 30).cast("string"), F.lit("="), (z % 4 + 1).cast("string"), F.lit("X"), (z % 6 + 1).cast("string"), F.lit("I50="), (z % 5 + 1).cast("string"), F.lit("D40="))
    return fx.reads(s, d).select("zm", "strand", F.explode(sq.cigar_ranges(cigar, "start_pos")).alias("o")).select("zm", "strand", "o.*")


@query("b9_rle_decode", "SELECT zm, strand, array_to_string(list_concat(list_resize([]::int[], (zm % 4 + 1)::bigint, (ec % 100)::int), list_resize([]::int[], (zm % 3)::bigint, 7)), ',') as sa from fx_read")
def b9_rle_decode(s, d):
    pairs = F.array((F.col("zm") % 4 + 1).cast("int"), (F.col("ec") % 100).cast("int"), (F.col("zm") % 3).cast("int"), F.lit(7))
    return fx.reads(s, d).select("zm", "strand", F.array_join(sq.rle_decode(pairs).cast("array<string>"), ",").alias("sa"))


@query("b10_orient_arrays", "SELECT zm, strand, array_to_string(case when strand = '-' then [3, (ec % 50)::int, 1] else [1, (ec % 50)::int, 3] end, ',') as sa from fx_read")
def b10_orient_arrays(s, d):
    sa = F.array(F.lit(1), (F.col("ec") % 50).cast("int"), F.lit(3))
    return fx.reads(s, d).withColumn("sa", sa).select("zm", "strand", F.array_join(sq.oriented("sa", "strand").cast("array<string>"), ",").alias("sa"))


@query("e23_array_thresholds", "SELECT zm, strand, least(ec % 50, zm % 40, 30) >= 5 as all_pass, greatest(ec % 50, zm % 40, 30) >= 45 as any_pass, (ec % 50 + zm % 40 + 30) / 3.0 >= 25 as mean_pass from fx_read")
def e23_array_thresholds(s, d):
    q = F.array((F.col("ec") % 50).cast("double"), (F.col("zm") % 40).cast("double"), F.lit(30.0))
    r = fx.reads(s, d).withColumn("q", q)
    return r.select("zm", "strand", sq.array_passes("q", 5, "all").alias("all_pass"), sq.array_passes("q", 45, "any").alias("any_pass"), sq.array_passes("q", 25, "mean").alias("mean_pass"))
