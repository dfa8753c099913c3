"""Queries of the interval operators, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as iv
from . import fixtures as fx

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name], SQL[name] = f, fx.with_views(sql)
        return f

    return keep


#: Merged regions, as gaps and islands.
_MASK = """mask as (select seqnames, min(start_pos) as start_pos, max(end_pos) as end_pos from (
 select *, sum(new) over (partition by seqnames order by start_pos, end_pos rows unbounded preceding) as g from (
  select seqnames, start_pos, end_pos, case when start_pos <= max(end_pos) over (partition by seqnames order by start_pos, end_pos rows between unbounded preceding and 1 preceding) + 1 then 0 else 1 end as new from fx_region) a) b
 group by seqnames, g)"""
_PLUS = "fx_read where strand = '+'"


def _interval_calls(s, d):
    return fx.calls(s, d).select("run_id", "zm", "strand", "seqnames", "call_type", "start_pos", "end_pos")


@query("d1_overlaps_any", """SELECT c.run_id, c.zm, c.strand, c.seqnames, c.call_type, c.start_pos, c.end_pos,
exists (select 1 from fx_region r where r.seqnames = c.seqnames and c.start_pos <= r.end_pos and c.end_pos >= r.start_pos) as hit from fx_call c""")
def d1_overlaps_any(s, d):
    return iv.overlaps_any(_interval_calls(s, d), fx.regions(s, d))


@query("d1_overlaps_adjacent", """SELECT c.run_id, c.zm, c.strand, c.call_type, c.start_pos, c.end_pos,
exists (select 1 from fx_region r where r.seqnames = c.seqnames and ((c.start_pos <= r.end_pos and c.end_pos >= r.start_pos)
 or (c.start_pos = c.end_pos + 1 and r.start_pos <= r.end_pos and c.start_pos <= r.end_pos + 1 and c.end_pos >= r.start_pos - 1))) as hit from fx_call c""")
def d1_overlaps_adjacent(s, d):
    return iv.overlaps_any(_interval_calls(s, d), fx.regions(s, d), adjacent=True).drop("seqnames")


@query("d2_restrict_variants", """SELECT distinct c.seqnames, c.start_pos, c.end_pos, c.call_type from fx_call c
where exists (select 1 from fx_region r where r.seqnames = c.seqnames and c.start_pos <= r.end_pos and c.end_pos >= r.start_pos)""")
def d2_restrict_variants(s, d):
    return iv.restrict(fx.calls(s, d).select("seqnames", "start_pos", "end_pos", "call_type").distinct(), fx.regions(s, d))


@query("d3_subtract", _MASK + """, pairs as (select r.zm, r.run_id, r.seqnames, r.start_pos as s, r.end_pos as e, m.start_pos as ms, m.end_pos as me from (select * from """ + _PLUS + """) r
 join mask m on m.seqnames = r.seqnames and r.start_pos <= m.end_pos and r.end_pos >= m.start_pos),
 cuts as (select zm, run_id, seqnames, s, e, me + 1 as ps, coalesce(lead(ms) over (partition by run_id, zm order by ms) - 1, e) as pe from pairs
  union all select zm, run_id, seqnames, s, e, s, min(ms) - 1 from pairs group by zm, run_id, seqnames, s, e
  union all select zm, run_id, seqnames, start_pos, end_pos, start_pos, end_pos from fx_read r where strand = '+' and not exists (select 1 from pairs p where p.zm = r.zm and p.run_id = r.run_id))
 select run_id, zm, seqnames, ps as start_pos, pe as end_pos from cuts where ps <= pe""")
def d3_subtract(s, d):
    plus = fx.reads(s, d).where("strand = '+'").select("run_id", "zm", "seqnames", "start_pos", "end_pos")
    return iv.subtract(plus, fx.regions(s, d).select("seqnames", "start_pos", "end_pos"))


@query("d4_subtract_keyed", """SELECT p.run_id, p.zm, p.seqnames, case when m.zm is not null and m.start_pos <= p.start_pos then m.end_pos + 1 else p.start_pos end as start_pos,
 case when m.zm is not null and m.start_pos > p.start_pos then m.start_pos - 1 else p.end_pos end as end_pos
from (select * from fx_read where strand = '+') p left join (select run_id, zm, seqnames, start_pos, end_pos from fx_read where strand = '-') m
 on m.run_id = p.run_id and m.zm = p.zm and m.start_pos <= p.end_pos and m.end_pos >= p.start_pos
where (m.zm is null or (m.start_pos <= p.start_pos and m.end_pos < p.end_pos) or (m.start_pos > p.start_pos and m.end_pos >= p.end_pos))
union all select p.run_id, p.zm, p.seqnames, x.s, x.e from (select * from fx_read where strand = '+') p join (select * from fx_read where strand = '-') m on m.run_id = p.run_id and m.zm = p.zm
 and m.start_pos > p.start_pos and m.end_pos < p.end_pos, lateral (select p.start_pos as s, m.start_pos - 1 as e union all select m.end_pos + 1, p.end_pos) x""")
def d4_subtract_keyed(s, d):
    r = fx.reads(s, d)
    own = ["run_id", "zm", "seqnames", "start_pos", "end_pos"]
    return iv.subtract(r.where("strand = '+'").select(*own), r.where("strand = '-'").select(*own), ["run_id", "zm", "seqnames"])


@query("d5_merge", _MASK + " select seqnames, start_pos, end_pos from mask")
def d5_merge(s, d):
    return iv.merge(fx.regions(s, d))


@query("d7_pad_clip", """SELECT r.seqnames, greatest(r.start_pos - 25, 1) as start_pos, least(r.end_pos + 25, c.len) as end_pos, r.score from fx_region r join fx_contig c using (seqnames)""")
def d7_pad_clip(s, d):
    return iv.pad(fx.regions(s, d), 25, fx.lengths(s, d))


@query("d7_flanks", """SELECT seqnames, greatest(start_pos - 10, 1) as start_pos, start_pos - 1 as end_pos, 'left' as side from fx_region
union all select seqnames, end_pos + 1, end_pos + 10, 'right' from fx_region""")
def d7_flanks(s, d):
    r = fx.regions(s, d).drop("score")
    return iv.flank(r, 10, "left").withColumn("side", F.lit("left")).unionAll(iv.flank(r, 10, "right").withColumn("side", F.lit("right")))


@query("d8_pad_by_length", """SELECT run_id, zm, strand, greatest(start_pos - greatest(2 * w, 5), 1) as start_pos, end_pos + greatest(2 * w, 5) as end_pos from fx_call where call_type <> 'SBS'""")
def d8_pad_by_length(s, d):
    c = fx.calls(s, d).where("call_type <> 'SBS'")
    return iv.pad(c, iv.pad_of_spec("m2b5", F.col("w"))).select("run_id", "zm", "strand", "start_pos", "end_pos")


@query("d9_non_duplex", """SELECT run_id, zm, strand, sum(bases)::bigint as bases from (
 select a.run_id, a.zm, a.strand, (a.end_pos - a.start_pos + 1) - greatest(0, least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) + 1) as bases
 from fx_read a join fx_read b on a.run_id = b.run_id and a.zm = b.zm and a.strand <> b.strand) t where bases > 0 group by run_id, zm, strand""")
def d9_non_duplex(s, d):
    own = ["run_id", "zm", "seqnames"]
    return iv.total_width(iv.non_duplex(fx.reads(s, d).select(*own, "strand", "start_pos", "end_pos"), own), ["run_id", "zm", "strand"])


@query("d14_total_width", "SELECT strand, sum(end_pos - start_pos + 1)::bigint as bases from fx_read group by strand")
def d14_total_width(s, d):
    return iv.total_width(fx.reads(s, d), ["strand"])


_RUNS = """ev as (select seqnames, start_pos as pos, 1 as d from fx_read where strand = '+' union all select seqnames, end_pos + 1, -1 from fx_read where strand = '+'),
 ev2 as (select seqnames, pos, sum(d) as d from ev group by seqnames, pos having sum(d) <> 0),
 runs as (select * from (select seqnames, pos as start_pos, lead(pos) over (partition by seqnames order by pos) - 1 as end_pos, sum(d) over (partition by seqnames order by pos rows unbounded preceding)::bigint as depth from ev2) t where depth > 0)"""


@query("e6_coverage", _RUNS.replace(" where strand = '+'", "") + " select seqnames, start_pos, end_pos, depth from runs")
def e6_coverage(s, d):
    return iv.coverage(fx.reads(s, d))


@query("e7_duplex_coverage", _RUNS + " select seqnames, start_pos, end_pos, depth from runs")
def e7_duplex_coverage(s, d):
    return iv.duplex_coverage(fx.reads(s, d))


@query("e7_odd_depth", _RUNS.replace(" where strand = '+'", "") + " select count(*) as runs, sum(end_pos - start_pos + 1)::bigint as bases from runs where depth % 2 = 1")
def e7_odd_depth(s, d):
    return iv.odd_depth(fx.reads(s, d)).agg(F.count(F.lit(1)).alias("runs"), F.sum(iv.width()).alias("bases"))


@query("e8_coverage_by_strand", """SELECT strand, run_id, sum(end_pos - start_pos + 1)::bigint as bases from fx_read group by strand, run_id""")
def e8_coverage_by_strand(s, d):
    runs = iv.coverage(fx.reads(s, d), ["strand", "run_id", "seqnames"])
    return runs.groupBy("strand", "run_id").agg(F.sum(F.col("depth") * iv.width()).alias("bases"))


@query("e9_coverage_at", _RUNS + """ select c.run_id, c.zm, c.strand, c.call_type, c.start_pos, c.end_pos,
 least(coalesce((select depth from runs r where r.seqnames = c.seqnames and r.start_pos <= least(c.start_pos, c.end_pos) and r.end_pos >= least(c.start_pos, c.end_pos)), 0),
 coalesce((select depth from runs r where r.seqnames = c.seqnames and r.start_pos <= greatest(c.start_pos, c.end_pos) and r.end_pos >= greatest(c.start_pos, c.end_pos)), 0)) as depth from fx_call c""")
def e9_coverage_at(s, d):
    return iv.coverage_at(_interval_calls(s, d), iv.duplex_coverage(fx.reads(s, d))).select("run_id", "zm", "strand", "call_type", "start_pos", "end_pos", "depth")


@query("e10_covered_fraction", _MASK + """ select r.run_id, r.zm, round(avg(coalesce(c.n, 0)::double / (r.end_pos - r.start_pos + 1)), 9) as fraction from fx_read r
 left join (select r.seqnames, r.start_pos, r.end_pos, sum(least(r.end_pos, m.end_pos) - greatest(r.start_pos, m.start_pos) + 1) as n
  from (select distinct seqnames, start_pos, end_pos from fx_read) r join mask m on m.seqnames = r.seqnames and r.start_pos <= m.end_pos and r.end_pos >= m.start_pos group by all) c
 on c.seqnames = r.seqnames and c.start_pos = r.start_pos and c.end_pos = r.end_pos group by r.run_id, r.zm""")
def e10_covered_fraction(s, d):
    return iv.covered_fraction(fx.reads(s, d), fx.regions(s, d)).groupBy("run_id", "zm").agg(F.round(F.avg("fraction"), 9).alias("fraction"))


_BINS = """cover as (select seqnames, start_pos, end_pos, depth from runs),
 grid as (select seqnames, len, unnest(generate_series(0, (len - 1) // 100)) as b from fx_contig),
 bins as (select g.seqnames, g.b * 100 + 1 as start_pos, least((g.b + 1) * 100, g.len) as end_pos,
  coalesce(sum(c.depth * (least(c.end_pos, (g.b + 1) * 100) - greatest(c.start_pos, g.b * 100 + 1) + 1)), 0)::double / (least((g.b + 1) * 100, g.len) - g.b * 100) as score
  from grid g left join cover c on c.seqnames = g.seqnames and c.start_pos <= (g.b + 1) * 100 and c.end_pos >= g.b * 100 + 1 group by g.seqnames, g.b, g.len)"""


@query("e11_binned_track", _RUNS + ", " + _BINS + " select seqnames, start_pos, end_pos, round(score, 9) as score from bins")
def e11_binned_track(s, d):
    track = iv.duplex_coverage(fx.reads(s, d)).withColumn("score", F.col("depth").cast("double"))
    cut = iv.intersect(track.select("seqnames", "start_pos", "end_pos", "score"), fx.lengths(s, d).select("seqnames", F.lit(1).alias("start_pos"), F.col("len").alias("end_pos")))
    return iv.binned_track(cut, fx.lengths(s, d), 100).withColumn("score", F.round("score", 9))


@query("e11_threshold_track", _RUNS + ", " + _BINS + """, low as (select *, case when start_pos = lag(end_pos) over (partition by seqnames order by start_pos) + 1 then 0 else 1 end as new from bins where score < 2),
 isl as (select *, sum(new) over (partition by seqnames order by start_pos rows unbounded preceding) as g from low)
 select seqnames, min(start_pos) as start_pos, max(end_pos) as end_pos from isl group by seqnames, g""")
def e11_threshold_track(s, d):
    track = iv.duplex_coverage(fx.reads(s, d)).withColumn("score", F.col("depth").cast("double")).drop("depth")
    return iv.threshold_track(track, fx.lengths(s, d), 100, "lt", 2.0)


_LOW = """edges as (select seqnames, start_pos, end_pos from runs where depth >= 2),
 m2 as (select seqnames, min(start_pos) as start_pos, max(end_pos) as end_pos from (select *, sum(new) over (partition by seqnames order by start_pos rows unbounded preceding) as g from (
  select *, case when start_pos <= lag(end_pos) over (partition by seqnames order by start_pos) + 1 then 0 else 1 end as new from edges) a) b group by seqnames, g),
 gaps as (select c.seqnames, coalesce(lag(m.end_pos) over (partition by c.seqnames order by m.start_pos) + 1, 1) as start_pos, m.start_pos - 1 as end_pos from fx_contig c join m2 m using (seqnames)
  union all select c.seqnames, coalesce(max(m.end_pos) + 1, 1), c.len from fx_contig c left join m2 m using (seqnames) group by c.seqnames, c.len)"""


@query("e12_low_depth", _RUNS + ", " + _LOW + " select seqnames, start_pos::bigint as start_pos, end_pos::bigint as end_pos from gaps where start_pos <= end_pos")
def e12_low_depth(s, d):
    return iv.low_depth(iv.duplex_coverage(fx.reads(s, d)), fx.lengths(s, d), 2)


@query("d13_intersect_runs", _RUNS + """ select r.seqnames, sum((least(r.end_pos, m.end_pos) - greatest(r.start_pos, m.start_pos) + 1) * r.depth)::bigint as weighted from runs r
 join fx_region m on m.seqnames = r.seqnames and r.start_pos <= m.end_pos and r.end_pos >= m.start_pos group by r.seqnames""")
def d13_intersect_runs(s, d):
    both = iv.intersect(iv.duplex_coverage(fx.reads(s, d)), fx.regions(s, d))
    return both.groupBy("seqnames").agg(F.sum(iv.width() * F.col("depth")).alias("weighted"))


@query("f20_genome_waterfall", _MASK + """, deep as (select seqnames, start_pos, end_pos from fx_read where strand = '+' and ec >= 40),
 base as (select seqnames, len, unnest(generate_series(1, len)) as p from fx_contig),
 hit as (select b.seqnames, b.p, exists (select 1 from mask m where m.seqnames = b.seqnames and b.p between m.start_pos and m.end_pos) as a,
  exists (select 1 from deep m where m.seqnames = b.seqnames and b.p between m.start_pos and m.end_pos) as b2 from base b)
 select 0 as step, 'regions' as mask, count(*) filter (where a) as removed_alone, count(*) filter (where not a) as remaining from hit
 union all select 1, 'deep_reads', count(*) filter (where b2), count(*) filter (where not a and not b2) from hit""")
def f20_genome_waterfall(s, d):
    whole = fx.lengths(s, d).select("seqnames", F.lit(1).cast("long").alias("start_pos"), F.col("len").alias("end_pos"))
    deep = fx.reads(s, d).where("strand = '+' AND ec >= 40").select("seqnames", "start_pos", "end_pos")
    return iv.waterfall(whole, [("regions", fx.regions(s, d).drop("score")), ("deep_reads", deep)])
