"""Queries of calls taken from aligned reads with bases and evidence, each beside its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import genome as gn
from ..operators import strands as st
from . import fixtures as fx

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name], SQL[name] = f, fx.with_views(sql)
        return f

    return keep


#: op ranges of all reads, the calls with their places in both, and the other read's places.
_OPS = """op0 as (select run_id, zm, strand, seqnames, start_pos, unnest(regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]')) as o, generate_subscripts(regexp_extract_all(cigar, '[0-9]+[MIDNSHP=X]'), 1) as i from fx_aln),
 op1 as (select *, regexp_extract(o, '[A-Z=]') as op, regexp_extract(o, '[0-9]+')::bigint as len from op0),
 op2 as (select *, coalesce(sum(case when op in ('M','I','S','=','X') then len end) over w, 0)::bigint + 1 as q, coalesce(sum(case when op in ('M','D','N','=','X') then len end) over w, 0)::bigint + start_pos as r from op1 window w as (partition by run_id, zm, strand order by i rows between unbounded preceding and 1 preceding)),
 ops as materialized (select run_id, zm, strand, seqnames, op, len, q, q + case when op in ('M','I','S','=','X') then len else 0 end - 1 as qe, r, r + case when op in ('M','D','N','=','X') then len else 0 end - 1 as re from op2)"""
_SCORE = fx.VALUE["score"]
_FOUND = _OPS + f""", c0 as (select run_id, zm, strand, seqnames, 'SBS' as kind, 'SBS' as call_type, r + k as start_pos, r + k as end_pos, q + k as sq, q + k as eq, 1::bigint as w, null::double as mdb_score from ops, lateral (select unnest(generate_series(0, len - 1)) as k) t where op = 'X'
  union all select run_id, zm, strand, seqnames, 'indel', case op when 'I' then 'insertion' else 'deletion' end, r, re, q, qe, len, null from ops where op in ('I', 'D')
  union all select run_id, zm, strand, seqnames, 'MDB', 'mC', r + q - first, r + q - first, q, q, 1, {_SCORE} from (select run_id, zm, strand, seqnames, r, q as first, unnest(generate_series(q, qe)) as q from ops where op in ('=', 'X')) z where {_SCORE} >= 0.97)"""
_CALLS = _FOUND + """, c1 as (select c.*, a.bc_orientation, a.seq, substr(a.seq, sq::int, (eq - sq + 1)::int) as alt, substr(g.seq, c.start_pos::int, (c.end_pos - c.start_pos + 1)::int) as ref, case c.strand when '+' then '-' else '+' end as os from c0 c join fx_aln a using (run_id, zm, strand) join fx_contig g on g.seqnames = c.seqnames),
 calls as materialized (select * from c1)"""
_ACROSS = _CALLS + """, m0 as (select c.*, s.q0 from calls c left join (select c.run_id, c.zm, c.os, c.start_pos, max(case when o.op in ('=', 'X') then o.q + c.start_pos - o.r else o.qe + 1 end) as q0 from (select distinct run_id, zm, os, start_pos from calls) c join ops o on o.run_id = c.run_id and o.zm = c.zm and o.strand = c.os and c.start_pos between o.r and o.re group by all) s using (run_id, zm, os, start_pos)),
 m1 as (select m.*, s.q1 as q1a from m0 m left join (select c.run_id, c.zm, c.os, c.end_pos, max(case when o.op in ('=', 'X') then o.q + c.end_pos - o.r else o.q - 1 end) as q1 from (select distinct run_id, zm, os, end_pos from calls) c join ops o on o.run_id = c.run_id and o.zm = c.zm and o.strand = c.os and c.end_pos between o.r and o.re group by all) s using (run_id, zm, os, end_pos)),
 met as materialized (select *, case when q0 is not null and q1a is not null then greatest(q1a, q0 - 1) end as q1 from m1)"""


def _list(value: str, strand: str, low: str, high: str) -> str:
    v = fx.VALUE[value].replace("strand", strand)
    return f"array_to_string(list_transform(generate_series({low}, {high}), lambda q: {v}), ',')"


_SEEN = ", ".join(f"{_list(v, 'm.strand', 'least(sq, eq)', 'greatest(sq, eq)')} as {v}, case when q0 is not null and q1 is not null and (kind = 'indel' or q0 <= q1) then {_list(v, 'os', 'least(q0, q1)', 'greatest(q0, q1)')} end as {v}_opposite" for v in st.VALUES)
_PLACE = ["run_id", "zm", "strand", "seqnames", "kind", "call_type", "start_pos", "end_pos"]
_M = {"mC": ("score", 0.97)}


@fx.once
def evidence(s, d):
    """Calls of the aligned reads, without modified bases."""
    return st.extract_with_evidence(fx.aligned(s, d))


@fx.once
def sites(s, d):
    """Where the calls of the aligned reads are, for what needs neither their values nor their alleles."""
    return st.call_sites(fx.aligned(s, d))


def _joined(df, *names):
    return df.withColumns({n: F.array_join(n, ",") for n in names})


@query("c8_map_to_reference", _OPS + ", p as (select run_id, zm, strand, (1 + zm % 120)::bigint as query from fx_aln) select p.run_id, p.zm, p.strand, query, r + query - q as pos from p left join ops o on o.run_id = p.run_id and o.zm = p.zm and o.strand = p.strand and op in ('=', 'X') and query between q and qe")
def c8_map_to_reference(s, d):
    r = fx.aligned(s, d)
    return st.map_to_reference(r.select("run_id", "zm", "strand", (1 + F.col("zm") % 120).cast("long").alias("query")), r)


@query("c16_calls_with_alleles", _CALLS + " select run_id, zm, strand, seqnames, bc_orientation, kind, call_type, start_pos, end_pos, sq as start_query, eq as end_query, w, mdb_score, ref as ref_plus_strand, alt as alt_plus_strand from calls")
def c16_calls_with_alleles(s, d):
    """Base changes, indels and modified bases from CIGAR, scores and bases, with both alleles."""
    out = st.calls_with_alleles(fx.aligned(s, d), gn.tiled(fx.contigs(s, d)), _M)
    return out.select(*_PLACE, "bc_orientation", "start_query", "end_query", "w", "mdb_score", "ref_plus_strand", "alt_plus_strand")


@query("c7_opposite_quality", _ACROSS + f" select run_id, zm, m.strand, seqnames, kind, call_type, start_pos, end_pos, {_SEEN} from met m")
def c7_opposite_quality(s, d):
    """Quality and subread values of each call on its own strand and across from it."""
    names = [n for v in st.VALUES for n in (v, f"{v}_opposite")]
    return _joined(st.extract_with_evidence(fx.aligned(s, d), _M).select(*_PLACE, *names), *names)


@query("c9_modified_bases", _ACROSS + " select m.run_id, m.zm, m.strand, m.seqnames, m.start_pos, mdb_score from met m join fx_aln o on o.run_id = m.run_id and o.zm = m.zm and o.strand = m.os where kind = 'MDB' and q0 <= q1 and substr(o.seq, q0::int, 1) = case m.strand when '+' then 'C' else 'G' end")
def c9_modified_bases(s, d):
    """Modified bases across from a G, as the other strand reads it."""
    out = st.extract_with_evidence(fx.aligned(s, d), _M, {"mC": "G"}, changes=False)
    return out.select("run_id", "zm", "strand", "seqnames", "start_pos", "mdb_score")


_CHAIN = _ACROSS + """, pr as (select c.run_id, c.zm, c.strand, c.call_type, c.start_pos, c.end_pos, o.call_type as opp_type, o.start_pos as opp_start, o.end_pos as opp_end, o.alt as opp_alt,
  row_number() over (partition by c.run_id, c.zm, c.strand, c.call_type, c.start_pos, c.end_pos order by o.call_type, o.start_pos, o.end_pos, o.alt) as n
  from calls c join calls o on o.run_id = c.run_id and o.zm = c.zm and o.seqnames = c.seqnames and o.strand = c.os and o.kind <> 'MDB' and (
   (c.call_type not in ('insertion', 'deletion') and o.call_type = 'SBS' and o.start_pos = c.start_pos)
   or (c.call_type = 'insertion' and o.call_type = 'insertion' and o.start_pos = c.start_pos)
   or (c.call_type <> 'deletion' and o.call_type = 'deletion' and least(c.start_pos, c.end_pos) >= o.start_pos and greatest(c.start_pos, c.end_pos) <= o.end_pos)
   or (c.call_type = 'deletion' and o.call_type <> 'deletion' and least(o.start_pos, o.end_pos) >= c.start_pos and greatest(o.start_pos, o.end_pos) <= c.end_pos)
   or (c.call_type = 'deletion' and o.call_type = 'deletion' and c.start_pos <= o.end_pos and c.end_pos >= o.start_pos))),
 ann as (select m.*, opp_type, opp_start, opp_end, opp_alt, case when m.call_type = 'deletion' and opp_type = 'deletion' then m.start_pos = opp_start and m.end_pos = opp_end end as deletion_match from met m left join pr on n = 1 and pr.run_id = m.run_id and pr.zm = m.zm and pr.strand = m.strand and pr.call_type = m.call_type and pr.start_pos = m.start_pos and pr.end_pos = m.end_pos),
 cls as materialized (select *, case when ref = alt and opp_type is null then 'match' when ref = alt then 'mismatch-os' when opp_type is null then 'mismatch-ss' when alt = opp_alt and coalesce(deletion_match, true) and start_pos = opp_start and end_pos = opp_end then 'mutation' else 'mismatch-ds' end as call_class from ann)"""


@query("c13_chained_classes", _CHAIN + " select run_id, zm, strand, seqnames, kind, call_type, start_pos, end_pos, ref as ref_plus_strand, alt as alt_plus_strand, opp_type, opp_start, opp_end, opp_alt, deletion_match, call_class from cls")
def c13_chained_classes(s, d):
    """Reads with CIGAR and bases to classified calls: extraction, alleles, opposite strand and classes in one plan."""
    out = st.all_calls(fx.aligned(s, d), gn.tiled(fx.contigs(s, d)), _M)
    return out.select(*_PLACE, "ref_plus_strand", "alt_plus_strand", "opp_type", "opp_start", "opp_end", "opp_alt", "deletion_match", "call_class")


_PARTNER = ", ".join(f"case when m.call_class = 'mutation' and m.kind <> 'MDB' then {_list(v, 'm.os', 'least(o.sq, o.eq)', 'greatest(o.sq, o.eq)').replace('zm', 'm.zm')} when m.q0 is not null and m.q1 is not null and (m.kind = 'indel' or m.q0 <= m.q1) then {_list(v, 'm.os', 'least(m.q0, m.q1)', 'greatest(m.q0, m.q1)').replace('zm', 'm.zm')} end as {v}_opposite" for v in st.VALUES)


@query("c14_partners_evidence", _CHAIN + f" select m.run_id, m.zm, m.strand, m.seqnames, m.kind, m.call_type, m.start_pos, m.end_pos, m.call_class, {_PARTNER} from cls m left join cls o on o.run_id = m.run_id and o.zm = m.zm and o.strand = m.os and o.kind = m.kind and o.call_type = m.call_type and o.start_pos = m.start_pos and o.end_pos = m.end_pos and o.alt = m.alt and o.ref = m.ref and o.call_class = 'mutation' and m.call_class = 'mutation' where m.kind <> 'MDB'")
def c14_partners_evidence(s, d):
    """Opposite values of mutations are those of the partner call; all others keep what the reference position gives."""
    names = [f"{v}_opposite" for v in st.VALUES]
    out = st.all_calls(fx.aligned(s, d), gn.tiled(fx.contigs(s, d)))
    return _joined(out.select(*_PLACE, "call_class", *names), *names)
