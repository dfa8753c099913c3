"""Queries of barcode sheets, soft clips, the template-strand grid and written results, each beside its DuckDB SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import sequences as sq
from ..operators import barcodes as bc
from ..operators import calls as cl
from ..operators import evidence as ev
from ..operators import genome as gn
from ..operators import molecules as ml
from ..operators import spectra as sp
from ..sources import text as tx
from ..sources.stage import shared_folder
from . import fixtures as fx
from .evidence_queries import _RC, _SBS, _sbs

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str):
    def keep(f):
        QUERIES[name], SQL[name] = f, fx.with_views(sql)
        return f

    return keep


def _new(s, name: str) -> str:
    return f"{shared_folder(s)}/strandlake/{name}-{uuid.uuid4().hex}"


#: A sheet that keeps all rules, with samples of one round and of two.
_SHEET = """select concat('run', n % 2) as run_id, concat('s', n) as sample, case when n < 12 then concat('bx-bc', cast((n - n % 2) / 2 as int)) else concat('bc', 6 + (cast((n - n % 2) / 2 as int)) % 2, '-bx') end as barcode_ids,
case when n >= 12 then concat('bd', cast((n - n % 4) / 4 as int)) end as barcode_ids_round2 from (select n_nationkey as n from nation) t"""
_READS = "select run_id, zm, strand, 'bx' as bc_a, concat('bc', zm % 9) as bc_b, case when zm % 11 <> 0 then concat('bd', ec % 5 + 2) end as pair2 from fx_read"


@query("b3_two_rounds", f"""sheet as ({_SHEET}), r as (select *, bc_b || '-' || bc_a as pair from ({_READS}) t)
 select r.run_id, r.zm, r.strand, s.sample, concat_ws('.', s.barcode_ids, s.barcode_ids_round2) as barcodes, case when s.barcode_ids_round2 is null then 1 else 2 end as round from r join sheet s on s.run_id = r.run_id and (s.barcode_ids = r.pair or s.barcode_ids = r.bc_a || '-' || r.bc_b) and (s.barcode_ids_round2 is null or s.barcode_ids_round2 = r.pair2)""")
def b3_two_rounds(s, d):
    """The sample of each read, by one round of barcodes or two."""
    sheet = s.sql(_SHEET.replace("from nation", "from {nation}"), nation=s.read.parquet(f"{d}/nation.parquet"))
    r = s.sql(_READS.replace("from fx_read", "from {reads}"), reads=fx.reads(s, d)).withColumn("pair", sq.canonical_pair("bc_a", "bc_b"))
    return bc.assign_rounds(r, sheet).select("run_id", "zm", "strand", "sample", "barcodes", "round")


#: A sheet that breaks each rule, and barcodes that do.
_FAULTY = """select concat('run', k - k % 20) as run_id, concat('s', k % 37) as sample, case when k % 31 = 0 then null when k % 29 = 0 then 'b!c' when k % 23 = 0 then 'bc1-bc2-bc3' when k % 19 = 0 then 'bc1-bc1' when k % 7 = 0 then concat('bc', k % 12)
 when k % 5 = 0 then concat('bx', k % 2, '-bc', k % 3) else concat('bc', k % 6, '-bx', k % 4) end as barcode_ids, case when k % 13 = 0 then '' when k % 17 = 0 then concat('bd', k % 5, '-bx1') when k % 3 = 0 then concat('bd', k % 2) end as barcode_ids_round2 from (select s_suppkey as k from supplier) t"""
_KNOWN = """select case when n < 10 then concat('bc', n) when n < 14 then concat('bx', n - 10) when n < 18 then concat('bd', n - 14) when n = 18 then 'bc3' when n = 19 then 'b d' else concat('by', n) end as barcode, case when n = 18 then 'GG' when n = 4 then 'S5' else concat('S', n) end as sequence from (select n_nationkey as n from nation) t"""


@query("b4_sheet_rules", f"""sheet as (select run_id, sample, barcode_ids, nullif(barcode_ids_round2, '') as barcode_ids_round2 from ({_FAULTY}) t), known as ({_KNOWN}),
 e as (select run_id, sample, 1 as round, barcode_ids as ids from sheet union all select run_id, sample, 2, barcode_ids_round2 from sheet where barcode_ids_round2 is not null),
 p as (select *, string_split(ids, '-') as part, coalesce(regexp_full_match(ids, '[A-Za-z0-9_]+(-[A-Za-z0-9_]+)?'), false) as shaped from e),
 q as (select *, shaped and (len(part) = 1 or part[1] <> part[2]) as sound, array_to_string(list_sort(part), '-') as pair from p),
 w as (select s.*, a.pair, b.pair as pair2 from sheet s left join (select distinct run_id, ids, pair from q where sound and round = 1) a on a.run_id = s.run_id and a.ids = s.barcode_ids left join (select distinct run_id, ids, pair from q where sound and round = 2) b on b.run_id = s.run_id and b.ids = s.barcode_ids_round2)
 select case when ids is null then 'undefined' when not shaped then 'malformed' else 'equal ids' end as rule, run_id, round, concat_ws(': ', sample, ids) as detail from q where not coalesce(sound, false)
 union all select distinct 'unknown barcode', run_id, round, b from (select run_id, round, unnest(part) as b from q where sound) u where b not in (select barcode from known)
 union all select 'pair given twice', run_id, 1, pair from w where pair is not null and barcode_ids_round2 is null group by run_id, pair having count(*) > 1
 union all select 'pair in both rounds', run_id, 1, pair from w where pair is not null group by run_id, pair having count(*) > count(barcode_ids_round2) and count(barcode_ids_round2) > 0
 union all select 'combination given twice', run_id, 2, pair || '|' || pair2 from w where pair is not null and pair2 is not null group by run_id, pair, pair2 having count(*) > 1
 union all select 'mixed modes', run_id, round, 'different, same' from q where sound group by run_id, round having count(distinct len(part)) > 1
 union all select 'second round in some runs', null, 2, sample from sheet group by sample having count(barcode_ids_round2) between 1 and count(*) - 1
 union all select distinct 'malformed barcode', null, null, barcode from known where not regexp_full_match(barcode, '[A-Za-z0-9_]+')
 union all select 'barcode with two sequences', null, null, barcode from known group by barcode having count(distinct sequence) > 1
 union all select 'sequence with two barcodes', null, null, sequence from known group by sequence having count(distinct barcode) > 1""")
def b4_sheet_rules(s, d):
    """What is wrong in a sheet of two rounds over many runs."""
    sheet = s.sql(_FAULTY.replace("from supplier", "from {supplier}"), supplier=s.read.parquet(f"{d}/supplier.parquet"))
    known = s.sql(_KNOWN.replace("from nation", "from {nation}"), nation=s.read.parquet(f"{d}/nation.parquet"))
    return bc.sheet_rules(sheet, known)


_CLIPS = "select run_id, zm, strand, concat(cigar, case when strand = '-' then concat(zm % 4, 'S') else '' end) as cigar from fx_aln"


@query("f1_softclip", f"""c as (select *, list_sum(regexp_extract_all(cigar, '([0-9]+)S', 1)::bigint[])::bigint as softclip from ({_CLIPS}) t)
 select run_id, zm, strand, softclip, max(softclip) over w <= 5 as softclip_each, avg(softclip) over w <= 5 as softclip_avg from c window w as (partition by run_id, zm)""")
def f1_softclip(s, d):
    """Limits on soft-clipped bases of each strand and of both."""
    r = s.sql(_CLIPS.replace("from fx_aln", "from {aligned}"), aligned=fx.aligned(s, d)).withColumn("softclip", sq.softclip("cigar"))
    return ml.molecule_quality(r, {}, {"softclip": 5}).select("run_id", "zm", "strand", "softclip", "softclip_each", "softclip_avg")


_LEVELS = "levels as (select a || r || b as t, a || n || b as m from (select unnest(['A', 'C', 'G', 'T']) as a) w, (select unnest(['A', 'C', 'G', 'T']) as r) x, (select unnest(['A', 'C', 'G', 'T']) as b) y, (select unnest(['A', 'C', 'G', 'T']) as n) z where r <> n)"


@query("g2_template_grid", f"""{_SBS}, {_LEVELS}, c as (select run_id, case when strand = '-' then t else {_RC.format('t')} end as t, case when strand = '-' then a else {_RC.format('a')} end as m, count(*) as n from ch group by all)
 select r.run_id, l.t || '>' || l.m as channel, case when substr(l.t, 2, 1) in ('C', 'T') then 'T:' || l.t || '>' || l.m else 'U:' || {_RC.format('l.t')} || '>' || {_RC.format('l.m')} end as label, coalesce(c.n, 0) as count, coalesce(c.n, 0)::double / r.total as fraction
 from (select run_id, sum(n) as total from c group by run_id) r cross join levels l left join c on c.run_id = r.run_id and c.t = l.t and c.m = l.m""")
def g2_template_grid(s, d):
    """All 192 changes on the template strand, seen or not, with their T: and U: labels."""
    return sp.sbs192(cl.oriented(_sbs(s, d)), ["run_id"])


@query("a6_read_fasta", "SELECT seqnames, t.i as tile, greatest(t.i * 1000 - 19, 1) as first, md5(translate(substr(seq, greatest(t.i * 1000 - 19, 1)::int, (least((t.i + 1) * 1000 + 20, len) - greatest(t.i * 1000 - 19, 1) + 1)::int), 'G', 'N')) as md5 from fx_contig, lateral (select unnest(generate_series(0, (len - 1) // 1000)) as i) t")
def a6_read_fasta(s, d):
    """A genome written as FASTA in lines of 60, small letters and a code for G that isn't a base among them, read back as tiles."""
    path = _new(s, "fasta")
    lines = F.array_join(F.regexp_extract_all(F.translate("seq", "GT", "Rt"), F.lit(".{1,60}"), F.lit(0)), "\n")
    fx.contigs(s, d).select(F.concat(F.lit(">"), "seqnames", F.lit(" of documents\n"), lines).alias("value")).write.text(path)
    return gn.tiled(tx.read_fasta(s, path)).select("seqnames", "tile", "first", F.md5(F.col("seq").cast("binary")).alias("md5"))


@query("a8_write_tsv", "SELECT run_id, call_type, zm, strand, seqnames, start_pos, end_pos, case when zm % 3 = 0 then null when zm % 3 = 1 then '' else 'a\"' || chr(9) || zm::varchar end as note from fx_call")
def a8_write_tsv(s, d):
    """Calls written as a folder of tab-separated files for each run and type, and read back: nulls, empty strings, tabs and quotes stay."""
    path = _new(s, "tsv")
    note = F.when(F.col("zm") % 3 == 1, "").when(F.col("zm") % 3 == 2, F.concat(F.lit('a"\t'), "zm"))
    c = fx.calls(s, d).select("zm", "strand", "seqnames", "start_pos", "end_pos", note.alias("note"), "run_id", "call_type")
    tx.write_tsv(c, path, ["run_id", "call_type"])
    return tx.read_tsv(s, path, c.schema)


@query("a11_write_bundle", "SELECT 'calls' as name, run_id, count(*) as n from fx_call group by run_id union all select 'reads', run_id, count(*) from fx_read group by run_id")
def a11_write_bundle(s, d):
    """A bundle of tables, written and read back."""
    path = _new(s, "bundle")
    tx.write_bundle({"calls": fx.calls(s, d), "reads": fx.reads(s, d)}, path)
    tables = tx.read_bundle(s, path, ["calls", "reads"])
    count = lambda name: tables[name].groupBy("run_id").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "run_id", "n")
    return count("calls").unionAll(count("reads"))


_STATS = """st as (select run_id, f.stat, count(distinct case when f.ok then zm end) as molecules, coalesce(sum(case when f.ok then end_pos - start_pos + 1 end), 0)::bigint as bases from fx_read,
 lateral (select 'mapq' as stat, mapq >= 60 as ok union all select 'depth.indelanalysis.passfilter', ec >= 20 union all select 'depth.nonindelanalysis.passfilter', ec >= 10 union all select 'all_filters', mapq >= 60 and ec >= 20) f group by run_id, f.stat)"""


@query("e24_prune_stats", _STATS + " select 'indel' as asked, * from st where stat not like '%.nonindelanalysis.%' union all select 'MDB', * from st where stat not like '%.indelanalysis.%' union all select 'SBS,indel', * from st")
def e24_prune_stats(s, d):
    """Statistics for three sets of requested classes."""
    ec = F.col("ec")
    stats = ml.filter_stats(fx.reads(s, d), {"mapq": F.col("mapq") >= 60, "depth.indelanalysis.passfilter": ec >= 20, "depth.nonindelanalysis.passfilter": ec >= 10}).withColumnRenamed("filter", "stat")
    one = lambda asked: ev.prune_stats(stats, asked.split(",")).select(F.lit(asked).alias("asked"), "run_id", "stat", "molecules", "bases")
    return one("indel").unionAll(one("MDB")).unionAll(one("SBS,indel"))
