"""Stand-ins for sequencing inputs, derived from the driver's tables; the same views in Spark and as DuckDB SQL.

contigs: letters of documents as bases. reads: two strand reads of each order. calls: line items as base changes.
regions: scored intervals from events.
"""

from __future__ import annotations

from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.genome import TILE, tiled
from ..sources.stage import staged

_BASES = ("abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC")


_HELD: dict[tuple[str, str, str], DataFrame] = {}


def once(make):
    """Writes what ``make`` derives, once for a session and folder: a query mentions its inputs many times."""

    @wraps(make)
    def held(spark: SparkSession, sf_dir: str) -> DataFrame:
        key = (spark.sparkContext.applicationId, sf_dir, make.__name__)
        if key not in _HELD:
            _HELD[key] = staged(make(spark, sf_dir), make.__name__)
        return _HELD[key]

    return held


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of the larger table that a task joins, at most about.
PART = 1 << 16


def _dealt(large: DataFrame, left: DataFrame, right: DataFrame, *on: str) -> tuple[DataFrame, DataFrame]:
    """left and right dealt by ``on`` for their join, to tasks whose size the rows of ``large``, a written table, do not change.

    Spark alone takes as few tasks as there are cores, or of up to 64 MB compressed, which is over 2 GB when sorted.
    """
    n = -(-large.count() // PART) or 1
    return left.repartition(n, *on), right.repartition(n, *on)


def _numbered(ids: DataFrame, size: int = 1 << 16) -> DataFrame:
    """(doc_id, contig_idx): ids numbered from 0 in their order, by ranges of ``size``; of each range one row goes to a common task."""
    of_range = Window.partitionBy("range")
    ranked = ids.withColumn("range", F.floor(F.col("doc_id") / size)).withColumns({"rank": F.row_number().over(of_range.orderBy("doc_id")), "n": F.count(F.lit(1)).over(of_range)})
    ranges = ranked.where("rank = 1").select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    return ranked.join(ranges, "range").select("doc_id", (F.col("before") + F.col("rank") - 1).alias("contig_idx"))


@once
def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(contig_idx, seqnames, seq, len); contigs of 600 bases and more, numbered from 0 by document."""
    text = F.translate(F.lower(F.regexp_replace("text", "[^A-Za-z]", "")), *_BASES)
    long_ = _table(spark, sf_dir, "documents").select("doc_id", text.alias("seq")).where("length(seq) >= 600")
    numbers = _numbered(long_.select("doc_id"))
    return long_.join(numbers, "doc_id").select(F.col("contig_idx").cast("long"), F.concat(F.lit("ctg"), "doc_id").alias("seqnames"), "seq", F.length("seq").cast("long").alias("len"))


def lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contigs(spark, sf_dir).select("seqnames", "len")


@once
def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, zm, strand, seqnames, start_pos, end_pos, rq, mapq, ec), one row for each strand of a molecule."""
    known = contigs(spark, sf_dir).drop("seq")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").crossJoin(F.broadcast(known.agg(F.count(F.lit(1)).alias("n"))))
    o = orders.withColumn("contig_idx", F.col("o_orderkey") % F.col("n")).join(known, "contig_idx")
    o = o.withColumn("strand", F.explode(F.array(F.lit("+"), F.lit("-"))))
    at = 1 + (F.col("o_custkey") * 7919) % (F.col("len") - 520)
    minus = F.col("strand") == "-"
    return o.select(
        F.concat(F.lit("run"), F.col("o_orderkey") % 2).alias("run_id"),
        F.col("o_orderkey").alias("zm"),
        "strand",
        "seqnames",
        (at + F.when(minus, F.col("o_orderkey") % 11).otherwise(0)).alias("start_pos"),
        (200 + F.col("o_orderkey") % 300 + at + F.when(minus, F.col("o_orderkey") % 13).otherwise(0)).alias("end_pos"),
        ((950 + F.col("o_orderkey") % 51).cast("double") / 1000).alias("rq"),
        F.when(F.col("o_orderkey") % 10 == 0, 20).otherwise(60).alias("mapq"),
        (5 + F.col("o_orderkey") % 40).alias("ec"),
    )


@once
def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, zm, strand, seqnames, call_type, start_pos, end_pos, alt_code, w)."""
    items = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("zm"), "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    items, r = _dealt(items, items, reads(spark, sf_dir).select("run_id", "zm", "strand", "seqnames", "start_pos"), "zm")
    r = r.withColumn("p_start", F.min("start_pos").over(Window.partitionBy("zm"))).drop("start_pos")  # the + strand starts first
    j = items.hint("merge").join(r, "zm")
    j = j.where("l_linestatus = 'O' OR (l_linenumber % 2 = 0 AND strand = '+') OR (l_linenumber % 2 = 1 AND strand = '-')")
    kind = F.when(F.col("l_returnflag") == "R", "SBS").when(F.col("l_returnflag") == "A", "insertion").otherwise("deletion")
    j = j.select("run_id", "zm", "strand", "seqnames", kind.alias("call_type"), (F.col("p_start") + 20 + F.col("l_partkey") % 150).alias("start_pos"), (1 + F.col("l_suppkey") % 3).alias("k"), (1 + F.col("l_linenumber") % 6).cast("long").alias("w"))
    j = j.withColumn("end_pos", F.when(F.col("call_type") == "insertion", F.col("start_pos") - 1).when(F.col("call_type") == "deletion", F.col("start_pos") + F.col("w") - 1).otherwise(F.col("start_pos")))
    return j.groupBy("run_id", "zm", "strand", "seqnames", "call_type", "start_pos", "end_pos").agg(F.max("k").alias("alt_code"), F.max("w").alias("w"))


def calls_by(spark: SparkSession, sf_dir: str, *on: str) -> DataFrame:
    """calls dealt by ``on`` to tasks of one size, for what brings those of equal ``on`` together."""
    written = calls(spark, sf_dir)
    return _dealt(written, written, written, *on)[0]


@once
def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seqnames, start_pos, end_pos, score), distinct."""
    known = contigs(spark, sf_dir).drop("seq")
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "value").crossJoin(F.broadcast(known.agg(F.count(F.lit(1)).alias("n"))))
    e = events.withColumn("contig_idx", F.col("user_id") % F.col("n")).join(known, "contig_idx")
    at = 1 + (F.col("event_id") * 31) % (F.col("len") - 60)
    return e.select("seqnames", at.alias("start_pos"), (10 + F.col("user_id") % 40 + at).alias("end_pos"), F.col("value").alias("score")).distinct()


#: Aligned reads in terms that Spark and DuckDB share. Each has a clip, changed bases, an insertion and a deletion; the - read's places
#: agree with the + read's, and by zm it lacks the changed bases or has them deleted, or has other bases, insertions and deletions.
_SHAPE = """select r.run_id, r.zm, r.strand, r.seqnames, r.start_pos, g.seq as g, cast(r.start_pos as int) as s, cast(1 + r.zm % 5 as int) as c,
cast(30 + r.zm % 40 - (r.start_pos - p.start_pos) as int) as a, cast(1 + r.zm % 3 as int) as xp, cast(case when r.strand = '-' and r.zm % 8 = 0 then 0 else 1 + r.zm % 3 end as int) as x,
case when r.strand = '-' and r.zm % 12 = 5 then 'D' else 'X' end as xo, case when r.strand = '-' and r.zm % 9 = 0 then r.zm % 3 + 2 else r.zm % 3 + 1 end as k,
cast(case when r.strand = '+' then 1 + r.zm % 4 when r.zm % 10 = 1 then 0 when r.zm % 6 = 0 then 1 + (r.zm + 1) % 4 else 1 + r.zm % 4 end as int) as i,
cast(case when r.strand = '-' and r.zm % 7 = 0 then 1 + (r.zm + 1) % 5 else 1 + r.zm % 5 end as int) as b
from fx_read r join fx_contig g on g.seqnames = r.seqnames join fx_read p on p.run_id = r.run_id and p.zm = r.zm and p.strand = '+'"""
_ALIGNED = """select run_id, zm, strand, seqnames, start_pos, case when (strand = '+') = (zm % 2 = 0) then 'a-b' else 'b-a' end as bc_orientation, case when zm % 17 = 0 then 1024 when strand = '+' then 0 else 16 end as flag,
concat(c, 'S', a, '=', case when x > 0 then concat(x, xo) else '' end, 10 + xp - x, '=', case when i > 0 then concat(i, 'I') else '' end, '30=', b, 'D20=') as cigar,
concat(repeat('G', c), substr(g, s, a), case when xo = 'X' then translate(substr(g, s + a, x), 'ACGT', case k when 1 then 'CGTA' when 2 then 'GTAC' when 3 then 'TACG' else 'CATG' end) else '' end,
 substr(g, s + a + x, 10 + xp - x), translate(substr(g, s + a + xp + 10, i), 'ACGT', 'GTAC'), substr(g, s + a + xp + 10, 30), substr(g, s + a + xp + 40 + b, 20)) as seq,
start_pos + a + xp + 59 + b as end_pos from shape"""
#: No read of _ALIGNED spans more bases.
LONGEST = 200
#: Per-base values by zm, strand and place q in the read.
VALUE = {"qual": "((zm * 7 + q * 13 + case when strand = '+' then 0 else 31 end) % 94)", "sa": "(1 + (zm + q) % 9)", "sm": "((zm + 2 * q) % 7)", "sx": "((zm + q) % 3)", "score": "(cast((zm * 3 + q * 11) % 100 as double) / 100)"}


_AS_ARRAY = {
    "qual": lambda zm, minus, q: (zm * 7 + q * 13 + 31 * minus) % 94,
    "sa": lambda zm, minus, q: 1 + (zm + q) % 9,
    "sm": lambda zm, minus, q: (zm + 2 * q) % 7,
    "sx": lambda zm, minus, q: (zm + q) % 3,
    "score": lambda zm, minus, q: (zm * 3 + q * 11) % 100 / 100,
}


def _per_base(name: str):
    """VALUE[name] at the places 1..n of reads, as a function of columns (zm, minus, n)."""
    kind, arrow = (T.DoubleType(), pa.float64()) if name == "score" else (T.ShortType(), pa.int16())

    @F.arrow_udf(T.ArrayType(kind))
    def values(zm: pa.Array, minus: pa.Array, n: pa.Array) -> pa.Array:
        size = pc.fill_null(n, 0).to_numpy().astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(size)))
        q = np.arange(1, ends[-1] + 1) - np.repeat(ends[:-1], size)
        each = _AS_ARRAY[name](np.repeat(zm.to_numpy(), size), np.repeat(minus.to_numpy(), size), q)
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(each).cast(arrow), mask=n.is_null())

    return values


@once
def _alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """_ALIGNED. A molecule's reads meet before their bases do, and then the tile where they start, padded by more than a read is long; no read walks along a contig."""
    molecule = Window.partitionBy("run_id", "zm")
    written = reads(spark, sf_dir)
    near = written.withColumn("p_start", F.max(F.when(F.col("strand") == "+", F.col("start_pos"))).over(molecule)).where("p_start IS NOT NULL")
    near = near.withColumn("tile", F.floor((F.col("start_pos") - 1) / TILE))
    near, tiles = _dealt(written, near, tiled(contigs(spark, sf_dir), pad=LONGEST), "seqnames", "tile")
    columns = _SHAPE[: _SHAPE.index("\nfrom fx_read r")].replace("p.start_pos", "r.p_start").replace("cast(r.start_pos as int) as s", "cast(r.start_pos - g.first + 1 as int) as s")
    rows = spark.sql(columns + " from {near} r join {tiles} g on g.seqnames = r.seqnames and g.tile = r.tile", near=near.hint("merge"), tiles=tiles)
    return spark.sql(_ALIGNED.replace("from shape", "from {shape}"), shape=rows)


def aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, zm, strand, seqnames, start_pos, end_pos, flag, cigar, seq, qual, sa, sm, sx, score, bc_orientation).

    The per-base values are derived where they are read: written, they would be most of the table.
    """
    minus = F.when(F.col("strand") == "-", 1).otherwise(0)
    return _alignments(spark, sf_dir).select("*", *[_per_base(n)("zm", minus, F.length("seq")).alias(n) for n in VALUE])


_PARTS = {
    "fx_contig": """select row_number() over (order by doc_id) - 1 as contig_idx, 'ctg' || cast(doc_id as varchar) as seqnames, seq, length(seq) as len
from (select doc_id, translate(lower(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') as seq from documents) t
where length(seq) >= 600""",
    "fx_read": """select 'run' || cast(o_orderkey % 2 as varchar) as run_id, o_orderkey as zm, s.strand, c.seqnames,
1 + (o_custkey*7919) % (c.len-520) + case when s.strand='-' then o_orderkey % 11 else 0 end as start_pos,
200 + o_orderkey % 300 + 1 + (o_custkey*7919) % (c.len-520) + case when s.strand='-' then o_orderkey % 13 else 0 end as end_pos,
cast(950 + o_orderkey % 51 as double)/1000 as rq, case when o_orderkey % 10 = 0 then 20 else 60 end as mapq, 5 + o_orderkey % 40 as ec
from orders o join (select count(*) as n from fx_contig) k on 1=1 join fx_contig c on c.contig_idx = o.o_orderkey % k.n
cross join (select '+' as strand union all select '-' as strand) s""",
    "fx_call": """select run_id, zm, strand, seqnames, call_type, start_pos, case when call_type='insertion' then start_pos-1 when call_type='deletion' then start_pos+w-1 else start_pos end as end_pos, max(k) as alt_code, max(w) as w
from (select r.run_id, r.zm, r.strand, r.seqnames, case l.l_returnflag when 'R' then 'SBS' when 'A' then 'insertion' else 'deletion' end as call_type,
 p.start_pos + 20 + l.l_partkey % 150 as start_pos, 1 + l.l_suppkey % 3 as k, 1 + l.l_linenumber % 6 as w
 from lineitem l join fx_read r on r.zm = l.l_orderkey join fx_read p on p.zm = r.zm and p.strand = '+'
 where l.l_linestatus='O' or (l.l_linenumber % 2 = 0 and r.strand='+') or (l.l_linenumber % 2 = 1 and r.strand='-')) t
group by run_id, zm, strand, seqnames, call_type, start_pos, case when call_type='insertion' then start_pos-1 when call_type='deletion' then start_pos+w-1 else start_pos end""",
    "fx_aln": f"with shape as ({_SHAPE}) {_ALIGNED}",
    "fx_region": """select distinct c.seqnames, 1 + (e.event_id*31) % (c.len-60) as start_pos, 10 + e.user_id % 40 + 1 + (e.event_id*31) % (c.len-60) as end_pos, e.value as score
from events e join (select count(*) as n from fx_contig) k on 1=1 join fx_contig c on c.contig_idx = e.user_id % k.n""",
}


def with_views(sql: str) -> str:
    """sql, whose first word is SELECT or a further 'name AS (...)' list, after those of the views that it uses."""
    used = {name for name in _PARTS if name in sql}
    for name in reversed(_PARTS):  # a view stands after those that it uses
        used |= {other for other in _PARTS if name in used and other in _PARTS[name]}
    heads = ", ".join(f"{name} AS MATERIALIZED ({body})" for name, body in _PARTS.items() if name in used)
    if sql.lstrip()[:6].upper() == "SELECT":
        return f"WITH {heads} {sql}" if heads else sql
    return f"WITH {heads}, {sql}" if heads else f"WITH {sql}"
