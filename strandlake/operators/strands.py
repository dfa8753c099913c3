"""Calls with alleles and evidence from aligned reads of both strands: bases, qualities and subread counts by CIGAR.

Both reads of a molecule meet once. Everything about a call is then read in their row: its bases and per-base values
on its own strand, and those on the other strand by way of the reference (query to reference to the other's query).
Coordinates are 1-based and inclusive; reads are in reference orientation whatever their strand.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import at_least, cigar_ranges, pyrimidine, reference_length, reverse_complement
from .calls import classify, opposite_calls, with_ops
from .genome import TILE
from .intervals import E, S
from .molecules import K

#: Per-base arrays of a read: base quality, subreads that cover, match and differ.
VALUES = ("qual", "sa", "sm", "sx")
_ALIGNED = ("M", "=", "X")


def query_at(ops: Column | str, pos: Column, forward: bool) -> Column:
    """The query position of the read's base at reference position ``pos``; null outside the alignment.

    Where the read has no base there, that of its next base, or with ``forward`` false of the last one before.
    """
    o = F.get(F.filter(ops, lambda o: (o["r_start"] <= pos) & (pos <= o["r_end"])), F.lit(0))
    return F.when(o["op"].isin(*_ALIGNED), o["q_start"] + pos - o["r_start"]).otherwise(o["q_end"] + 1 if forward else o["q_start"] - 1)


def reference_at(ops: Column | str, query: Column) -> Column:
    """The reference position of a read's base; null for inserted and clipped bases."""
    o = F.get(F.filter(ops, lambda o: o["op"].isin(*_ALIGNED) & (o["q_start"] <= query) & (query <= o["q_end"])), F.lit(0))
    return o["r_start"] + query - o["q_start"]


def base_at(aligned: Column | str, seq: str, pos: Column) -> Column:
    """The read's base at reference position ``pos``, from its aligned parts (q, first, last); null where it has none."""
    o = F.get(F.filter(aligned, lambda o: (o["first"] <= pos) & (pos <= o["last"])), F.lit(0))
    return F.substr(seq, (o["q"] + pos - o["first"]).cast("int"), F.lit(1))


def map_to_reference(points: DataFrame, reads: DataFrame) -> DataFrame:
    """points (run_id, zm, strand, query) with ``pos``, the reference position of each base of a read; null where it has none."""
    return with_ops(points, reads).withColumn("pos", reference_at("ops", F.col("query"))).drop("ops")


def _call(kind: str, call_type: str | Column, start: Column, end: Column, q_start: Column, q_end: Column, w: Column, score: Column) -> Column:
    call_type = F.lit(call_type) if isinstance(call_type, str) else call_type
    return F.struct(F.lit(kind).alias("kind"), call_type.alias("call_type"), start.alias(S), end.alias(E), q_start.alias("start_query"), q_end.alias("end_query"), w.alias("w"), score.cast("double").alias("mdb_score"))


def _found(modified: dict[str, tuple[str, float]], opposite_bases: dict[str, str], changes: bool) -> Column:
    """Array of all calls of a _paired read: changed bases, insertions, deletions, and bases whose score reaches its limit. Without ``changes`` the latter alone."""
    one, none = F.lit(1).cast("long"), F.lit(None)
    steps = lambda o: F.sequence(F.lit(0).cast("long"), o["len"] - 1)
    sbs = F.transform(F.filter("ops", lambda o: o["op"] == "X"), lambda o: F.transform(steps(o), lambda i: _call("SBS", "SBS", o["r_start"] + i, o["r_start"] + i, o["q_start"] + i, o["q_start"] + i, one, none)))
    indel = F.transform(F.filter("ops", lambda o: o["op"].isin("I", "D")), lambda o: _call("indel", F.when(o["op"] == "I", "insertion").otherwise("deletion"), o["r_start"], o["r_end"], o["q_start"], o["q_end"], o["len"], none))
    parts = [F.flatten(sbs), indel] if changes else []
    for name in modified:
        placed = F.col(_high(name))
        if name in opposite_bases:  # told here, before a call is a row
            there = lambda x: base_at("_aligned_opposite", "seq_opposite", x["at"])
            placed = F.filter(placed, lambda x: F.when(F.col("strand") == "+", reverse_complement(there(x))).otherwise(there(x)) == opposite_bases[name])
        parts.append(F.transform(placed, lambda x: _call("MDB", name, x["at"], x["at"], x["q"], x["q"], one, x["v"])))
    return F.concat(*parts)


def call_sites(reads: DataFrame, alleles: bool = False) -> DataFrame:
    """(run_id, zm, strand, seqnames, kind, call_type, start_pos, end_pos, w): the places of extract_with_evidence's base changes and indels.

    They follow from each read's CIGAR string alone: no values are read, and nothing is shuffled. With ``alleles``
    alt_plus_strand too, from the read's bases.
    """
    ops = F.filter(cigar_ranges("cigar", S), lambda o: o["op"].isin("X", "I", "D"))
    bases = ["seq"] if alleles else []
    each = reads.select(*K, "strand", "seqnames", *bases, F.explode_outer(ops).alias("o")).where("o IS NOT NULL").select(*K, "strand", "seqnames", *bases, "o.*")
    changed, one = F.col("op") == "X", F.lit(1).cast("long")
    each = each.withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.when(changed, F.col("len") - 1).otherwise(0))))
    kind, call_type = F.when(changed, "SBS").otherwise("indel"), F.when(changed, "SBS").when(F.col("op") == "I", "insertion").otherwise("deletion")
    start = F.col("r_start") + F.col("i")
    alt = F.substr("seq", (F.col("q_start") + F.col("i")).cast("int"), F.when(changed, one).otherwise(F.col("q_end") - F.col("q_start") + 1).cast("int"))
    more = [alt.alias("alt_plus_strand")] if alleles else []
    return each.select(*K, "strand", "seqnames", kind.alias("kind"), call_type.alias("call_type"), start.alias(S), F.when(changed, start).otherwise(F.col("r_end")).alias(E), F.when(changed, one).otherwise(F.col("len")).alias("w"), *more)


def _part(values: str, low: Column, high: Column) -> Column:
    """values[low..high], or null where that reaches outside the array."""
    inside = (low >= 1) & (high >= low) & (high <= F.size(values))
    return F.when(inside, F.slice(values, F.when(inside, low).otherwise(1).cast("int"), F.when(inside, high - low + 1).otherwise(0).cast("int")))


def extract_with_evidence(reads: DataFrame, modified: dict[str, tuple[str, float]] | None = None, opposite_bases: dict[str, str] | None = None, changes: bool = True) -> DataFrame:
    """Calls of reads (run_id, zm, strand, seqnames, bc_orientation, start_pos, cigar, seq, qual, sa, sm, sx).

    Gives kind (SBS, indel, MDB), call_type, start_pos, end_pos, start_query, end_query, w, alt_plus_strand, mdb_score,
    the VALUES of the call's bases (a deletion's: those of both neighbours), and <value>_opposite: what the other
    strand's read has at the same reference positions; where it has none between two bases, an indel takes both of
    these and a single base gets null. Null too without the other read or outside its alignment. max_sa and
    max_sa_opposite are the greatest sa of both reads.

    ``modified`` names kinds of modified bases by score column and least score; ``opposite_bases`` asks for a base, as
    the other strand reads it, across from them. ``changes`` false leaves out base changes and indels.
    """
    own = _ranged(_scored(reads, modified or {}), modified or {}, opposite_bases or {})
    return _extracted(_paired(own), modified or {}, opposite_bases or {}, changes=changes)


def _high(name: str) -> str:
    return f"_high_{name}"


def _scored(reads: DataFrame, modified: dict[str, tuple[str, float]]) -> DataFrame:
    """reads with the few scores that reach their limit, so that no array of scores moves or is looked through again."""
    return reads.withColumns({_high(name): at_least(column, least) for name, (column, least) in modified.items()})


def _ranged(reads: DataFrame, modified: dict[str, tuple[str, float]], opposite_bases: dict[str, str]) -> DataFrame:
    """_scored reads with ops, and with the reference positions of scores; where opposite bases are asked for, the aligned parts alone too."""
    out = reads.withColumn("ops", cigar_ranges("cigar", S)).drop("cigar")
    placed = lambda high: F.filter(F.transform(high, lambda x: F.struct(x["v"].alias("v"), x["q"].alias("q"), reference_at("ops", x["q"]).alias("at"))), lambda x: x["at"].isNotNull())
    out = out.withColumns({_high(name): placed(_high(name)) for name in modified})
    if not set(opposite_bases) & set(modified):
        return out
    part = lambda o: F.struct(o["q_start"].alias("q"), o["r_start"].alias("first"), o["r_end"].alias("last"))
    return out.withColumn("_aligned", F.transform(F.filter("ops", lambda o: o["op"].isin(*_ALIGNED)), part))


def _paired(own: DataFrame) -> DataFrame:
    """_ranged reads with ops_opposite, seq_opposite and <value>_there of the molecule's read on the other strand; null without one.

    A molecule has one read for each strand on a contig. Both lie side by side in their order by strand, so that each moves once.
    """
    molecule = Window.partitionBy(*K, "seqnames").orderBy("strand")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in (*K, "seqnames")])
    after, before = (known & (F.col("strand") == a) & (f("strand").over(molecule) == b) for a, b, f in (("+", "-", F.lead), ("-", "+", F.lag)))
    names = {"ops": "ops_opposite", "seq": "seq_opposite"} | {v: f"{v}_there" for v in VALUES} | {c: f"{c}_opposite" for c in own.columns if c == "_aligned"}
    return own.withColumns({new: F.when(after, F.lead(old).over(molecule)).when(before, F.lag(old).over(molecule)) for old, new in names.items()})


def _extracted(pairs: DataFrame, modified: dict[str, tuple[str, float]], opposite_bases: dict[str, str], more: dict[str, Column] | None = None, changes: bool = True) -> DataFrame:
    """extract_with_evidence of _paired reads, _scored before; ``more`` names further columns by what is read from a call and its read."""
    pairs = pairs.withColumns({"max_sa": F.array_max("sa"), "max_sa_opposite": F.array_max("sa_there")})
    each = pairs.drop(S, E).withColumn("c", F.explode_outer(_found(modified, opposite_bases, changes))).where("c IS NOT NULL").select("*", "c.*")
    each = each.withColumns({"q0": query_at("ops_opposite", F.col(S), True), "q1": query_at("ops_opposite", F.col(E), False)})
    each = each.withColumn("q1", F.when(F.col("q0").isNotNull() & F.col("q1").isNotNull(), F.greatest("q1", F.col("q0") - 1)))
    low, high = F.least("start_query", "end_query"), F.greatest("start_query", "end_query")
    there = (F.col("kind") == "indel") | (F.col("q0") <= F.col("q1"))
    values = {v: _part(v, low, high) for v in VALUES} | {f"{v}_opposite": F.when(there, _part(f"{v}_there", F.least("q0", "q1"), F.greatest("q0", "q1"))) for v in VALUES}
    alt = F.substr("seq", F.col("start_query").cast("int"), (F.col("end_query") - F.col("start_query") + 1).cast("int"))
    across = F.when(F.col("q0") <= F.col("q1"), F.substr("seq_opposite", F.col("q0").cast("int"), F.lit(1)))
    across = F.when(F.col("strand") == "+", reverse_complement(across)).otherwise(across)
    out = each.withColumns(values | {"alt_plus_strand": alt, "_across": across} | (more or {}))
    for name, base in ((n, b) for n, b in opposite_bases.items() if n not in modified):
        out = out.where((F.col("call_type") != name) | (F.col("_across") == base))
    names = [*K, "strand", "seqnames", "bc_orientation", "kind", "call_type", S, E, "start_query", "end_query", "w", "alt_plus_strand", "mdb_score", *values, "max_sa", "max_sa_opposite", *(more or {})]
    return out.select(*names)


def _reference(reads: DataFrame, tiles: DataFrame, before: int = 0, after: int = 0, tile: int = TILE) -> DataFrame:
    """(run_id, zm, seqnames, bases): the genome under a molecule's reads, ``before`` bases in front of each and ``after`` behind, as an array of (low, part) in their order, one for each tile that a read touches."""
    spans = reads.select(*K, "seqnames", F.greatest(F.col(S) - before, F.lit(1)).alias(S) if before else F.col(S), (F.col(S) + reference_length("cigar") - 1 + after).alias(E)).where(F.col(S) <= F.col(E))
    cut = spans.withColumn("tile", F.explode(F.sequence(F.floor((F.col(S) - 1) / tile), F.floor((F.col(E) - 1) / tile))))
    low, high = F.greatest(F.col(S), F.col("tile") * tile + 1), F.least(F.col(E), (F.col("tile") + 1) * tile)
    cut = cut.groupBy(*K, "seqnames", "tile").agg(F.min(low).alias("low"), F.max(high).alias("high"))
    met = cut.join(tiles.hint("shuffle_hash"), ["seqnames", "tile"]).select(*K, "seqnames", "low", F.substr("seq", (F.col("low") - F.col("first") + 1).cast("int"), (F.col("high") - F.col("low") + 1).cast("int")).alias("part"))
    return met.groupBy(*K, "seqnames").agg(F.array_sort(F.collect_list(F.struct("low", "part"))).alias("bases"))  # a row for each tile under the molecule


def with_reference(calls: DataFrame, tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """calls with ref_plus_strand, the genome's bases under them, of any length; empty for insertions."""
    spans = calls.where(F.col(S) <= F.col(E)).select("seqnames", S, E).distinct()
    cut = spans.withColumn("tile", F.explode(F.sequence(F.floor((F.col(S) - 1) / tile), F.floor((F.col(E) - 1) / tile))))
    low, high = F.greatest(F.col(S), F.col("tile") * tile + 1), F.least(F.col(E), (F.col("tile") + 1) * tile)
    met = cut.join(tiles, ["seqnames", "tile"]).select("seqnames", S, E, "tile", F.substr("seq", (low - F.col("first") + 1).cast("int"), (high - low + 1).cast("int")).alias("part"))
    whole = met.groupBy("seqnames", S, E).agg(F.array_sort(F.collect_list(F.struct("tile", "part"))).alias("p"))  # a row for each tile under the call
    whole = whole.select("seqnames", S, E, F.array_join(F.transform("p", lambda x: x["part"]), "").alias("ref_plus_strand"))
    return calls.join(whole, ["seqnames", S, E], "left").withColumn("ref_plus_strand", F.when(F.col(S) > F.col(E), "").otherwise(F.col("ref_plus_strand")))


def partners_evidence(classified: DataFrame) -> DataFrame:
    """classified with the opposite values of mutations taken from their partner call, which has its very bases.

    Both calls lie side by side in their order by strand.
    """
    by = [*K, "seqnames", "kind", "call_type", S, E, "ref_plus_strand", "alt_plus_strand"]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in by], F.col("call_class") == "mutation")
    pair = Window.partitionBy(*by, "call_class").orderBy("strand")
    after, before = (known & (F.col("strand") == a) & (f("strand").over(pair) == b) for a, b, f in (("+", "-", F.lead), ("-", "+", F.lag)))
    return classified.withColumns({f"{v}_opposite": F.coalesce(F.when(after, F.lead(v).over(pair)).when(before, F.lag(v).over(pair)), f"{v}_opposite") for v in VALUES})


def all_calls(reads: DataFrame, tiles: DataFrame, modified: dict[str, tuple[str, float]] | None = None, opposite_bases: dict[str, str] | None = None, contexts: bool = False) -> DataFrame:
    """Classified calls of all kinds, from reads with CIGAR and bases: extraction, alleles, opposite strand, classes.

    With ``contexts`` reftnc and reftnc_pyr too, as genome.trinucleotides has them.

    The genome's bases come to the reads, which are fewer than their calls, and from there on all is told within a
    molecule, which stays where it is.
    """
    found = _with_genome(reads, tiles, modified or {}, opposite_bases or {}, 0, contexts)
    return partners_evidence(classify(opposite_calls(found)))


def calls_with_alleles(reads: DataFrame, tiles: DataFrame, modified: dict[str, tuple[str, float]] | None = None) -> DataFrame:
    """extract_with_evidence with ref_plus_strand, as with_reference has it, and base_before, the genome's base in front of a call; null before a contig's first.

    The genome's bases come to the reads, so that no call moves.
    """
    return _with_genome(reads, tiles, modified or {}, {}, 1, False)


def _with_genome(reads: DataFrame, tiles: DataFrame, modified: dict[str, tuple[str, float]], opposite_bases: dict[str, str], before: int, contexts: bool) -> DataFrame:
    molecule = [*K, "seqnames"]
    met = _ranged(_scored(reads, modified).join(_reference(reads, tiles, int(before or contexts), int(contexts)).hint("merge"), molecule, "left"), modified, opposite_bases)

    def under(low: Column, high: Column) -> Column:
        some = F.filter("bases", lambda x: (high >= x["low"]) & (low < x["low"] + F.length(x["part"])))
        part = lambda x: F.substr(x["part"], F.greatest(low - x["low"] + 1, F.lit(1)).cast("int"), (high - F.greatest(low, x["low"]) + 1).cast("int"))
        return F.array_join(F.transform(some, part), "")

    more = {"ref_plus_strand": F.when(F.col(S) > F.col(E), "").otherwise(under(F.col(S), F.col(E)))}
    if before:
        more["base_before"] = F.when(F.col(S) > 1, under(F.col(S) - 1, F.col(S) - 1))
    if contexts:
        tnc = under(F.col(S) - 1, F.col(S) + 1)
        more["reftnc"] = F.when(tnc.rlike("^[ACGT]{3}$"), tnc)
    found = _extracted(_paired(met), modified, opposite_bases, more)
    return found.withColumn("reftnc_pyr", pyrimidine("reftnc")) if contexts else found
