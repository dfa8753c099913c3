"""Calls: extraction from CIGAR strings, orientation, opposite-strand annotation, classes, germline matches, filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import cigar_ranges, pyrimidine, reverse_complement
from .intervals import E, S, merge, non_duplex, overlaps_any, pad, pad_of_spec, subtract
from .molecules import K

SITE = [*K, "strand", "seqnames", "call_type", S, E]


def with_ops(points: DataFrame, reads: DataFrame) -> DataFrame:
    """points (run_id, zm, strand) with ``ops``, the ranges of their read; reads have one row for each strand of a molecule.

    The CIGAR string moves and is cut up after the join. Sorted, as Spark takes the written reads for smaller than they are and would send them to every task.
    """
    own = reads.select(*K, "strand", F.col("cigar").alias("_cigar"), F.col(S).alias("_start"))
    return points.join(own.hint("merge"), [*K, "strand"], "left").withColumn("ops", cigar_ranges("_cigar", "_start")).drop("_cigar", "_start")


def extract_calls(reads: DataFrame) -> DataFrame:
    """Calls of aligned reads (run_id, zm, strand, seqnames, start_pos, cigar): each changed base, insertion and deletion.

    Adds start_query, end_query and w. Insertions have end_pos = start_pos - 1, deletions end_query = start_query - 1.
    """
    ops = reads.select(*K, "strand", "seqnames", F.explode(cigar_ranges("cigar", S)).alias("o")).select(*K, "strand", "seqnames", "o.*")
    base = ops.where("op = 'X'").withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("len") - 1)))
    one = F.lit(1).cast("long")
    sbs = base.select(*K, "strand", "seqnames", F.lit("SBS").alias("call_type"), (F.col("r_start") + F.col("i")).alias(S), (F.col("r_start") + F.col("i")).alias(E), (F.col("q_start") + F.col("i")).alias("start_query"), (F.col("q_start") + F.col("i")).alias("end_query"), one.alias("w"))
    indels = ops.where("op IN ('I', 'D')").select(*K, "strand", "seqnames", F.when(F.col("op") == "I", "insertion").otherwise("deletion").alias("call_type"), F.col("r_start").alias(S), F.col("r_end").alias(E), F.col("q_start").alias("start_query"), F.col("q_end").alias("end_query"), F.col("len").alias("w"))
    return sbs.unionByName(indels)


def map_to_query(points: DataFrame, reads: DataFrame) -> DataFrame:
    """points (run_id, zm, strand, pos) with the query position of each reference position; null where its read has no base."""
    o = F.get(F.filter("ops", lambda o: o["op"].isin("M", "=", "X") & (o["r_start"] <= F.col("pos")) & (F.col("pos") <= o["r_end"])), F.lit(0))
    return with_ops(points, reads).withColumn("query", F.col("pos") - o["r_start"] + o["q_start"]).drop("ops")


def positions_below(reads: DataFrame, quality: str, limit: int) -> DataFrame:
    """Reference positions (run_id, zm, seqnames, start_pos, end_pos) of bases of gapless reads with quality under limit."""
    each = reads.select(*K, "seqnames", S, F.posexplode(quality).alias("i", "q")).where(F.col("q") < limit)
    return each.select(*K, "seqnames", (F.col(S) + F.col("i")).alias(S), (F.col(S) + F.col("i")).alias(E))


def opposite_calls(calls: DataFrame, alt: str = "alt_plus_strand") -> DataFrame:
    """calls with what the opposite strand of the molecule has there: opp_type, opp_start, opp_end, opp_alt; else null.

    Equal places for like kinds, containment between unlike ones, any overlap between deletions. Of several, the first
    by kind, place and alternate is taken. Modified bases (kind MDB, if there is such a column) meet what base changes
    meet, and are met by none. ``alt`` is the column of the alternate allele. A molecule's calls come together once, and
    each is compared with the list of them.
    """
    met = F.col("kind") != "MDB" if "kind" in calls.columns else F.lit(True)
    flipped = F.when(F.col("strand") == "+", "-").otherwise("+")
    there = F.when(met, F.struct(flipped.alias("strand"), F.struct(F.col("call_type").alias("opp_type"), F.col(S).alias("opp_start"), F.col(E).alias("opp_end"), F.col(alt).alias("opp_alt")).alias("call")))
    low_q, high_q = F.least(S, E), F.greatest(S, E)
    ins_q, del_q = F.col("call_type") == "insertion", F.col("call_type") == "deletion"

    def rule(x):
        o = x["call"]
        equal = (F.col(S) == o["opp_start"]) & (F.col(E) == o["opp_end"])
        ins_o, del_o = o["opp_type"] == "insertion", o["opp_type"] == "deletion"
        low_o, high_o = F.least(o["opp_start"], o["opp_end"]), F.greatest(o["opp_start"], o["opp_end"])
        inside = (low_q >= low_o) & (high_q <= high_o)
        around = (low_o >= low_q) & (high_o <= high_q)
        like = (~del_q & ~del_o & (ins_q == ins_o) & equal) | (~del_q & del_o & inside) | (del_q & ~del_o & around) | (del_q & del_o & (F.col(S) <= o["opp_end"]) & (F.col(E) >= o["opp_start"]))
        return (x["strand"] == F.col("strand")) & like

    molecule = [*K, "seqnames"]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in molecule])
    found = calls.withColumn("_there", F.collect_list(there).over(Window.partitionBy(*molecule)))
    best = F.when(known, F.array_min(F.transform(F.filter("_there", rule), lambda x: x["call"])))
    return found.withColumn("_o", best).select(*calls.columns, "_o.*")


def classify(annotated: DataFrame, alt: str = "alt_plus_strand") -> DataFrame:
    """opposite_calls with ``call_class``: mutation (both strands agree), mismatch-ds (they differ), mismatch-ss (one strand only).

    Where ref_plus_strand equals the alternate, as with modified bases: match, or mismatch-os if the opposite strand
    has a change. ``deletion_match`` tells of deletions across from deletions whether their places are equal.
    """
    both = (F.col("call_type") == "deletion") & (F.col("opp_type") == "deletion")
    placed = (F.col(S) == F.col("opp_start")) & (F.col(E) == F.col("opp_end"))
    like = F.col("call_type") == F.col("opp_type")
    if "kind" in annotated.columns:
        like = like | ((F.col("kind") == "MDB") & (F.col("opp_type") == "SBS"))
    same = like & placed & (F.col(alt) == F.col("opp_alt"))
    alone = F.col("opp_type").isNull()
    kind = F.when(alone, "mismatch-ss").when(same, "mutation").otherwise("mismatch-ds")
    if "ref_plus_strand" in annotated.columns:
        kind = F.when(F.col("ref_plus_strand") == F.col(alt), F.when(alone, "match").otherwise("mismatch-os")).otherwise(kind)
    return annotated.withColumns({"call_class": kind, "deletion_match": F.when(both, placed)})


def oriented(calls: DataFrame) -> DataFrame:
    """calls with reftnc on the synthesized strand (the read's) and the template strand (its complement), and pyrimidine-centred."""
    minus = F.col("strand") == "-"
    rc = reverse_complement("reftnc")
    return calls.withColumns({"reftnc_synthesized": F.when(minus, rc).otherwise(F.col("reftnc")), "reftnc_template": F.when(minus, F.col("reftnc")).otherwise(rc), "reftnc_pyr": pyrimidine("reftnc")})


def match_variants(calls: DataFrame, variants: DataFrame, on: list[str]) -> DataFrame:
    """calls with germline_pass (no variant of equal place and allele) and germline_types, the types of those found."""
    found = variants.groupBy(*on).agg(F.array_join(F.array_sort(F.collect_set("germline_type")), ",").alias("germline_types"))
    return calls.join(found, on, "left").withColumn("germline_pass", F.col("germline_types").isNull())


def select_germline(variants: DataFrame, types: DataFrame) -> DataFrame:
    """variants whose depth, quality and allele fraction reach the limits of their type (germline_type, min_depth, min_qual, min_vaf)."""
    return variants.join(F.broadcast(types), "germline_type").where("depth >= min_depth AND qual >= min_qual AND vaf >= min_vaf").select(*variants.columns).distinct()


def select_germline_by_class(variants: DataFrame, limits: DataFrame) -> DataFrame:
    """variants that reach all limits of their type and class: limits (germline_type, call_class, filters, min_depth, min_gq, min_vaf, min_qual).

    FILTER is compared as a whole with the listed ones. Rows are distinct; a missing value fails.
    """
    met = variants.join(F.broadcast(limits), ["germline_type", "call_class"])  # a row for each type and class
    met = met.where(F.array_contains("filters", F.col("filter")) & (F.col("depth") >= F.col("min_depth")) & (F.col("gq") >= F.col("min_gq")) & (F.col("vaf") >= F.col("min_vaf")) & (F.col("qual") >= F.col("min_qual")))
    return met.select(*variants.columns).distinct()


def read_trim(calls: DataFrame, reads: DataFrame, n: int) -> DataFrame:
    """calls with trim_pass: none of the read ends of the molecule, n positions each, is hit."""
    own = [*K, "seqnames"]
    ends = reads.select(*own, F.col(S), (F.col(S) + n - 1).alias(E)).unionAll(reads.select(*own, (F.col(E) - n + 1).alias(S), F.col(E)))
    return overlaps_any(calls, ends, own, "hit").withColumn("trim_pass", ~F.col("hit")).drop("hit")


def sbs_flank(calls: DataFrame, n: int) -> DataFrame:
    """calls with flank_pass: not within n positions of a base change of the molecule, on either side of it.

    A molecule's calls come together once, and each is compared with its base changes.
    """
    own = [*K, "seqnames"]
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in own])
    sbs = F.collect_list(F.when(F.col("call_type") == "SBS", F.struct(F.col(S).alias("s"), F.col(E).alias("e")))).over(Window.partitionBy(*own))

    def met(low, high):  # as overlap_pairs has it, adjacent ones included
        beside = (F.col(S) == F.col(E) + 1) & (low <= high) & (F.col(S) <= high + 1) & (F.col(E) >= low - 1)
        return ((F.col(S) <= high) & (F.col(E) >= low)) | beside

    near = F.exists("_sbs", lambda o: met(F.greatest(o["s"] - n, F.lit(1)), o["s"] - 1) | met(o["e"] + 1, o["e"] + n))
    return calls.withColumn("_sbs", sbs).withColumn("flank_pass", ~F.coalesce(known & near, F.lit(False))).drop("_sbs")


def indel_pad(calls: DataFrame, spec: str) -> DataFrame:
    """calls with indel_pass: outside the padded indels of the molecule; indels themselves pass."""
    own = [*K, "seqnames"]
    indels = calls.where("call_type <> 'SBS'")
    grown = pad(indels, pad_of_spec(spec, F.col("w"))).select(*own, S, E)
    return overlaps_any(calls, grown, own, "hit").withColumn("indel_pass", (F.col("call_type") != "SBS") | ~F.col("hit")).drop("hit")


def region_filter(calls: DataFrame, mask: DataFrame, name: str) -> DataFrame:
    """calls with a boolean ``name``: no position in the mask."""
    return overlaps_any(calls, mask, ["seqnames"], "hit").withColumn(name, ~F.col("hit")).drop("hit")


def region_read_filter(reads: DataFrame, fractions: DataFrame, op: str, limit: float) -> DataFrame:
    """reads of molecules whose mean covered fraction (fractions: run_id, zm, fraction) does not satisfy op limit."""
    test = {"gt": F.col("m") > limit, "gte": F.col("m") >= limit, "lt": F.col("m") < limit, "lte": F.col("m") <= limit}[op]
    bad = fractions.groupBy(*K).agg(F.avg("fraction").alias("m")).where(test)
    return reads.join(bad, K, "left_anti")


def duplex_only(calls: DataFrame, tracker: DataFrame) -> DataFrame:
    """calls with duplex_pass: every position is left on both strands of the molecule in tracker."""
    own = [*K, "seqnames"]
    one = non_duplex(tracker, own).select(*own, S, E)
    return overlaps_any(calls, one, own, "hit").withColumn("duplex_pass", ~F.col("hit")).drop("hit")


def final_calls(calls: DataFrame) -> DataFrame:
    """calls that pass all columns named '*_pass'; a null fails."""
    passes: list[Column] = [F.col(c) for c in calls.columns if c.endswith("_pass")]
    return calls.where(reduce(lambda a, b: a & b, passes, F.lit(True)))


def tracker_after(tracker: DataFrame, masks: list[DataFrame], keys: list[str]) -> DataFrame:
    """tracker without the positions of all masks."""
    return reduce(lambda t, m: subtract(t, m, keys), masks, tracker)


def unique_calls(calls: DataFrame, by: list[str]) -> DataFrame:
    return calls.select(*by).distinct()


def pivot_strands(calls: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """One row for the two strands of a mutation, values as <name>_plus and <name>_minus."""
    aggs = [F.max(F.when(F.col("strand") == s, F.col(v))).alias(f"{v}_{n}") for v in values for s, n in (("+", "plus"), ("-", "minus"))]
    return calls.groupBy(*by).agg(*aggs)


def germline_calls(calls: DataFrame, germline: list[str], by: list[str], values: list[str]) -> DataFrame:
    """Calls that a germline variant matches (not germline_pass) and that pass all filters but ``germline``, both strands in one row.

    ``by`` are columns that both strands of a mutation share, ``values`` come out as <name>_plus and <name>_minus. A null
    fails a filter; germline_pass has to be false.
    """
    aside = {"germline_pass", *germline}
    others = reduce(lambda a, b: a & b, [F.col(c) for c in calls.columns if c.endswith("_pass") and c not in aside], ~F.col("germline_pass"))
    return pivot_strands(calls.where(others), by, values)


def scope(calls: DataFrame, chromgroups: DataFrame, filtergroups: DataFrame) -> DataFrame:
    """calls once for each chromgroup (chromgroup, seqnames) and filter group (filtergroup, call_types: list, or 'all')."""
    wide = calls.join(chromgroups, "seqnames").join(F.broadcast(filtergroups), F.array_contains("call_types", F.col("call_type")) | F.array_contains("call_types", F.lit("all")))
    return wide.drop("call_types")


def merged_mask(masks: list[DataFrame]) -> DataFrame:
    return merge(reduce(lambda a, b: a.select("seqnames", S, E).unionAll(b.select("seqnames", S, E)), masks))

