"""Evidence around calls: alleles, pileups, base quality, germline support, anchoring, exempt copies."""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import sizes, steps
from .genome import context
from .intervals import E, S, coverage, overlaps_any, pad, pad_of_spec
from .molecules import K
from .tracker import failed_filters

BASES = "ACGT"
#: Flags of reads that a pileup leaves out: secondary, duplicate, supplementary, failed.
LEFT_OUT = 256 + 1024 + 2048


def filter_adapter(reads: DataFrame) -> DataFrame:
    """Reads without adapter sequence left (ma = 0)."""
    return reads.where("ma = 0")


def merge_runs(runs: list[DataFrame], partitions: int | None = None) -> DataFrame:
    """Reads of all runs of a sample, in coordinate order."""
    all_ = reduce(DataFrame.unionByName, runs)
    ordered = all_.repartitionByRange(partitions, "seqnames", S) if partitions else all_.repartitionByRange("seqnames", S)
    return ordered.sortWithinPartitions("seqnames", S)


def bc_orientation(reads: DataFrame, barcodes: DataFrame) -> DataFrame:
    """reads (.., run_id, bc_i, bc_j) with bc_orientation 'a-b': the 0-based places in the run's ordered list of ids."""
    lists = barcodes.groupBy("run_id").agg(F.array_sort(F.collect_set("barcode")).alias("ids"))
    both = reads.join(F.broadcast(lists), "run_id")
    return both.withColumn("bc_orientation", F.concat_ws("-", F.get("ids", F.col("bc_i")), F.get("ids", F.col("bc_j")))).drop("ids")


def pileup_depth(reads: DataFrame, keys: tuple = ("seqnames",)) -> DataFrame:
    """Coverage runs of reads whose flag has none of LEFT_OUT, whatever their mapping quality."""
    return coverage(reads.where(F.col("flag").bitwiseAND(LEFT_OUT) == 0), keys)


def pileup_alleles(calls: DataFrame) -> DataFrame:
    """(seqnames, start_pos, n1, n2, n3): molecules' strands that show each alternate of a base change."""
    n = [F.count_if(F.col("alt_code") == k).alias(f"n{k}") for k in (1, 2, 3)]
    return calls.where("call_type = 'SBS'").groupBy("seqnames", S).agg(*n)


def alleles(calls: DataFrame, tiles: DataFrame) -> DataFrame:
    """calls with ref_plus_strand and, alt_code steps on in ACGT, alt_plus_strand of base changes."""
    out = context(calls, tiles, 0, 0, S, "ref_plus_strand")
    at = (F.instr(F.lit(BASES), F.col("ref_plus_strand")) - 1 + F.col("alt_code")) % 4 + 1
    return out.withColumn("alt_plus_strand", F.when(F.col("ref_plus_strand").rlike("^[ACGT]$"), F.substr(F.lit(BASES), at.cast("int"), F.lit(1))))


def vcf_anchor(calls: DataFrame, tiles: DataFrame) -> DataFrame:
    """Indels with anchor_pos, the base before them, and anchor_base; base changes keep their place and have none."""
    indel = F.col("call_type") != "SBS"
    moved = calls.withColumn("anchor_pos", F.when(indel, F.col(S) - 1).otherwise(F.col(S)))
    return context(moved, tiles, 0, 0, "anchor_pos", "anchor_base").withColumn("anchor_base", F.when(indel, F.col("anchor_base")))


def vcf_alleles(calls: DataFrame, tiles: DataFrame | None = None) -> DataFrame:
    """calls (ref_plus_strand, alt_plus_strand) with pos, ref and alt as VCF has them: alleles of indels begin with the base before them.

    An indel at a contig's first base has none before it: its base is N, at pos 0. Without tiles, calls have that base as base_before.
    """
    indel = F.col("call_type") != "SBS"
    anchored = calls.withColumns({"anchor_pos": F.when(indel, F.col(S) - 1).otherwise(F.col(S)), "anchor_base": F.when(indel, F.col("base_before"))}).drop("base_before") if tiles is None else vcf_anchor(calls, tiles)
    base = F.when(F.col("call_type").isin("insertion", "deletion"), F.coalesce(F.when(F.col("anchor_base") != "", F.col("anchor_base")), F.lit("N"))).otherwise("")
    return anchored.withColumns({"pos": F.col("anchor_pos"), "ref": F.concat(base, "ref_plus_strand"), "alt": F.concat(base, "alt_plus_strand")}).drop("anchor_pos", "anchor_base")


def attach_orientation(calls: DataFrame, reads: DataFrame) -> DataFrame:
    """calls with the bc_orientation of their molecule's strand."""
    return calls.join(reads.select(*K, "strand", "bc_orientation").distinct(), [*K, "strand"], "left")


def partner_values(calls: DataFrame, by: list[str], values: list[str]) -> DataFrame:
    """calls with <name>_opposite of the equal call on the other strand of the molecule; null if there is none."""
    other = calls.select(*by, F.when(F.col("strand") == "+", "-").otherwise("+").alias("strand"), *[F.col(v).alias(f"{v}_opposite") for v in values])
    return calls.join(other, [*by, "strand"], "left")


def max_mutations(reads: DataFrame, mutations: DataFrame, most: int) -> DataFrame:
    """(run_id, zm, pass): at most ``most`` different mutations in the molecule; none passes."""
    n = mutations.select(*K, "seqnames", "call_type", S, E, "alt_code").distinct().groupBy(*K).agg(F.count(F.lit(1)).alias("n"))
    return reads.select(*K).distinct().join(n, K, "left").select(*K, (F.coalesce("n", F.lit(0)) <= most).alias("pass"))


def low_places(reads: DataFrame, values: str, least: float) -> DataFrame:
    """(run_id, zm, seqnames, places): positions of gapless reads whose value is under ``least``, one array for each read; a null value is not."""

    @F.arrow_udf("array<long>")
    def places(start: pa.Array, each: pa.Array) -> pa.Array:
        low = pc.fill_null(pc.less(each.flatten(), pa.scalar(least)), False).to_numpy(zero_copy_only=False)
        row, i = steps(sizes(each))
        ends = np.concatenate(([0], np.cumsum(np.bincount(row[low], minlength=len(each)))))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array((start.to_numpy()[row] + i)[low].astype(np.int64)))

    return reads.where(F.col(S).isNotNull()).select(*K, "seqnames", places(F.col(S).cast("long"), values).alias("places"))


def low_quality_filter(calls: DataFrame, low: DataFrame) -> DataFrame:
    """calls with qual_pass: none of the molecule's low-quality positions (run_id, zm, seqnames, start_pos, end_pos, or places) is hit."""
    if "places" in low.columns:
        return failed_filters(calls, [("low", low)]).withColumn("qual_pass", F.col("bits") == 0).drop("bits")
    return overlaps_any(calls, low, [*K, "seqnames"], "hit").withColumn("qual_pass", ~F.col("hit")).drop("hit")


def germline_reads(calls: DataFrame, pileup: DataFrame, most: int) -> DataFrame:
    """calls with germline_reads_pass: base changes whose allele has at most ``most`` reads in pileup_alleles; others pass."""
    joined = calls.join(pileup, ["seqnames", S], "left")
    own = F.when(F.col("alt_code") == 1, F.col("n1")).when(F.col("alt_code") == 2, F.col("n2")).otherwise(F.col("n3"))
    return joined.withColumn("germline_reads_pass", (F.col("call_type") != "SBS") | (F.coalesce(own, F.lit(0)) <= most)).drop("n1", "n2", "n3")


def germline_indel_regions(calls: DataFrame, indels: DataFrame, sources: list[str], spec: str) -> DataFrame:
    """calls with a '<source>_pass' for each source: outside its padded indels (source, seqnames, start_pos, end_pos, w)."""
    for name in sources:
        grown = pad(indels.where(F.col("source") == name), pad_of_spec(spec, F.col("w"))).select("seqnames", S, E)
        calls = overlaps_any(calls, grown, ["seqnames"], "_hit").withColumn(f"{name}_pass", ~F.col("_hit")).drop("_hit")
    return calls


def with_exempt_copies(calls: DataFrame, germline: list[str], others: list[str]) -> DataFrame:
    """Calls that pass all filters, and copies that need only the others, told apart by germline_exempt."""
    both: Column = reduce(lambda a, b: a & b, [F.col(c) for c in others])
    strict = reduce(lambda a, b: a & b, [F.col(c) for c in germline], both)
    return calls.where(strict).withColumn("germline_exempt", F.lit(False)).unionByName(calls.where(both).withColumn("germline_exempt", F.lit(True)))


def prune_stats(stats: DataFrame, call_classes: list[str]) -> DataFrame:
    """stats (stat, ..) without those of an analysis that no requested class needs: SBS and MDB need the one of other than indels."""
    unused = [name for name, needed in ((".indelanalysis.", {"indel"}), (".nonindelanalysis.", {"SBS", "MDB"})) if not needed & set(call_classes)]
    return stats.where(~reduce(or_, (F.coalesce(F.col("stat").contains(name), F.lit(False)) for name in unused), F.lit(False)))


def assemble(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """Distinct rows of all parts, tagged with their names."""
    return reduce(DataFrame.unionByName, [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]).distinct()


def call_quality(calls: DataFrame, reads: DataFrame, array: str) -> DataFrame:
    """calls (with start_query, end_query) and the array's values at their bases; for deletions those of both neighbours."""
    low = F.least("start_query", "end_query")
    size = F.abs(F.col("end_query") - F.col("start_query")) + 1
    got = F.slice(array, low.cast("int"), size.cast("int"))
    return calls.join(reads.select(*K, "strand", array), [*K, "strand"], "left").withColumn(f"call_{array}", got).drop(array)


def extract_mdb(reads: DataFrame, score: str, least: float) -> DataFrame:
    """Modified bases of gapless reads: (run_id, zm, strand, seqnames, start_pos, end_pos, mdb_score) of scores of at least ``least``."""
    each = reads.select(*K, "strand", "seqnames", S, F.posexplode(score).alias("i", "mdb_score")).where(F.col("mdb_score") >= least)
    return each.select(*K, "strand", "seqnames", (F.col(S) + F.col("i")).alias(S), (F.col(S) + F.col("i")).alias(E), "mdb_score")


def subread_support(calls: DataFrame, coverage_least: float, match_least: float) -> DataFrame:
    """calls (sa, highest_sa, sm, sx) with subread_pass: coverage sa / highest_sa and matches sm / (sm + sx) reach their limits; nulls fail."""
    enough = (F.col("sa") / F.col("highest_sa") >= coverage_least) & (F.col("sm") / (F.col("sm") + F.col("sx")) >= match_least)
    return calls.withColumn("subread_pass", F.coalesce(enough, F.lit(False)))


def post_germline_limits(reads: DataFrame, calls: DataFrame, passed: str, most: int) -> DataFrame:
    """(run_id, zm, pass): at most ``most`` calls on either strand among those that have passed so far."""
    n = calls.where(passed).groupBy(*K, "strand").agg(F.count(F.lit(1)).alias("n")).groupBy(*K).agg(F.max("n").alias("n"))
    return reads.select(*K).distinct().join(n, K, "left").select(*K, (F.coalesce("n", F.lit(0)) <= most).alias("pass"))


def interrogated(runs: DataFrame, kinds: DataFrame) -> DataFrame:
    """(call_class, bases): interrogated base pairs of duplex runs for mutations, and both strands' bases for other classes."""
    total = runs.agg(F.sum(F.col("depth") * (F.col(E) - F.col(S) + 1)).alias("bp"))
    return kinds.crossJoin(F.broadcast(total)).select("call_class", F.when(F.col("call_class") == "mutation", F.col("bp")).otherwise(2 * F.col("bp")).alias("bases"))


def combine_indels(spectra: DataFrame, keys: list[str]) -> DataFrame:
    """Insertion and deletion channel counts summed over filter groups: (keys, channel, count)."""
    return spectra.groupBy(*keys, "channel").agg(F.sum("count").alias("count"))


def join_list(df: DataFrame, column: str) -> DataFrame:
    """An array column as a comma-separated string."""
    return df.withColumn(column, F.array_join(F.col(column).cast("array<string>"), ","))
