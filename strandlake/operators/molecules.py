"""Reads and molecules: pairing, statistics, barcodes, quality limits, limits on calls per molecule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.sequences import canonical_pair
from .intervals import width

K = ["run_id", "zm"]


def pair_filter(reads: DataFrame) -> DataFrame:
    """Reads of molecules with exactly two: one on each strand, both on the same contig."""
    good = reads.groupBy(*K).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("strand") == "+").alias("plus"), F.count_if(F.col("strand") == "-").alias("minus"), F.min("seqnames").alias("a"), F.max("seqnames").alias("b"))
    return reads.join(good.where("n = 2 AND plus = 1 AND minus = 1 AND a = b"), K, "left_semi")


def min_strand_overlap(reads: DataFrame, least: float) -> DataFrame:
    """Molecules (run_id, zm, overlap) whose strands share at least ``least`` of the positions of either."""
    one = reads.groupBy(*K, "seqnames").agg(F.max("start_pos").alias("s"), F.min("end_pos").alias("e"), F.max(width()).alias("longest"), F.count(F.lit(1)).alias("n")).where("n = 2")
    shared = F.greatest(F.col("e") - F.col("s") + 1, F.lit(0)).cast("double") / F.col("longest")
    return one.select(*K, shared.alias("overlap")).where(F.col("overlap") >= least)


def count_molecules(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, molecules): distinct molecules of each table."""
    out = None
    for name, df in stages.items():
        one = df.select(*K).distinct().agg(F.count(F.lit(1)).alias("molecules")).select(F.lit(name).alias("stage"), "molecules")
        out = one if out is None else out.unionAll(one)
    return out


def assign_chunk(molecules: DataFrame, n: int, buckets: int = 256) -> DataFrame:
    """molecules (run_id, zm) with ``chunk`` 1..n: consecutive in order, sizes T/n with the first T%n one larger.

    Places are counted within ranges of the order, and the ranges' sizes summed, so no task sees all molecules.
    """
    order = molecules.select(*K).distinct().repartitionByRange(buckets, *K).sortWithinPartitions(*K)
    placed = order.withColumn("id", F.monotonically_increasing_id()).withColumn("part", F.shiftright("id", 33)).withColumn("at", F.col("id").bitwiseAND((1 << 33) - 1))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))  # a row for each range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"), F.sum("size").over(Window.partitionBy()).alias("t"))
    i, small, larger = F.col("base") + F.col("at"), F.floor(F.col("t") / n), F.col("t") % n
    chunk = F.when(i < larger * (small + 1), F.floor(i / (small + 1))).otherwise(larger + F.floor((i - larger * (small + 1)) / F.greatest(small, F.lit(1)))) + 1
    return placed.join(F.broadcast(bases), "part").select(*K, chunk.cast("long").alias("chunk"))


def molecule_stats(reads: DataFrame, groups: DataFrame) -> DataFrame:
    """(run_id, chromgroup, stat, value): molecules and reference bases of each group and of all contigs; none is 0.

    groups (chromgroup, seqnames) may overlap. 'all_chromgroups' is their union, 'all_chroms' every contig.
    """
    labels = groups.unionAll(groups.select("seqnames").distinct().select(F.lit("all_chromgroups").alias("chromgroup"), "seqnames").select("chromgroup", "seqnames"))
    some = reads.join(labels, "seqnames").select("run_id", "chromgroup", "zm", width().alias("bases"))
    every = some.unionAll(reads.select("run_id", F.lit("all_chroms").alias("chromgroup"), "zm", width().alias("bases")))
    stats = every.groupBy("run_id", "chromgroup").agg(F.countDistinct("zm").alias("molecules"), F.sum("bases").alias("bases"))
    names = labels.select("chromgroup").distinct().unionAll(reads.sparkSession.createDataFrame([("all_chroms",)], "chromgroup string"))
    grid = reads.select("run_id").distinct().crossJoin(F.broadcast(names))
    full = grid.join(stats, ["run_id", "chromgroup"], "left").na.fill(0, ["molecules", "bases"])
    return full.unpivot(["run_id", "chromgroup"], ["molecules", "bases"], "stat", "value")


def summed_stats(stats: DataFrame, over: str = "run_id", keys: tuple = ("chromgroup", "stat")) -> DataFrame:
    """Statistics by run and over all runs (run_id 'all_runs'), in one pass of grouping sets."""
    both = stats.groupingSets([[over, *keys], list(keys)], over, *keys).agg(F.grouping(over).alias("_all"), F.sum("value").alias("value"))
    return both.select(F.when(F.col("_all") == 1, "all_runs").otherwise(F.col(over)).alias(over), *keys, "value")


def assign_samples(reads: DataFrame, sheet: DataFrame) -> DataFrame:
    """reads (.., run_id, bc_a, bc_b) with the sample of sheet (run_id, pair, sample); unassigned reads drop out."""
    return reads.withColumn("pair", canonical_pair("bc_a", "bc_b")).join(sheet, ["run_id", "pair"])


def sheet_violations(sheet: DataFrame, known: DataFrame) -> DataFrame:
    """(rule, run_id, detail): malformed or unknown barcodes, pairs given to two samples, and samples given twice.

    sheet (run_id, pair, sample); pair holds one or two ids joined by '-'; known (barcode) lists the defined ids.
    """
    ids = F.split("pair", "-")
    shape = sheet.where(~F.col("pair").rlike("^[A-Za-z0-9_]+(-[A-Za-z0-9_]+)?$")).select(F.lit("shape").alias("rule"), "run_id", F.col("pair").alias("detail"))
    same = sheet.where((F.size(ids) == 2) & (ids[0] == ids[1])).select(F.lit("equal_ids"), "run_id", "pair")
    unknown = sheet.select("run_id", F.explode(ids).alias("barcode")).distinct().join(known, "barcode", "left_anti").select(F.lit("unknown"), "run_id", "barcode")
    clash = sheet.groupBy("run_id", "pair").agg(F.countDistinct("sample").alias("n")).where("n > 1").select(F.lit("conflict"), "run_id", "pair")
    twice = sheet.groupBy("run_id", "pair", "sample").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("repeated"), "run_id", "pair")
    return shape.unionAll(same).unionAll(unknown).unionAll(clash).unionAll(twice)


def molecule_quality(reads: DataFrame, limits: dict[str, float], at_most: dict[str, float] | None = None) -> DataFrame:
    """reads with a boolean '<column>_each' and '<column>_avg' for each limited column, over both strands of a molecule.

    ``limits`` are least values, ``at_most`` largest ones (soft-clipped bases).
    """
    w = Window.partitionBy(*K)
    least = {f"{c}_{how}": (f(c).over(w) >= v) for c, v in limits.items() for how, f in (("each", F.min), ("avg", F.avg))}
    most = {f"{c}_{how}": (f(c).over(w) <= v) for c, v in (at_most or {}).items() for how, f in (("each", F.max), ("avg", F.avg))}
    return reads.withColumns(least | most)


def max_calls(reads: DataFrame, calls: DataFrame, most: int, difference: int) -> DataFrame:
    """(run_id, zm, max_calls, strand_difference): at most ``most`` calls on each strand, and at most ``difference`` between."""
    n = calls.groupBy(*K).agg(F.count_if(F.col("strand") == "+").alias("p"), F.count_if(F.col("strand") == "-").alias("m"))
    all_ = reads.select(*K).distinct().join(n, K, "left")
    return all_.select(*K, F.coalesce(F.greatest("p", "m") <= most, F.lit(True)).alias("max_calls"), F.coalesce(F.abs(F.col("p") - F.col("m")) <= difference, F.lit(True)).alias("strand_difference"))


def max_final_calls(calls: DataFrame, most: int, kinds: list[str]) -> DataFrame:
    """calls of molecules with at most ``most`` on either strand, for each kind apart; others go for that kind only."""
    per = calls.groupBy(*K, *kinds, "strand").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    return calls.join(per.select(*K, *kinds).distinct(), [*K, *kinds], "left_anti")


def drop_molecules(x: DataFrame, bad: DataFrame) -> DataFrame:
    return x.join(bad.select(*K).distinct(), K, "left_anti")


def filter_stats(reads: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """(run_id, filter, molecules, bases) that pass each filter alone, and all of them ('all_filters')."""
    every = F.lit(True)
    for c in filters.values():
        every = every & F.coalesce(c, F.lit(False))
    rows = F.array(*[F.struct(F.lit(n).alias("filter"), F.coalesce(c, F.lit(False)).alias("ok")) for n, c in {**filters, "all_filters": every}.items()])
    each = reads.select("run_id", "zm", width().alias("bases"), F.explode(rows).alias("f"))
    return each.groupBy("run_id", F.col("f.filter").alias("filter")).agg(F.countDistinct(F.when(F.col("f.ok"), F.col("zm"))).alias("molecules"), F.coalesce(F.sum(F.when(F.col("f.ok"), F.col("bases"))), F.lit(0)).alias("bases"))
