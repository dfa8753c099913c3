"""Interval algebra on DataFrames: overlap, subtraction, merging, padding, coverage and score tracks.

Intervals are rows with a contig, ``start_pos`` and ``end_pos`` (1-based, inclusive). A zero-width interval, the place of
an insertion, has start_pos = end_pos + 1 and overlaps only what holds both of its neighbours. Two intervals overlap if
a.start <= b.end and a.end >= b.start. Joins meet on (keys, bin), so that no contig is one task; rows with a null key
meet nothing. A pair that shares several bins is kept in the first of them only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

S, E = "start_pos", "end_pos"
CONTIG = ("seqnames",)
#: Width of a join bin, and of the tiles that windows run over; a tile's open depth is carried into the next.
BIN, TILE = 512, 1 << 20


def width(start: str = S, end: str = E) -> Column:
    return F.col(end) - F.col(start) + 1


def _bin(c: Column, size: int) -> Column:
    return F.floor(c / size)


def _binned(df: DataFrame, size: int, by: int = 0) -> DataFrame:
    """df once for each bin it touches; ``by`` widens it, and first is its first bin."""
    low, high = F.least(S, E) - by, F.greatest(S, E) + by
    return df.withColumn("first", _bin(low, size)).withColumn("bin", F.explode(F.sequence(_bin(low, size), _bin(high, size))))


def overlap_pairs(x: DataFrame, y: DataFrame, keys: Sequence[str] = CONTIG, bin_size: int = BIN, adjacent: bool = False) -> DataFrame:
    """Inner join of overlapping rows: x's columns, then y's start and end as ys, ye, and y's others but the keys.

    ``adjacent`` lets a zero-width x also meet a wider y that begins or ends beside it. x and y share no other names.
    """
    by = 1 if adjacent else 0
    left = _binned(x, bin_size, by).withColumnRenamed("first", "_fx")
    right = _binned(y, bin_size, by).withColumnRenamed("first", "_fy").withColumnRenamed(S, "ys").withColumnRenamed(E, "ye")
    hit = (F.col(S) <= F.col("ye")) & (F.col(E) >= F.col("ys"))
    if adjacent:
        hit = hit | ((F.col(S) == F.col(E) + 1) & (F.col("ys") <= F.col("ye")) & (F.col(S) <= F.col("ye") + 1) & (F.col(E) >= F.col("ys") - 1))
    return left.join(right, [*keys, "bin"]).where(hit & (F.col("bin") == F.greatest("_fx", "_fy"))).drop("bin", "_fx", "_fy")


def overlaps_any(x: DataFrame, y: DataFrame, keys: Sequence[str] = CONTIG, name: str = "hit", adjacent: bool = False, bin_size: int = BIN) -> DataFrame:
    """x with a boolean column: does any row of y with equal keys overlap it?"""
    own = [*keys, S, E]
    hits = overlap_pairs(x.select(*own).distinct(), y.select(*own).distinct(), keys, bin_size, adjacent).select(*own).distinct()
    return x.join(hits.withColumn(name, F.lit(True)), own, "left").withColumn(name, F.coalesce(name, F.lit(False))).select(*x.columns, name)


def restrict(x: DataFrame, regions: DataFrame, keys: Sequence[str] = CONTIG, bin_size: int = BIN) -> DataFrame:
    """Rows of x that overlap a region. Regions aren't merged: an insertion between two that touch is in neither."""
    own = [*keys, S, E]
    hits = overlap_pairs(x.select(*own).distinct(), regions.select(*own).distinct(), keys, bin_size).select(*own).distinct()
    return x.join(hits, own, "left_semi")


def merge(x: DataFrame, keys: Sequence[str] = CONTIG, tile: int = TILE) -> DataFrame:
    """Maximal unions of overlapping or touching intervals with equal keys: (keys, start_pos, end_pos).

    Zero-width rows vanish; null keys are equal to each other. Intervals are merged within tiles of their starts. Of each
    tile one row, with its furthest end and last start, then tells the tiles after it how far what came before reaches and
    where that began, so no task sees a whole contig but for its tiles' rows.
    """
    flat = x.where(F.col(S) <= F.col(E)).select(*keys, S, E).withColumn("tile", _bin(F.col(S), tile))
    parts = _islands(flat, [*keys, "tile"])
    earlier = Window.partitionBy(*keys).orderBy("tile").rowsBetween(Window.unboundedPreceding, -1)
    tiles = parts.groupBy(*keys, "tile").agg(F.max(E).alias("end"), F.max(S).alias("last")).withColumn("reach", F.max("end").over(earlier))
    began = F.max(F.when(F.col("reach").isNull() | (F.col("last") > F.col("reach") + 1), F.col("last"))).over(earlier)
    carried = tiles.select(*keys, "tile", "reach", began.alias("began"))
    joined = _join_same(parts, carried, [*keys, "tile"])
    island = F.when(F.col("reach").isNull() | (F.col(S) > F.col("reach") + 1), F.col(S)).otherwise(F.col("began"))
    return joined.groupBy(*keys, island.alias("island")).agg(F.min(S).alias(S), F.max(E).alias(E)).select(*keys, S, E)


def _join_same(x: DataFrame, y: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join that takes nulls for equal; so no filter for nulls goes to one side alone and parts of x in y are not computed twice."""
    named = y.withColumnsRenamed({k: f"_{k}" for k in keys})
    return x.join(named, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).drop(*(f"_{k}" for k in keys))


def _islands(x: DataFrame, keys: list[str]) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(S, E)
    before = F.max(E).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = x.withColumn("new", F.when(F.col(S) <= before + 1, 0).otherwise(1)).withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*keys, "island").agg(F.min(S).alias(S), F.max(E).alias(E)).drop("island")


def subtract(x: DataFrame, y: DataFrame, keys: Sequence[str] = CONTIG, bin_size: int = BIN, tile: int = TILE) -> DataFrame:
    """Pieces of each row of x outside all of y, with x's other columns; pieces of different rows stay apart.

    Zero-width rows of x stay unless strictly inside a merged interval of y. Each row has a first cut that ends before it,
    and a piece follows each cut. The next cut is told within tiles of the cuts' starts; the first and last cut of each
    tile alone meet those of the row's other tiles.
    """
    own = [*keys, S, E]
    rows = x.select(*own).distinct()
    cuts = overlap_pairs(rows, merge(y, keys, tile), keys, bin_size).select(*own, F.greatest("ys", S).alias("ys"), F.least("ye", E).alias("ye"))
    cuts = cuts.unionAll(rows.select(*own, (F.col(S) - 1).alias("ys"), (F.col(S) - 1).alias("ye"))).withColumn("tile", _bin(F.col("ys"), tile))
    inside, whole = Window.partitionBy(*own, "tile").orderBy("ys"), Window.partitionBy(*own).orderBy("ys")
    cuts = cuts.withColumns({"before": F.lag("ys").over(inside), "after": F.lead("ys").over(inside)})
    edges = cuts.where("before IS NULL OR after IS NULL").withColumn("after", F.coalesce("after", F.lead("ys").over(whole)))
    cuts = cuts.where("before IS NOT NULL AND after IS NOT NULL").unionAll(edges)
    pieces = cuts.select(*own, (F.col("ye") + 1).alias("s"), F.coalesce(F.col("after") - 1, E).alias("e"), (F.col("after").isNull() & (F.col("ys") < F.col(S))).alias("uncut"))
    pieces = pieces.where("s <= e OR uncut OR uncut IS NULL")
    return _join_same(x, pieces, own).withColumns({S: F.col("s"), E: F.col("e")}).select(*x.columns)


def intersect(x: DataFrame, y: DataFrame, keys: Sequence[str] = CONTIG, bin_size: int = BIN) -> DataFrame:
    """The common part of each overlapping pair, with the other columns of both."""
    pairs = overlap_pairs(x, y, keys, bin_size)
    return pairs.withColumn(S, F.greatest(S, "ys")).withColumn(E, F.least(E, "ye")).drop("ys", "ye")


def pad(x: DataFrame, by: Column | int, lengths: DataFrame | None = None) -> DataFrame:
    """Intervals grown by ``by`` on both sides, cut at 1 and, with lengths (seqnames, len), at the contig's end."""
    by = F.lit(by) if isinstance(by, int) else by
    grown = x.withColumns({S: F.greatest(F.col(S) - by, F.lit(1)), E: F.col(E) + by})
    if lengths is None:
        return grown
    return grown.join(lengths.select("seqnames", "len"), "seqnames").withColumn(E, F.least(E, "len")).select(*x.columns)


def flank(x: DataFrame, n: int, side: str) -> DataFrame:
    """The n positions beside each interval: side is 'left' or 'right'; cut at 1."""
    if side == "left":
        return x.withColumns({S: F.greatest(F.col(S) - n, F.lit(1)), E: F.col(S) - 1})
    return x.withColumns({S: F.col(E) + 1, E: F.col(E) + n})


def pad_of_spec(spec: str, length: Column) -> Column:
    """Padding from 'm<multiple>b<bases>': the greater of multiple * length and bases, in whole positions."""
    multiple, bases = (F.regexp_extract(F.lit(spec), f"{c}(\\d+)", 1).cast("long") for c in "mb")
    return F.greatest(multiple * length, bases)


def total_width(x: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return x.groupBy(*keys).agg(F.sum(width()).alias("bases"))


def _other_strand(x: DataFrame, keys: Sequence[str]) -> DataFrame:
    """x (.., strand) with ``_other``: the merged intervals (s, e) of its group's rows on the other strand; none where a key is null.

    A group, as a molecule is one, comes together once.
    """
    wide = F.when(F.col(S) <= F.col(E), F.struct(F.col(S).cast("long").alias("s"), F.col(E).cast("long").alias("e")))
    plus, minus = (F.collect_list(F.when(F.col("strand") == s, wide)).over(Window.partitionBy(*keys)) for s in "+-")
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    none = F.array().cast("array<struct<s:bigint,e:bigint>>")

    def joined(done, o):
        last = F.element_at(done, -1)
        grown = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], o["e"]).alias("e"))))
        return F.when((F.size(done) > 0) & (o["s"] <= F.try_element_at(done, F.lit(-1))["e"] + 1), grown).otherwise(F.concat(done, F.array(o)))

    found = x.withColumns({"_plus": plus, "_minus": minus})
    there = F.when(known & (F.col("strand") == "+"), F.col("_minus")).when(known & (F.col("strand") == "-"), F.col("_plus")).otherwise(none)
    return found.withColumn("_other", F.when(F.size(there) > 1, F.aggregate(F.array_sort(there), none, joined)).otherwise(there)).drop("_plus", "_minus")


def non_duplex(x: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Positions that only one strand of a molecule has left: + without -, and - without +, with their strand."""
    cuts = F.filter("_other", lambda m: (F.col(S) <= m["e"]) & (F.col(E) >= m["s"]))
    low = F.concat(F.array(F.col(S).cast("long")), F.transform("_cuts", lambda m: m["e"] + 1))
    high = F.concat(F.transform("_cuts", lambda m: m["s"] - 1), F.array(F.col(E).cast("long")))
    pieces = F.filter(F.arrays_zip(low.alias("s"), high.alias("e")), lambda p: (p["s"] <= p["e"]) | (F.size("_cuts") == 0))
    cut = _other_strand(x.where(F.col("strand").isin("+", "-")).select(*keys, S, E, "strand"), keys).withColumn("_cuts", cuts)
    return cut.withColumn("_p", F.explode(pieces)).select(*keys, F.col("_p.s").alias(S), F.col("_p.e").alias(E), "strand")


def duplex(x: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What both strands of a molecule have left: the parts of each row of x (.., strand) that the other strand has too. Zero-width rows have none."""
    parts = F.transform("_other", lambda m: F.struct(F.greatest(F.col(S), m["s"]).alias("s"), F.least(F.col(E), m["e"]).alias("e")))
    cut = _other_strand(x, keys).withColumn("_p", F.explode(F.filter(parts, lambda p: p["s"] <= p["e"])))
    return cut.withColumns({S: F.col("_p.s"), E: F.col("_p.e")}).select(*x.columns)


def coverage(x: DataFrame, keys: Sequence[str] = CONTIG, tile: int = TILE) -> DataFrame:
    """Runs (keys, start_pos, end_pos, depth) of equal depth above zero; neighbours of equal depth are one run."""
    wide = x.where(F.col(S) <= F.col(E))
    events = wide.select(*keys, F.col(S).alias("pos"), F.lit(1).alias("d")).unionAll(wide.select(*keys, (F.col(E) + 1).alias("pos"), F.lit(-1).alias("d")))
    events = events.groupBy(*keys, "pos").agg(F.sum("d").alias("d")).where("d <> 0").withColumn("tile", _bin(F.col("pos"), tile))
    per_tile = events.groupBy(*keys, "tile").agg(F.sum("d").alias("step"), F.min("pos").alias("first"))
    tiles = Window.partitionBy(*keys).orderBy("tile")
    carried = per_tile.select(*keys, "tile", F.coalesce(F.sum("step").over(tiles.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("carry"), F.lead("first").over(tiles).alias("next"))
    inside = Window.partitionBy(*keys, "tile").orderBy("pos")
    runs = events.join(carried, [*keys, "tile"]).withColumn("depth", F.col("carry") + F.sum("d").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.withColumn(E, F.coalesce(F.lead("pos").over(inside), F.col("next")) - 1)
    return runs.where("depth > 0").select(*keys, F.col("pos").alias(S), E, "depth")


def duplex_coverage(x: DataFrame, keys: Sequence[str] = CONTIG) -> DataFrame:
    """Depth in molecules: both strands of each cover the same positions, so the + strand alone counts."""
    return coverage(x.where("strand = '+'"), keys)


def odd_depth(x: DataFrame, keys: Sequence[str] = CONTIG) -> DataFrame:
    """Runs whose depth over both strands is odd; none where every molecule's strands agree."""
    return coverage(x, keys).where("depth % 2 = 1")


def coverage_at(points: DataFrame, runs: DataFrame, keys: Sequence[str] = CONTIG, bin_size: int = BIN) -> DataFrame:
    """points with ``depth``: that of their positions, 0 outside all runs; for zero width the less of both flanks'."""
    own = [*keys, S, E]
    some = points.select(*own).distinct()
    at = some.withColumn("p", F.explode(F.array_distinct(F.array(F.least(S, E), F.greatest(S, E)))))
    single = at.select(*keys, F.col("p").alias(S), F.col("p").alias(E)).distinct()
    found = overlap_pairs(single, runs.select(*own, "depth"), keys, bin_size).select(*keys, F.col(S).alias("p"), "depth")
    depth = at.join(found, [*keys, "p"], "left").groupBy(*own).agg(F.min(F.coalesce("depth", F.lit(0))).alias("depth"))
    return points.join(depth, own, "left")


def covered_fraction(reads: DataFrame, mask: DataFrame, keys: Sequence[str] = CONTIG, bin_size: int = BIN) -> DataFrame:
    """reads with ``fraction``: the share of each read's positions under the merged mask."""
    own = [*keys, S, E]
    parts = intersect(reads.select(*own).distinct().withColumns({"rs": F.col(S), "re": F.col(E)}), merge(mask, keys), keys, bin_size)
    share = parts.groupBy(*keys, F.col("rs").alias(S), F.col("re").alias(E)).agg(F.sum(width()).alias("covered"))
    return reads.join(share, own, "left").withColumn("fraction", F.coalesce("covered", F.lit(0)).cast("double") / width()).drop("covered")


def binned_track(track: DataFrame, lengths: DataFrame, size: int) -> DataFrame:
    """(seqnames, start_pos, end_pos, score): mean score of each bin of ``size`` positions, those without score as 0.

    Runs of track (seqnames, start_pos, end_pos, score) don't overlap; the last bin ends at the contig's length.
    """
    cut = track.withColumn("b", F.explode(F.sequence(_bin(F.col(S) - 1, size), _bin(F.col(E) - 1, size))))
    part = F.least(F.col(E), (F.col("b") + 1) * size) - F.greatest(F.col(S), F.col("b") * size + 1) + 1
    sums = cut.groupBy("seqnames", "b").agg(F.sum(F.col("score") * part).alias("sum"))
    grid = lengths.select("seqnames", "len", F.explode(F.sequence(F.lit(0), _bin(F.col("len") - 1, size))).alias("b"))
    out = grid.join(sums, ["seqnames", "b"], "left").withColumn(S, F.col("b") * size + 1).withColumn(E, F.least((F.col("b") + 1) * size, "len"))
    return out.select("seqnames", S, E, (F.coalesce("sum", F.lit(0.0)) / width()).alias("score"))


def threshold_track(track: DataFrame, lengths: DataFrame, size: int, op: str, limit: float) -> DataFrame:
    """Merged bins whose score is lt, lte, gt or gte ``limit``."""
    test = {"lt": F.col("score") < limit, "lte": F.col("score") <= limit, "gt": F.col("score") > limit, "gte": F.col("score") >= limit}[op]
    return merge(binned_track(track, lengths, size).where(test))


def low_depth(depth: DataFrame, lengths: DataFrame, least: int) -> DataFrame:
    """Maximal stretches of depth under ``least``; positions outside all runs have 0. lengths has a row for each contig."""
    whole = lengths.select("seqnames", F.lit(1).cast("long").alias(S), F.col("len").cast("long").alias(E)).where(F.col(S) <= F.col(E))
    return subtract(whole, depth.where(F.col("depth") >= least))


def waterfall(whole: DataFrame, masks: list[tuple[str, DataFrame]], tile: int = TILE) -> DataFrame:
    """(step, mask, removed_alone, remaining): bases that each mask removes by itself, and what is left after it in turn.

    One sweep over the starts and ends of ``whole`` and all masks tells, within tiles as in coverage, which of them are open at each base.
    """
    kinds = range(len(masks) + 1)
    parts = [whole] + [mask.where(F.col("seqnames").isNotNull()) for _, mask in masks]
    edges = F.explode(F.array(F.struct(F.col(S).alias("pos"), F.lit(1).alias("d")), F.struct((F.col(E) + 1).alias("pos"), F.lit(-1).alias("d"))))
    marks = reduce(DataFrame.unionAll, [part.where(F.col(S) <= F.col(E)).select("seqnames", edges.alias("m")).select("seqnames", "m.pos", F.lit(k).alias("k"), "m.d") for k, part in enumerate(parts)])
    events = marks.groupBy("seqnames", "pos").agg(*[F.coalesce(F.sum(F.when(F.col("k") == k, F.col("d"))), F.lit(0)).alias(f"d{k}") for k in kinds]).withColumn("tile", _bin(F.col("pos"), tile))
    per_tile = events.groupBy("seqnames", "tile").agg(F.min("pos").alias("first"), *[F.sum(f"d{k}").alias(f"step{k}") for k in kinds])
    tiles = Window.partitionBy("seqnames").orderBy("tile")
    before = tiles.rowsBetween(Window.unboundedPreceding, -1)
    carried = per_tile.select("seqnames", "tile", F.lead("first").over(tiles).alias("next"), *[F.coalesce(F.sum(f"step{k}").over(before), F.lit(0)).alias(f"carry{k}") for k in kinds])
    inside = Window.partitionBy("seqnames", "tile").orderBy("pos")
    up_to = inside.rowsBetween(Window.unboundedPreceding, 0)
    runs = _join_same(events, carried, ["seqnames", "tile"])
    runs = runs.select((F.coalesce(F.lead("pos").over(inside), F.col("next")) - F.col("pos")).alias("bases"), *[(F.col(f"carry{k}") + F.sum(f"d{k}").over(up_to)).alias(f"n{k}") for k in kinds])
    bases, sums, free = F.col("n0") * F.col("bases"), [], F.lit(True)
    for k in kinds[1:]:
        free = free & (F.col(f"n{k}") == 0)
        sums += [F.coalesce(F.sum(F.when(F.col(f"n{k}") > 0, bases)), F.lit(0)).alias(f"removed{k}"), F.coalesce(F.sum(F.when(free, bases)), F.lit(0)).alias(f"left{k}")]
    rows = [F.struct(F.lit(k).alias("step"), F.lit(name).alias("mask"), F.col(f"removed{k + 1}").alias("removed_alone"), F.col(f"left{k + 1}").alias("remaining")) for k, (name, _) in enumerate(masks)]
    return runs.agg(*sums).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
