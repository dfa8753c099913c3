"""The genome as a table of tiles, and what is read from it: bases, contexts, trinucleotide counts, unknown stretches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import flat, pyrimidine, reverse_complement
from .intervals import merge

TILE, PAD = 1000, 20


def tiled(contigs: DataFrame, tile: int = TILE, pad: int = PAD) -> DataFrame:
    """(seqnames, tile, first, seq) of contigs (seqnames, seq): pieces of ``tile`` bases with ``pad`` more on each side.

    ``first`` is the position of the piece's first base. Bases other than A, C, G, T become N.
    """
    clean = contigs.select("seqnames", F.regexp_replace(F.upper("seq"), "[^ACGTN]", "N").alias("all"))
    cut = clean.select("seqnames", F.regexp_extract_all("all", F.lit(f".{{1,{tile}}}"), F.lit(0)).alias("cut"))  # one pass, however long
    before = lambda i: F.coalesce(F.right(F.get("cut", i - 1), F.lit(pad)), F.lit(""))
    after = lambda i: F.coalesce(F.left(F.get("cut", i + 1), F.lit(pad)), F.lit(""))
    padded = cut.select("seqnames", F.transform("cut", lambda piece, i: F.concat(before(i), piece, after(i))).alias("padded"))
    each = padded.select("seqnames", F.posexplode_outer("padded").alias("tile", "seq")).where("tile IS NOT NULL")  # of an inner one the optimizer derives a filter that cuts the contig again for each tile
    first = F.greatest(F.col("tile") * tile - pad + 1, F.lit(1)).cast("long")
    return each.select("seqnames", F.col("tile").cast("long").alias("tile"), first.alias("first"), "seq")


def context(points: DataFrame, tiles: DataFrame, left: int, right: int, pos: str = "start_pos", name: str = "context", tile: int = TILE) -> DataFrame:
    """points with the bases from pos - left to pos + right, N beyond the contig's ends; up to PAD on either side."""
    near = tiles.select("seqnames", F.col("tile").alias("_tile"), F.col("first").alias("_first"), F.col("seq").alias("_bases"))
    met = points.withColumn("_tile", F.floor((F.col(pos) - 1) / tile)).join(near.hint("shuffle_hash"), ["seqnames", "_tile"], "left")  # the tiles are held, the points pass by unsorted
    at = F.col(pos) - left - F.col("_first") + 1
    missing = F.greatest(1 - at, F.lit(0))
    got = F.substr("_bases", F.greatest(at, F.lit(1)).cast("int"), (left + right + 1 - missing).cast("int"))
    bases = F.rpad(F.concat(F.repeat(F.lit("N"), missing.cast("int")), got), left + right + 1, "N")
    return met.select(*points.columns, F.explode_outer(F.array(bases)).alias(name))  # cut once, however often and by what filters it is read


def beside_units(points: DataFrame, contigs: DataFrame, left: int = 10, copies: int = 6, pos: str = "start_pos", width: str = "w") -> DataFrame:
    """points with ``before``, the ``left`` bases in front of pos, and ``ahead``, copies times width bases from pos on.

    Beyond the contig's ends they are N. The tiles' overlap follows the longest width, so that units of any length have their context.
    """
    longest = points.agg(F.max(width)).first()[0] or 0
    pad = int(max(PAD, left, copies * longest))
    tile = max(TILE, pad)
    near = tiled(contigs, tile, pad).select("seqnames", F.col("tile").alias("_tile"), F.col("first").alias("_first"), F.col("seq").alias("_bases"))
    met = points.withColumn("_tile", F.floor((F.col(pos) - 1) / tile)).join(near.hint("shuffle_hash"), ["seqnames", "_tile"], "left")
    at = (F.col(pos) - F.col("_first") + 1).cast("int")
    have = F.least(at - 1, F.lit(left))
    front, ahead = F.substr("_bases", at - have, have), F.substr("_bases", at, (F.col(width) * copies).cast("int"))
    both = F.struct(F.lpad(front, left, "N").alias("before"), F.rpad(ahead, (F.col(width) * copies).cast("int"), "N").alias("ahead"))
    return met.select(*points.columns, F.explode_outer(F.array(both)).alias("_both")).select(*points.columns, "_both.before", "_both.ahead")


def trinucleotides(points: DataFrame, tiles: DataFrame, pos: str = "start_pos") -> DataFrame:
    """points with reftnc (plus strand) and reftnc_pyr; null past a contig's end or beside an unknown base."""
    out = context(points, tiles, 1, 1, pos, "reftnc")
    out = out.withColumn("reftnc", F.when(F.col("reftnc").rlike("^[ACGT]{3}$"), F.col("reftnc")))
    return out.withColumn("reftnc_pyr", pyrimidine("reftnc"))


#: Trinucleotides by code: 16, 4 and 1 times the places of their bases in ACGT.
TRINUCLEOTIDES = [a + b + c for a in "ACGT" for b in "ACGT" for c in "ACGT"]
_CODE = np.full(256, 64, np.int16)
_CODE[list(b"ACGT")] = range(4)


def codes(raw: np.ndarray) -> np.ndarray:
    """The trinucleotide code at each base of ``raw`` (bytes); 64 and more at both ends and beside unknown bases."""
    base = _CODE[raw]
    out = np.full(len(raw), 64, np.int16)
    if len(raw) > 2:
        out[1:-1] = np.minimum(16 * base[:-2] + 4 * base[1:-1] + base[2:], 64) | (np.maximum(np.maximum(base[:-2], base[1:-1]), base[2:]) & 64)
    return out


def _folded(counts: np.ndarray) -> pa.RecordBatch:
    """(tnc, n) of the trinucleotides that occur."""
    some = np.flatnonzero(counts[:64])
    return pa.RecordBatch.from_arrays([pa.array([TRINUCLEOTIDES[k] for k in some], pa.string()), pa.array(counts[some], pa.int64())], names=["tnc", "n"])


def trinucleotide_counts(contigs: DataFrame, tile: int = TILE) -> DataFrame:
    """(tnc, n): plus-strand trinucleotides of known bases over all contigs. Each task folds its tiles to 64 counters.

    A tile with one more base on each side has just its own.
    """

    def run(batches):
        counts = np.zeros(65, np.int64)
        for batch in batches:
            if batch.num_rows:
                raw, ends = flat(batch.column(0))
                code = codes(raw)
                code[ends[:-1]] = code[ends[1:] - 1] = 64
                counts += np.bincount(np.minimum(code, 64), minlength=65)
        yield _folded(counts)

    return tiled(contigs, tile, 1).select("seq").mapInArrow(run, "tnc string,n long").groupBy("tnc").agg(F.sum("n").alias("n"))


def to_pyrimidines(counts: DataFrame) -> DataFrame:
    """(tnc, n) with the 64 trinucleotides folded to the 32 with C or T in the middle."""
    return counts.groupBy(pyrimidine("tnc").alias("tnc")).agg(F.sum("n").alias("n"))


def both_strands(counts: DataFrame) -> DataFrame:
    """(tnc, n) of both strands: each trinucleotide counts for its reverse complement too."""
    return counts.unionAll(counts.select(reverse_complement("tnc").alias("tnc"), "n")).groupBy("tnc").agg(F.sum("n").alias("n"))


def unknown_regions(contigs: DataFrame, tile: int = TILE) -> DataFrame:
    """Merged stretches of bases other than A, C, G and T, found tile by tile."""
    pieces = tiled(contigs, tile, 0)
    runs = pieces.select("seqnames", "first", F.posexplode(F.split("seq", "")).alias("i", "base")).where("base = 'N'")
    return merge(runs.select("seqnames", (F.col("first") + F.col("i")).alias("start_pos"), (F.col("first") + F.col("i")).alias("end_pos")))


def weighted_trinucleotides(runs: DataFrame, tiles: DataFrame, keys: Sequence[str] = (), tile: int = TILE) -> DataFrame:
    """(keys, tnc, n): plus-strand trinucleotides at the positions of coverage runs, weighted by their depth.

    Runs are cut at tile edges and meet their tiles; of a tile only the codes of a run's stretch are read, and each task
    folds what it meets to 64 counters for each combination of keys.
    """
    keys = list(keys)
    cut = runs.select(*keys, "seqnames", "start_pos", "end_pos", "depth").withColumn("tile", F.explode(F.sequence(F.floor((F.col("start_pos") - 1) / tile), F.floor((F.col("end_pos") - 1) / tile))))
    cut = cut.withColumns({"start_pos": F.greatest(F.col("start_pos"), F.col("tile") * tile + 1), "end_pos": F.least(F.col("end_pos"), (F.col("tile") + 1) * tile)})
    met = cut.join(tiles, ["seqnames", "tile"])
    at = F.col("start_pos") - F.col("first")  # the place of the base before the run; 0 where the contig begins with the run
    part = F.substr("seq", F.greatest(at, F.lit(1)).cast("int"), (F.col("end_pos") - F.col("start_pos") + 3 - F.when(at < 1, 1).otherwise(0)).cast("int"))
    short = (at < 1) | (F.length(part) < F.col("end_pos") - F.col("start_pos") + 3)
    part = F.when(short, F.concat(F.when(at < 1, "N").otherwise(""), part, F.lit("N"))).otherwise(part)  # a contig's end has no trinucleotide
    key = F.struct(*[F.col(k).cast("string").alias(k) for k in keys]) if keys else F.struct(F.lit("").alias("none"))
    rows = met.select(F.to_json(key).alias("key"), part.alias("part"), F.col("depth").cast("long").alias("depth"))

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            raw, ends = flat(batch.column(1))
            code = codes(raw)
            code[ends[:-1]] = code[ends[1:] - 1] = 64
            code = np.minimum(code, 64)
            names = batch.column(0).dictionary_encode()
            which = np.repeat(names.indices.to_numpy(), np.diff(ends))
            weight = np.repeat(batch.column(2).to_numpy(), np.diff(ends))
            for k, name in enumerate(names.dictionary.to_pylist()):
                own = which == k
                total = held.setdefault(name, np.zeros(65, np.int64))
                np.add.at(total, code[own], weight[own])
        for name, counts in held.items():
            out = _folded(counts)
            yield pa.RecordBatch.from_arrays([pa.array([name] * out.num_rows, pa.string()), *out.columns], names=["key", "tnc", "n"])

    folded = rows.mapInArrow(run, "key string,tnc string,n long").groupBy("key", "tnc").agg(F.sum("n").alias("n"))
    named = F.from_json("key", ",".join(f"{k} string" for k in keys) or "none string")
    return folded.select(*[named[k].alias(k) for k in keys], "tnc", "n")


def oriented_trinucleotides(runs: DataFrame, tiles: DataFrame, tile: int = TILE) -> DataFrame:
    """(bc_orientation, tnc, n) on the template strand, of coverage runs by strand and bc_orientation.

    The template is the complement of the read, so what + reads cover counts as its reverse complement.
    """
    plus = weighted_trinucleotides(runs, tiles, ["strand", "bc_orientation"], tile)
    turned = F.when(F.col("strand") == "+", reverse_complement("tnc")).otherwise(F.col("tnc"))
    return plus.groupBy("bc_orientation", turned.alias("tnc")).agg(F.sum("n").alias("n"))
