"""Barcode sheets of one or two rounds: the rules they must keep, and the sample of each read."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequences import canonical_pair

_SHAPE = r"^[A-Za-z0-9_]+(-[A-Za-z0-9_]+)?\z"


def _sound(ids: Column) -> Column:
    """One barcode id, or two different ones joined by '-'."""
    parts = F.split(ids, "-")
    return F.coalesce(ids.rlike(_SHAPE) & F.coalesce(F.get(parts, F.lit(0)) != F.get(parts, F.lit(1)), F.lit(True)), F.lit(False))


def _pair(ids: Column) -> Column:
    parts = F.split(ids, "-")
    return F.when(_sound(ids), canonical_pair(F.get(parts, F.lit(0)), F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0)))))


def _mode(ids: Column) -> Column:
    return F.when(_sound(ids), F.when(ids.contains("-"), "different").otherwise("same"))


def sheet_pairs(sheet: DataFrame) -> DataFrame:
    """sheet (run_id, sample, barcode_ids, barcode_ids_round2) with two_rounds, and pair and mode of each round.

    An empty second round is none. A mode is 'same' for one id and 'different' for two. Malformed ids have no pair and no mode.
    """
    one, two = F.col("barcode_ids"), F.col("barcode_ids_round2")
    clean = sheet.withColumn("barcode_ids_round2", F.when(F.length(two) > 0, two))
    return clean.withColumns({"two_rounds": two.isNotNull(), "pair": _pair(one), "mode": _mode(one), "pair2": _pair(two), "mode2": _mode(two)})


def assign_rounds(reads: DataFrame, sheet: DataFrame) -> DataFrame:
    """reads (run_id, pair, pair2, ..) with sample, barcodes and round; reads of no sample drop out.

    A sample of two rounds takes the reads of both its pairs. Only reads that no such sample takes go to the samples of one
    round, by the first pair alone; a read with the first pair of two-round samples and none of their second pairs is of no
    sample. Columns of reads with the names of the three new ones are replaced. Sheets must keep ``sheet_rules``: a pair that
    is given twice gives its reads twice.
    """
    known = sheet_pairs(sheet)
    label = F.struct("sample", F.concat_ws(".", "barcode_ids", "barcode_ids_round2").alias("barcodes"), F.when(F.col("two_rounds"), 2).otherwise(1).alias("round"))
    second = known.where("two_rounds AND pair IS NOT NULL AND pair2 IS NOT NULL").select("run_id", "pair", "pair2", label.alias("_second"))
    first = known.where("NOT two_rounds AND pair IS NOT NULL").select("run_id", "pair", label.alias("_first"))
    keep = [c for c in reads.columns if c not in ("sample", "barcodes", "round")]
    found = reads.select(*keep).join(second, ["run_id", "pair", "pair2"], "left").join(first, ["run_id", "pair"], "left").withColumn("_of", F.coalesce("_second", "_first"))
    return found.where(F.col("_of").isNotNull()).select(*keep, "_of.sample", "_of.barcodes", "_of.round")


def sheet_rules(sheet: DataFrame, known: DataFrame) -> DataFrame:
    """(rule, run_id, round, detail) of all that is wrong in sheet (as in ``sheet_pairs``) and known (barcode, sequence).

    Ids by themselves: undefined, malformed, two equal ids, unknown barcode. Within a run, for ids that are sound: a pair
    given twice to samples of one round, a combination given twice to samples of two, a pair used by both, and two modes in
    a round. Over runs: a sample with a second round in some alone. Of the known: malformed, a barcode with two sequences,
    a sequence with two barcodes.
    """
    s = sheet_pairs(sheet)
    rows = F.array(F.struct(F.lit(1).alias("round"), F.col("barcode_ids").alias("ids")), F.struct(F.lit(2).alias("round"), F.col("barcode_ids_round2").alias("ids")))
    each = s.select("run_id", "sample", F.explode(rows).alias("r")).select("run_id", "sample", "r.*").where("round = 1 OR ids IS NOT NULL")
    parts = F.split("ids", "-")
    fault = F.when(F.coalesce(F.length("ids"), F.lit(0)) == 0, "undefined").when(~F.col("ids").rlike(_SHAPE), "malformed").when(F.get(parts, F.lit(0)) == F.get(parts, F.lit(1)), "equal ids")
    faults = each.withColumn("rule", fault).where("rule IS NOT NULL").select("rule", "run_id", "round", F.concat_ws(": ", "sample", "ids").alias("detail"))
    used = each.where(_sound(F.col("ids"))).select("run_id", "round", F.explode(parts).alias("barcode")).distinct()
    unknown = used.join(known, "barcode", "left_anti").select(F.lit("unknown barcode"), "run_id", "round", "barcode")

    pairs = s.where("pair IS NOT NULL").groupBy("run_id", "pair").agg(F.count_if(~F.col("two_rounds")).alias("one"), F.count_if("two_rounds").alias("two"))
    shared = F.array_compact(F.array(F.when(F.col("one") > 1, "pair given twice"), F.when((F.col("one") > 0) & (F.col("two") > 0), "pair in both rounds")))
    pair_rules = pairs.select(F.explode(shared), "run_id", F.lit(1), "pair")
    combined = s.where("pair IS NOT NULL AND pair2 IS NOT NULL").groupBy("run_id", "pair", "pair2").count().where("count > 1").select(F.lit("combination given twice"), "run_id", F.lit(2), F.concat_ws("|", "pair", "pair2"))
    modes = each.withColumn("mode", _mode(F.col("ids"))).groupBy("run_id", "round").agg(F.count_distinct("mode").alias("modes")).where("modes > 1").select(F.lit("mixed modes"), "run_id", "round", F.lit("different, same"))
    some = s.groupBy("sample").agg(F.count_distinct("two_rounds").alias("uses")).where("uses > 1").select(F.lit("second round in some runs"), F.lit(None).cast("string"), F.lit(2), "sample")

    none = (F.lit(None).cast("string"), F.lit(None).cast("int"))
    bad = known.where(~F.col("barcode").rlike(r"^[A-Za-z0-9_]+\z")).select(F.lit("malformed barcode"), *none, "barcode").distinct()
    sequences = known.groupBy("barcode").agg(F.count_distinct("sequence").alias("n")).where("n > 1").select(F.lit("barcode with two sequences"), *none, "barcode")
    barcodes = known.groupBy("sequence").agg(F.count_distinct("barcode").alias("n")).where("n > 1").select(F.lit("sequence with two barcodes"), *none, "sequence")
    return reduce(DataFrame.unionAll, [faults, unknown, pair_rules, combined, modes, some, bad, sequences, barcodes])
