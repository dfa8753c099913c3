"""A run's configuration as typed tables, and the rules it must keep as rows of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LIMITS = ("Depth", "GQ", "VAF", "QUAL")


def _items(value) -> list[str]:
    """A comma-separated string, or a list, as its trimmed items."""
    parts = value.split(",") if isinstance(value, str) else value or []
    return [str(p).strip() for p in parts if str(p).strip()]


def config_tables(spark: SparkSession, cfg: dict) -> dict[str, DataFrame]:
    """chromgroups, call_types, germline_limits, filtergroups, sheet and barcodes of a parsed configuration.

    Comma lists become rows, and 'all' chromgroups the names of all. Thresholds are doubles; what is left out is null.
    """
    groups = cfg.get("chromgroups", [])
    names = [g["chromgroup"] for g in groups]
    chroms = [(g["chromgroup"], c) for g in groups for c in _items(g["chroms"])]
    calls = []
    for t in cfg.get("call_types", []):
        where = names if _items(t["analyzein_chromgroups"]) == ["all"] else _items(t["analyzein_chromgroups"])
        for sub in t["SBSindel_call_types"]:
            calls += [(t["call_type"], t["call_class"], g, sub["SBSindel_call_type"], sub["filtergroup"], t.get("MDB_bamtag"), _number(t.get("MDB_min_score")), _number(t.get("MDB_sensitivity")), t.get("MDB_base_opposite_strand")) for g in where]
    limits = [(v["germline_vcf_type"], c, _items(v[f"{c}_FILTERS"]), *(_number(v[f"{c}_min_{x}"]) for x in _LIMITS)) for v in cfg.get("germline_vcf_types", []) for c in ("SBS", "indel")]
    filters = [(f["filtergroup"], k, None if isinstance(v, str) else _number(v), v if isinstance(v, str) else None) for f in cfg.get("filtergroups", []) for k, v in f.items() if k != "filtergroup"]
    sheet = [(r["run_id"], b["sample_id"], b.get("barcode_ids"), b.get("barcode_ids_round2")) for r in cfg.get("runs", []) for b in r.get("samples", [])]
    codes = [(b["barcode_id"], b["barcode"]) for b in cfg.get("barcodes", [])]
    make = spark.createDataFrame
    return {
        "chromgroups": make(chroms, "chromgroup string, seqnames string"),
        "call_types": make(calls, "call_type string, call_class string, chromgroup string, SBSindel_call_type string, filtergroup string, MDB_bamtag string, MDB_min_score double, MDB_sensitivity double, MDB_base_opposite_strand string"),
        "germline_limits": make(limits, "germline_type string, call_class string, filters array<string>, min_depth double, min_gq double, min_vaf double, min_qual double"),
        "filtergroups": make(filters, "filtergroup string, setting string, number double, text string"),
        "sheet": make(sheet, "run_id string, sample string, barcode_ids string, barcode_ids_round2 string"),
        "barcodes": make(codes, "barcode string, sequence string"),
    }


def _number(v) -> float | None:
    return None if v is None else float(v)


def config_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """(rule, detail): a chromosome in two groups, and call types that name unknown groups or filter groups, lack scores, or repeat."""
    chroms, calls, filters = tables["chromgroups"], tables["call_types"], tables["filtergroups"]
    shared = chroms.groupBy("seqnames").agg(F.countDistinct("chromgroup").alias("n")).where("n > 1").select(F.lit("chromosome in two groups").alias("rule"), F.col("seqnames").alias("detail"))
    group = calls.join(chroms, "chromgroup", "left_anti").select(F.lit("unknown chromgroup"), "chromgroup").distinct()
    filtergroup = calls.join(filters, "filtergroup", "left_anti").select(F.lit("unknown filtergroup"), "filtergroup").distinct()
    score = calls.where("call_class = 'MDB' AND (MDB_bamtag IS NULL OR MDB_min_score IS NULL)").select(F.lit("modified base without score"), "call_type").distinct()
    twice = calls.groupBy("call_type", "chromgroup", "SBSindel_call_type", "filtergroup").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.lit("repeated call type"), "call_type").distinct()
    return reduce(DataFrame.unionAll, [shared, group, filtergroup, score, twice])


def configured_scope(calls: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """calls (kind, call_type, seqnames, ..) once for each chromgroup and filter group that asks for their type, with to_analyze: is their class asked for too?

    Calls of other kinds than modified bases stay in each filter group of their chromgroup, since they fail their neighbours there.
    """
    asked = tables["call_types"].select("call_type", "chromgroup", "filtergroup", "SBSindel_call_type").distinct()
    scopes = asked.select("chromgroup", "filtergroup").distinct()
    wide = calls.join(tables["chromgroups"].join(scopes, "chromgroup"), "seqnames")
    found = asked.groupBy("call_type", "chromgroup", "filtergroup").agg(F.collect_set("SBSindel_call_type").alias("classes"))
    wide = wide.join(F.broadcast(found), ["call_type", "chromgroup", "filtergroup"], "left")  # a row for each configured type
    asked_for = F.coalesce(F.array_contains("classes", F.col("call_class")), F.lit(False))
    return wide.withColumn("to_analyze", asked_for).where((F.col("kind") != "MDB") | F.col("classes").isNotNull()).drop("classes")
