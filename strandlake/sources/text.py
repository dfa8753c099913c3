"""Text formats as DataFrames: SAM, VCF, BED and bedGraph, FASTA. Readers take a path, parsers a DataFrame of lines (value)."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.sequences import reference_length
from ..operators.intervals import restrict


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignments: qname, flag, strand, ccs_strand, seqnames, start_pos, end_pos, mapq, cigar, seq, and tags as a map.

    ``ccs_strand`` is the name's suffix, fwd or rev; end_pos follows from the CIGAR and is null for unmapped records.
    """
    f = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("@")).select(
        F.get(f, F.lit(0)).alias("qname"), F.get(f, F.lit(1)).cast("int").alias("flag"), F.get(f, F.lit(2)).alias("seqnames"), F.get(f, F.lit(3)).cast("long").alias("start_pos"), F.get(f, F.lit(4)).cast("int").alias("mapq"), F.get(f, F.lit(5)).alias("cigar"), F.get(f, F.lit(9)).alias("seq"),
        F.map_from_entries(F.transform(F.slice(f, 12, F.greatest(F.size(f) - 11, F.lit(0))), lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.substr(t, F.lit(6)).alias("v")))).alias("tags"),
    )
    rows = rows.withColumn("strand", F.when(F.col("flag").bitwiseAND(16) > 0, "-").otherwise("+")).withColumn("ccs_strand", F.regexp_extract("qname", "(fwd|rev)$", 1))
    some = F.col("cigar").rlike("[0-9][MIDNSHP=X]")
    return rows.withColumn("end_pos", F.when(some, F.col("start_pos") + reference_length("cigar") - 1))


def parse_read_groups(lines: DataFrame) -> DataFrame:
    """(id, movie, description): @RG header lines, DS as a map of its 'key=value;' pairs."""
    f = F.split("value", "\t")
    tags = F.map_from_entries(F.transform(F.slice(f, 2, F.size(f)), lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.substr(t, F.lit(4)).alias("v"))))
    return lines.where(F.col("value").startswith("@RG\t")).select(tags.alias("t")).select(F.col("t")["ID"].alias("id"), F.col("t")["PU"].alias("movie"), F.expr("str_to_map(t['DS'], ';', '=')").alias("description"))


def run_metadata(read_groups: DataFrame, runs: DataFrame) -> DataFrame:
    """read_groups (.., movie) with the run_id of the run (run_id, reads_file) whose file is named after the movie, else null.

    The movie has to be a whole part of the path between other characters than letters, digits and '_', so that m1 is not
    found in m10. A movie in the files of several runs gives a row for each.
    """
    parts = runs.select("run_id", F.explode(F.array_distinct(F.split("reads_file", "[^A-Za-z0-9_]+"))).alias("movie")).where("movie <> ''")
    return read_groups.join(parts.distinct(), "movie", "left")


def parse_vcf(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Variants of one sample, a row for each alternate its genotype has: place, alleles without their shared first base,
    qual, filter, gt, gq, ad1, ad2, depth, vaf, call_class and call_type. Unknown alternates (*, <*>) drop out.

    Insertions get start_pos = end_pos + 1, deletions the span of the bases deleted. Missing values ('.') are null, and
    sites without a genotype give no row. Columns of lines in ``keep`` stay.
    """
    f = F.split("value", "\t")
    rows = lines.where(~F.col("value").startswith("#")).select(*keep, F.get(f, F.lit(0)).alias("seqnames"), F.get(f, F.lit(1)).cast("long").alias("pos"), F.get(f, F.lit(3)).alias("ref"), F.split(F.get(f, F.lit(4)), ",").alias("alts"), F.get(f, F.lit(5)).try_cast("double").alias("qual"), F.get(f, F.lit(6)).alias("filter"), F.get(f, F.lit(8)).alias("keys"), F.split(F.get(f, F.lit(9)), ":").alias("values"))
    rows = rows.where("values IS NOT NULL").withColumn("s", F.map_from_entries(F.transform(F.split("keys", ":"), lambda k, i: F.struct(k.alias("k"), F.get("values", i).alias("v")))))
    each = rows.select("*", F.posexplode("alts").alias("i", "alt")).where(~F.col("alt").isin("*", "<*>"))
    gt = F.col("s")["GT"]
    each = each.where(F.array_contains(F.split(gt, "[/|]"), (F.col("i") + 1).cast("string")))
    ad = F.split(F.col("s")["AD"], ",")
    each = each.withColumns({"ad1": F.get(ad, F.lit(0)).try_cast("int"), "ad2": F.get(ad, F.col("i") + 1).try_cast("int"), "depth": F.col("s")["DP"].try_cast("int"), "gq": F.col("s")["GQ"].try_cast("double"), "gt": gt})
    lr, la = F.length("ref"), F.length("alt")
    kind = F.when((lr == 1) & (la == 1), "SBS").when((lr == 1) & (la > 1), "insertion").when((lr > 1) & (la == 1), "deletion").otherwise("other")
    each = each.withColumn("call_type", kind).withColumn("call_class", F.when(kind == "SBS", "SBS").otherwise("indel"))
    indel = F.col("call_type").isin("insertion", "deletion")
    start = F.when(indel, F.col("pos") + 1).otherwise(F.col("pos"))
    end = F.when(F.col("call_type") == "insertion", F.col("pos")).otherwise(F.col("pos") + lr - 1)
    cut = lambda c: F.when(indel, F.substr(c, F.lit(2))).otherwise(F.col(c))
    out = each.select(*keep, "seqnames", start.alias("start_pos"), end.alias("end_pos"), cut("ref").alias("ref"), cut("alt").alias("alt"), "qual", "filter", "gt", "gq", "ad1", "ad2", "depth", (F.col("ad2") / (F.col("ad1") + F.col("ad2"))).alias("vaf"), "call_class", "call_type")
    return out.distinct()


def restricted_lines(lines: DataFrame, regions: DataFrame) -> DataFrame:
    """VCF lines whose reference allele overlaps a region (seqnames, start_pos, end_pos); told from their first fields, before anything else is parsed."""
    f = F.split("value", "\t", 5)
    placed = lines.where(~F.col("value").startswith("#")).withColumns({"seqnames": F.get(f, F.lit(0)), "start_pos": F.get(f, F.lit(1)).cast("long")})
    placed = placed.withColumn("end_pos", F.col("start_pos") + F.length(F.get(f, F.lit(3))) - 1)
    return restrict(placed, regions).select(*lines.columns)


def read_germline_set(spark: SparkSession, files: Sequence[tuple[str, str]], regions: DataFrame | None = None) -> DataFrame:
    """Variants of an individual's VCF files (path, type) with germline_file, the last part of the path, and germline_type.

    All files are one scan; a line's source comes from the file it is in, or its folder. With ``regions`` only lines there
    are parsed. No files give an empty table.
    """
    names = [(path.rstrip("/").rsplit("/", 1)[-1], kind) for path, kind in files]
    if len({n for n, _ in names}) < len(names):
        raise ValueError("germline files must differ in the last part of their paths")
    if files:
        lines = spark.read.text([path for path, _ in files]).select("value", F.split("_metadata.file_path", "/").alias("at"))
        part = lambda k: F.url_decode(F.try_element_at("at", F.lit(k)))
        lines = lines.withColumn("germline_file", F.when(part(-1).isin(*[n for n, _ in names]), part(-1)).otherwise(part(-2)))
    else:
        lines = spark.createDataFrame([], "value string, germline_file string")
    lines = lines.select("value", "germline_file") if regions is None else restricted_lines(lines.select("value", "germline_file"), regions)
    kinds = spark.createDataFrame(names, "germline_file string, germline_type string")
    return parse_vcf(lines, ["germline_file"]).join(F.broadcast(kinds), "germline_file")  # a row for each file


def population_variants(lines: DataFrame, least: float) -> DataFrame:
    """(seqnames, pos, ref, alt) of passing variants whose INFO has an AF, AF_hom or AF_het of at least ``least``."""
    f = F.split("value", "\t")
    info = F.expr("str_to_map(info, ';', '=')")
    rows = lines.where(~F.col("value").startswith("#")).select(f[0].alias("seqnames"), f[1].cast("long").alias("pos"), f[3].alias("ref"), F.split(f[4], ",").alias("alts"), f[6].alias("filter"), f[7].alias("info")).withColumn("m", info)
    each = rows.where("filter = 'PASS'").select("*", F.posexplode("alts").alias("i", "alt"))
    often = F.greatest(*[F.coalesce(F.get(F.split(F.col("m")[k], ","), F.col("i")).cast("double"), F.lit(-1.0)) for k in ("AF", "AF_hom", "AF_het")])
    return each.where(often >= least).select("seqnames", "pos", "ref", "alt")


def variants_to_bed(variants: DataFrame) -> DataFrame:
    """(kind, seqnames, bed_start, bed_end), 0-based half-open: SNVs at their base, deletions over the reference allele, insertions one base on each side."""
    lr, la = F.length("ref"), F.length("alt")
    kind = F.when(lr == la, "snv").otherwise("indel")
    start = F.when(lr >= la, F.col("pos") - F.when(lr == la, 1).otherwise(0)).otherwise(F.col("pos") - 1)
    end = F.when(lr == la, F.col("pos")).when(lr > la, F.col("pos") + lr - 1).otherwise(F.col("pos") + 1)
    return variants.where("alt <> '*'").select(kind.alias("kind"), "seqnames", start.alias("bed_start"), end.alias("bed_end"))


def parse_bed(lines: DataFrame) -> DataFrame:
    """(seqnames, start_pos, end_pos, score): BED or bedGraph lines, 1-based; score is the fourth field if it is a number."""
    f = F.split("value", "\t")
    return lines.where(~F.col("value").rlike("^(#|track|browser|$)")).select(f[0].alias("seqnames"), (f[1].cast("long") + 1).alias("start_pos"), f[2].cast("long").alias("end_pos"), F.get(f, F.lit(3)).try_cast("double").alias("score"))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(seqnames, seq): records of a FASTA file, upper case, other letters than ACGTN as N. A record must fit a row."""
    records = spark.read.option("lineSep", ">").text(path).where("length(value) > 0")
    name = F.regexp_extract("value", r"^(\S+)", 1)
    body = F.regexp_replace(F.upper(F.regexp_replace("value", r"^[^\n]*\n?", "")), r"\s", "")
    return records.select(name.alias("seqnames"), F.regexp_replace(body, "[^ACGTN]", "N").alias("seq"))


def to_vcf_lines(calls: DataFrame, info: list[str]) -> DataFrame:
    """(value): VCF body lines of calls (seqnames, start_pos, ref, alt); other columns go to INFO, nulls left out."""
    fields = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), F.col(c).cast("string"))) for c in info]))
    return calls.select(F.concat_ws("\t", "seqnames", F.col("start_pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.when(F.size(fields) > 0, F.array_join(fields, ";")).otherwise(".")).alias("value"))


def vcf_header(calls: DataFrame, info: Sequence[str], reference: str) -> list[str]:
    """VCF header lines but those of contigs and columns; types of INFO fields follow from the columns' types."""
    types = {"boolean": "Flag", "tinyint": "Integer", "smallint": "Integer", "int": "Integer", "bigint": "Integer", "float": "Float", "double": "Float"}
    known = dict(calls.dtypes)
    rows = [f'##INFO=<ID={c},Number={0 if t == "Flag" else 1},Type={t},Description="{c}">' for c in info for t in [types.get(re.sub(r"^decimal.*", "double", known[c]), "String")]]
    return ["##fileformat=VCFv4.3", "##source=strandlake", f"##reference={reference}", *rows]


def vcf_document(calls: DataFrame, lengths: DataFrame, info: Sequence[str], reference: str) -> DataFrame:
    """(value): the lines of a VCF file of calls (seqnames, pos, ref, alt), in order: header, then calls by contig, place and alleles.

    lengths (contig_idx, seqnames, len) has a row for each contig, and contig_idx their order; calls elsewhere drop out. INFO holds the columns
    ``info``: true ones of booleans by name alone, no nulls; '%', ';', '=', ',' and white space in strings are
    percent-encoded. Lines are sorted by ranges, so the parts that write.text makes, one after the other, are one file.
    """
    kinds = dict(calls.dtypes)
    escaped = lambda c: reduce(lambda v, ch: F.replace(v, F.lit(ch), F.lit(f"%{ord(ch):02X}")), "%;=,\t\n\r ", c.cast("string"))
    field = lambda c: F.when(F.col(c), F.lit(c)) if kinds[c] == "boolean" else F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), escaped(F.col(c))))
    fields = F.array_compact(F.array(*map(field, info))) if info else F.array().cast("array<string>")
    body = calls.join(lengths.select("contig_idx", "seqnames"), "seqnames")
    line = F.concat_ws("\t", "seqnames", F.col("pos").cast("string"), F.lit("."), "ref", "alt", F.lit("."), F.lit("PASS"), F.when(F.size(fields) > 0, F.array_join(fields, ";")).otherwise("."))
    kind, order = lambda k: F.lit(k).alias("kind"), ["kind", "a", "b", "ref", "alt", "value"]
    rows = body.select(kind(3), F.col("contig_idx").cast("long").alias("a"), F.col("pos").cast("long").alias("b"), "ref", "alt", line.alias("value"))
    none = F.lit("")
    named = lengths.select(kind(1), F.col("contig_idx").cast("long").alias("a"), F.lit(0).cast("long").alias("b"), none.alias("ref"), none.alias("alt"), F.concat(F.lit("##contig=<ID="), "seqnames", F.lit(",length="), F.col("len").cast("string"), F.lit(">")).alias("value"))
    first = [(0, k, 0, "", "", v) for k, v in enumerate(vcf_header(calls, info, reference))] + [(2, 0, 0, "", "", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO")]
    head = calls.sparkSession.createDataFrame(first, "kind int, a long, b long, ref string, alt string, value string")
    return head.unionAll(named).unionAll(rows).orderBy(*order).select("value")


def write_tsv(df: DataFrame, path: str, by: list[str]) -> None:
    """One folder of tab-separated files for each combination of the given columns. Quotes are doubled; a null is nothing, an empty string is quoted."""
    df.write.partitionBy(*by).option("sep", "\t").option("header", True).option("escape", '"').csv(path)


def read_tsv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What ``write_tsv`` wrote, with its columns in the order of schema. Nothing between two tabs is a null, quotes alone an empty string."""
    return spark.read.schema(schema).option("sep", "\t").option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "\u0000").csv(path).select(*schema.names)


def write_bundle(tables: dict[str, DataFrame], path: str) -> None:
    """A folder of Parquet tables."""
    for name, df in tables.items():
        df.write.parquet(f"{path}/{name}")


def read_bundle(spark: SparkSession, path: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{path}/{name}") for name in names}
