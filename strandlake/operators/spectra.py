"""Spectra over fixed channels, indel channels, ratio corrections, burdens, sensitivity and error probability."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sequences import pyrimidine, reverse_complement
from .molecules import K

BASES = "ACGT"


def sbs96_channels(spark: SparkSession) -> DataFrame:
    """(channel, ord): 'ACA>AAA' and so on, C before T, then the new base, the base before, the base after."""
    names = [f"{a}{r}{b}>{a}{n}{b}" for r in "CT" for n in BASES if n != r for a in BASES for b in BASES]
    return spark.createDataFrame(list(zip(names, range(len(names)), strict=True)), "channel string, ord int")


def trinucleotides(spark: SparkSession, pyrimidines: bool = False) -> DataFrame:
    names = [a + m + b for a in BASES for m in ("CT" if pyrimidines else BASES) for b in BASES]
    return spark.createDataFrame([(n,) for n in names], "tnc string")


def count_complete(df: DataFrame, channel: str, levels: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, channel, count, fraction) with every level of (channel) for each key group; absent ones count 0."""
    counts = df.groupBy(*keys, F.col(channel).alias("channel")).agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy(*keys).agg(F.sum("count").alias("total"))
    grid = totals.crossJoin(F.broadcast(levels.select("channel")))
    full = grid.join(counts, [*keys, "channel"], "left")
    return full.select(*keys, "channel", F.coalesce("count", F.lit(0)).alias("count"), (F.coalesce("count", F.lit(0)).cast("double") / F.col("total")).alias("fraction"))


def with_alt(calls: DataFrame) -> DataFrame:
    """Base changes with alttnc_pyr: the context with the new base in the middle, on the strand of reftnc_pyr.

    The new base follows from alt_code, the number of steps after the old one in ACGT.
    """
    mid = F.substring("reftnc", 2, 1)
    new = F.substr(F.lit(BASES), ((F.instr(F.lit(BASES), mid) - 1 + F.col("alt_code")) % 4 + 1).cast("int"), F.lit(1))
    alt = F.concat(F.substring("reftnc", 1, 1), new, F.substring("reftnc", 3, 1))
    return calls.withColumn("alttnc", alt).withColumn("alttnc_pyr", F.when(F.col("reftnc") == F.col("reftnc_pyr"), F.col("alttnc")).otherwise(reverse_complement("alttnc")))


def sbs96(calls: DataFrame, keys: list[str], unique: bool = False) -> DataFrame:
    """SBS-96 spectrum of calls with reftnc_pyr and alttnc_pyr; ``unique`` counts equal changes at a place once."""
    some = calls.where("reftnc_pyr IS NOT NULL")
    if unique:
        some = some.select(*keys, "seqnames", "start_pos", "reftnc_pyr", "alttnc_pyr").distinct()
    return count_complete(some.withColumn("c", F.concat_ws(">", "reftnc_pyr", "alttnc_pyr")), "c", sbs96_channels(calls.sparkSession), keys)


def sbs192_channels(spark: SparkSession) -> DataFrame:
    """(channel, label): all 192 changes of a template strand; labels start with T: for a pyrimidine, or give the other strand's change after U:."""
    names = [(f"{a}{r}{b}", f"{a}{n}{b}") for r in BASES for n in BASES if n != r for a in BASES for b in BASES]
    levels = spark.createDataFrame(names, "old string, new string")
    other = F.concat(F.lit("U:"), reverse_complement("old"), F.lit(">"), reverse_complement("new"))
    channel = F.concat_ws(">", "old", "new")
    return levels.select(channel.alias("channel"), F.when(F.substring("old", 2, 1).isin("C", "T"), F.concat(F.lit("T:"), channel)).otherwise(other).alias("label"))


def sbs192(calls: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, channel, label, count, fraction) on the template strand, of calls with strand, reftnc_template and alttnc, every channel for each key group."""
    levels = sbs192_channels(calls.sparkSession)
    alt = F.when(F.col("strand") == "-", F.col("alttnc")).otherwise(reverse_complement("alttnc"))
    some = calls.where("reftnc_template IS NOT NULL AND alttnc IS NOT NULL").withColumn("c", F.concat_ws(">", "reftnc_template", alt))
    return count_complete(some, "c", levels, keys).join(F.broadcast(levels), "channel").select(*keys, "channel", "label", "count", "fraction")  # 192 rows


def run_length(text: Column, base: Column) -> Column:
    """How often ``base`` stands at the start of text without a break."""
    return F.length(text) - F.length(F.ltrim(text, base))


def deletion_1bp(points: DataFrame) -> DataFrame:
    """channel of 1-bp deletions from ``context``, 10 bases on each side: '1:Del:<base>:<class>' on the pyrimidine strand.

    The class is the length of the base's run beside the deleted one, the longer side, up to 5.
    """
    base = F.substring("context", 11, 1)
    up, down = F.reverse(F.substring("context", 1, 10)), F.substring("context", 12, 10)
    longest = F.least(F.greatest(run_length(up, base), run_length(down, base)), F.lit(5))
    shown = F.when(base.isin("C", "T"), base).otherwise(reverse_complement(base))
    return points.withColumn("channel", F.concat(F.lit("1:Del:"), shown, F.lit(":"), longest))


def repeat_class(unit: Column, after: Column, most: int = 5) -> Column:
    """Consecutive copies of unit at the start of after, up to ``most``."""
    out = F.lit(0)
    for k in range(1, most + 1):
        out = F.when(F.substr(after, F.lit(1), F.length(unit) * k) == F.repeat(unit, F.lit(k)), k).otherwise(out)
    return out


def microhomology(unit: Column, before: Column, after: Column, longest: int = 5) -> Column:
    """Bases that a deleted unit shares with what follows it (from its front) or precedes it (from its back).

    At most its length less 1, but up to ``longest`` for units of that length and more.
    """
    out = F.lit(0)
    for k in range(1, longest + 1):
        front = F.substr(unit, F.lit(1), F.lit(k)) == F.substr(after, F.lit(1), F.lit(k))
        back = F.right(unit, F.lit(k)) == F.right(before, F.lit(k))
        out = F.when((F.length(unit) >= (k if k == longest else k + 1)) & (front | back), k).otherwise(out)
    return out


def indel_channels(spark: SparkSession, template: bool = False) -> DataFrame:
    """(channel, ord): the 83 indel channels, or the 107 of the template strand, whose 1-bp ones tell four bases apart."""
    names = [f"1:{k}:{b}:{n}" for k in ("Del", "Ins") for b in ("CTGA" if template else "CT") for n in range(6)]
    names += [f"{w}:{k}:R:{n}" for k in ("Del", "Ins") for w in range(2, 6) for n in range(6)]
    names += [f"{w}:Del:M:{n}" for w in range(2, 6) for n in range(1, 6 if w == 5 else w)]
    return spark.createDataFrame(list(zip(names, range(len(names)), strict=True)), "channel string, ord int")


def indel_channel(indels: DataFrame, template: bool = False) -> DataFrame:
    """indels (call_type, w, unit, before, after; strand for the template) with their channel; null where the unit has an unknown base.

    unit is what is deleted or inserted, after what follows it, five units long. 1-bp channels name the base on the
    pyrimidine strand, or on the template strand, which is opposite the read's, and the longer run beside it, up to 5.
    Others tell the copies that follow, or for deletions without one the microhomology.
    """
    unit, before, after = F.col("unit"), F.col("before"), F.col("after")
    kind = F.when(F.col("call_type") == "deletion", "Del").otherwise("Ins")
    own = F.col("strand") == "-" if template else unit.isin("C", "T")
    longest = F.least(F.greatest(run_length(F.reverse(before), unit), run_length(after, unit)), F.lit(5))
    one = F.concat_ws(":", F.lit("1"), kind, F.when(own, unit).otherwise(reverse_complement(unit)), longest.cast("string"))
    copies, shared, size = repeat_class(unit, after), microhomology(unit, before, after), F.least(F.col("w"), F.lit(5)).cast("string")
    more = F.when((kind == "Del") & (copies == 0) & (shared > 0), F.concat_ws(":", size, kind, F.lit("M"), shared.cast("string"))).otherwise(F.concat_ws(":", size, kind, F.lit("R"), copies.cast("string")))
    return indels.withColumn("channel", F.when(unit.rlike("^[ACGT]+$"), F.when(F.col("w") == 1, one).otherwise(more)))


def indel_spectrum(indels: DataFrame, keys: list[str], template: bool = False) -> DataFrame:
    """(keys, channel, count, fraction) over all indel channels."""
    some = indel_channel(indels, template).where("channel IS NOT NULL").withColumnRenamed("channel", "c")
    return count_complete(some, "c", indel_channels(indels.sparkSession, template), keys)


def tnc_ratio(observed: DataFrame, reference: DataFrame) -> DataFrame:
    """(tnc, ratio): share of each trinucleotide in observed (tnc, n) over its share in reference."""
    share = lambda d, name: d.crossJoin(F.broadcast(d.agg(F.sum("n").alias("t")))).select("tnc", (F.col("n").cast("double") / F.col("t")).alias(name))
    return share(observed, "a").join(share(reference, "b"), "tnc").select("tnc", (F.col("a") / F.col("b")).alias("ratio"))


def correct_counts(spectrum: DataFrame, ratio: DataFrame, keys: list[str]) -> DataFrame:
    """spectrum with corrected = count / ratio of its trinucleotide (0 where that is 0) and its new fraction."""
    own = spectrum.withColumn("tnc", F.substring("channel", 1, 3)).join(F.broadcast(ratio), "tnc", "left")
    fixed = own.withColumn("corrected", F.when(F.col("ratio") > 0, F.col("count") / F.col("ratio")).otherwise(0.0)).drop("tnc", "ratio")
    totals = fixed.groupBy(*keys).agg(F.sum("corrected").alias("all"))
    return fixed.join(totals, keys).withColumn("corrected_fraction", F.when(F.col("all") > 0, F.col("corrected") / F.col("all")).otherwise(0.0)).drop("all")


def _regularized_gamma(a: float, x: float) -> float:
    """Lower regularized incomplete gamma P(a, x): its series below a + 1, its continued fraction above."""
    if x <= 0:
        return 0.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return total * scale
    tiny = 1e-300
    b = x + 1 - a
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1) < 1e-16:
            break
    return 1 - scale * h


def gamma_quantile(p: float, a: float) -> float:
    """x with P(a, x) = p, by bisection."""
    if a <= 0:
        return 0.0
    low, high = 0.0, max(1.0, a)
    while _regularized_gamma(a, high) < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        if mid in (low, high):
            break
        low, high = (mid, high) if _regularized_gamma(a, mid) < p else (low, mid)
    return (low + high) / 2


def poisson_ci(df: DataFrame, count: str, level: float = 0.95) -> DataFrame:
    """df with the exact Poisson interval of a count, which may be fractional, as <count>_lci and <count>_uci."""
    tail = (1 - level) / 2

    @F.pandas_udf("lci double, uci double")
    def both(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for k in parts:
            found = {v: (gamma_quantile(tail, v), gamma_quantile(1 - tail, v + 1)) for v in k.dropna().unique()}  # each count once
            yield pd.DataFrame([found.get(v, (None, None)) for v in k], columns=["lci", "uci"], dtype=float)

    return df.withColumn("_ci", both(F.col(count).cast("double"))).withColumn(f"{count}_lci", F.col("_ci.lci")).withColumn(f"{count}_uci", F.col("_ci.uci")).drop("_ci")


def burdens(counts: DataFrame, interrogated: DataFrame, keys: list[str]) -> DataFrame:
    """counts (keys, num_calls) over interrogated (keys, bases), with confidence intervals of both calls and burden."""
    joined = poisson_ci(counts.join(interrogated, keys), "num_calls")
    return joined.withColumns({f"burden{s}": F.col(f"num_calls{s}") / F.col("bases") for s in ("", "_lci", "_uci")})


def group_quantile(df: DataFrame, keys: list[str], column: str, q: float, name: str) -> DataFrame:
    """df with the linearly interpolated q-quantile of a column over each group."""
    return df.join(df.groupBy(*keys).agg(F.percentile(column, q).alias(name)), keys)


def high_confidence(variants: DataFrame, sources: int, q: float) -> DataFrame:
    """(seqnames, start_pos, end_pos, alt_code) in all ``sources``, of depth and quality between the q and 1 - q quantiles of each."""
    out = variants
    for c in ("depth", "qual"):
        limits = variants.groupBy("source").agg(F.percentile(c, q).alias(f"{c}_low"), F.percentile(c, 1 - q).alias(f"{c}_high"))
        out = out.join(F.broadcast(limits), "source").where(f"{c} BETWEEN {c}_low AND {c}_high")
    return out.groupBy("seqnames", "start_pos", "end_pos", "alt_code").agg(F.countDistinct("source").alias("n")).where(F.col("n") == sources).drop("n")


def sensitivity_variants(variants: DataFrame, limits: dict[str, dict[str, float]], genotype: str, files: int, contigs: DataFrame, population: DataFrame) -> DataFrame:
    """Germline variants sure enough to measure sensitivity by: (seqnames, start_pos, end_pos, ref, alt, call_class, call_type).

    variants are those of parse_vcf with germline_file. limits hold for each call_class depth, gq and qual, the quantiles
    of their file that a variant reaches, and min_vaf and max_vaf; a file's quantiles are over its variants of all
    classes. genotype is heterozygous (one allele of two is 1) or homozygous (both are). A variant has to be found in
    all ``files``, on one of ``contigs`` (seqnames) and in ``population``, which has the columns returned. A missing
    value fails.
    """
    classes = list(limits)
    values = ("depth", "gq", "qual")
    of_file = variants.groupBy("germline_file").agg(*[F.percentile(v, [limits[c][v] for c in classes]).alias(f"{v}_least") for v in values])
    at = F.array_position(F.array(*map(F.lit, classes)), F.col("call_class"))
    reached = [F.col(v) >= F.try_element_at(F.col(f"{v}_least"), at.cast("int")) for v in values]
    within = [F.when(F.col("call_class") == c, F.col("vaf").between(limits[c]["min_vaf"], limits[c]["max_vaf"])) for c in classes]
    first = [F.get(F.split("gt", "[^0-9.]"), F.lit(k)) == "1" for k in (0, 1)]
    wanted = {"heterozygous": first[0] != first[1], "homozygous": first[0] & first[1]}[genotype]
    site = ["seqnames", "start_pos", "end_pos", "ref", "alt", "call_class", "call_type"]
    known = variants.where(at > 0).join(of_file, "germline_file").where(reduce(lambda a, b: a & b, reached, F.coalesce(*within) & wanted))
    shared = known.select("germline_file", *site).distinct().groupBy(*site).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == files).drop("n")
    return shared.join(contigs.select("seqnames").distinct(), "seqnames", "left_semi").join(population.select(*site).distinct(), site, "left_semi").select(*site)


def detections(variants: DataFrame, calls: DataFrame, on: list[str]) -> DataFrame:
    """variants with the number of molecules whose calls show them; 0 if none does."""
    found = calls.groupBy(*on).agg(F.countDistinct(*K).alias("detections"))
    return variants.join(found, on, "left").na.fill(0, ["detections"])


def sensitivity(seen: DataFrame, keys: list[str], least: int, default: float = 1.0) -> DataFrame:
    """(keys, sensitivity, source): detections over coverage, twice that for heterozygous variants, at most 1.

    seen has detections, coverage, heterozygous. Groups of under ``least`` detections get the default.
    """
    sums = seen.groupBy(*keys).agg(F.sum("detections").alias("d"), F.sum(F.col("coverage") / F.when(F.col("heterozygous"), 2.0).otherwise(1.0)).alias("c"))
    enough = (F.col("d") >= least) & (F.col("c") > 0)
    return sums.select(*keys, F.when(enough, F.least(F.col("d") / F.col("c"), F.lit(1.0))).otherwise(default).alias("sensitivity"), F.when(enough, "calculated").otherwise("default").alias("source"))


def borrowed(sens: DataFrame, keys: list[str]) -> DataFrame:
    """sens with defaults replaced by the calculated value of another chromgroup of the same keys, if there is one."""
    own = sens.where("source = 'calculated'").groupBy(*keys).agg(F.min(F.struct("chromgroup", "sensitivity")).alias("o"))
    j = sens.join(own, keys, "left")
    take = (F.col("source") == "default") & F.col("o").isNotNull()
    return j.withColumn("sensitivity", F.when(take, F.col("o.sensitivity")).otherwise(F.col("sensitivity"))).withColumn("source", F.when(take, F.concat(F.lit("borrowed from "), F.col("o.chromgroup"))).otherwise(F.col("source"))).drop("o")


def corrected_burdens(burden: DataFrame, sens: DataFrame, keys: list[str]) -> DataFrame:
    """burden rows, and the same again divided by sensitivity (its root for single-strand classes), told apart by sensitivity_corrected."""
    root = F.when(F.col("call_class").startswith("mismatch"), F.sqrt("sensitivity")).otherwise(F.col("sensitivity"))
    fixed = burden.join(sens.select(*keys, "sensitivity"), keys).withColumn("burden", F.col("burden") / root).drop("sensitivity")
    return burden.withColumn("sensitivity_corrected", F.lit(False)).unionByName(fixed.withColumn("sensitivity_corrected", F.lit(True)))


def error_probability(burden: DataFrame, shares: DataFrame) -> DataFrame:
    """(channel, error): for each pyrimidine channel, the chance that both strands err alike at a base.

    burden (channel, burden) holds all 192 channels; shares (tnc, share) those of trinucleotides on either strand.
    """
    ref, alt = F.substring("channel", 1, 3), F.substring("channel", 5, 3)
    here = F.substring("channel", 2, 1).isin("C", "T")
    folded = F.when(here, F.col("channel")).otherwise(F.concat_ws(">", reverse_complement(ref), reverse_complement(alt)))
    pairs = burden.groupBy(folded.alias("channel")).agg(F.max(F.when(here, F.col("burden"))).alias("burden"), F.max(F.when(~here, F.col("burden"))).alias("other"))
    pairs = pairs.where("burden IS NOT NULL AND other IS NOT NULL").withColumn("tnc", ref)
    both = shares.alias("s").join(shares.select(reverse_complement("tnc").alias("tnc"), F.col("share").alias("share_rc")), "tnc")
    return pairs.join(F.broadcast(both), "tnc").select("channel", (F.col("burden") * F.col("other") * (F.col("share") + F.col("share_rc"))).alias("error"))


def error_probabilities(counts: DataFrame, interrogated: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """(target, channel, error): the chance that both strands err alike at a base, for all 96 pyrimidine channels and in total.

    counts (channel, n) are the single-strand changes of template strands, interrogated (tnc, n) the bases of both
    strands that could show them. Their burdens are weighted by the shares of trinucleotides of each of ``targets``
    (tnc, n), again of both strands. A channel without calls, bases or share has 0; total sums the 96. The two channels of a
    pair are folded to one row, so that nothing is joined with itself.
    """
    old, new = F.substring("channel", 1, 3), F.substring("channel", 5, 3)
    here = F.substring("channel", 2, 1).isin("C", "T")
    seen = counts.select(old.alias("tnc"), F.when(here, F.col("channel")).otherwise(F.concat_ws(">", reverse_complement(old), reverse_complement(new))).alias("channel"), here.alias("here"), F.col("n").alias("calls"))
    burden = seen.join(interrogated.where("n > 0"), "tnc").withColumn("burden", F.col("calls") / F.col("n"))
    both = burden.groupBy("channel").agg(*[F.sum(F.when(F.col("here") == side, F.col("burden"))).alias(name) for side, name in ((True, "own"), (False, "other"))])
    shares = None
    for name, tnc in targets.items():
        part = tnc.groupBy(pyrimidine("tnc").alias("tnc")).agg(F.sum("n").alias("n")).crossJoin(F.broadcast(tnc.agg(F.sum("n").alias("total"))))  # one row
        part = part.select(F.lit(name).alias("target"), "tnc", (F.col("n") / F.col("total")).alias("share"))
        shares = part if shares is None else shares.unionAll(part)
    levels = sbs96_channels(counts.sparkSession).select("channel", old.alias("tnc"), F.explode(F.array(*map(F.lit, targets))).alias("target"))
    each = levels.join(both, "channel", "left").join(shares, ["target", "tnc"], "left")
    error = F.coalesce(F.col("own") * F.col("other") * F.col("share"), F.lit(0.0))
    sums = each.withColumn("error", error).groupingSets([["target", "channel"], ["target"]], "target", "channel").agg(F.sum("error").alias("error"))
    return sums.select("target", F.coalesce("channel", F.lit("total")).alias("channel"), "error")


def retained(requested: DataFrame) -> DataFrame:
    """requested (call_type, call_class) and single-strand base changes, which error probabilities need whether asked for or not."""
    return requested.select("call_type", "call_class").unionAll(requested.sparkSession.sql("SELECT 'SBS' AS call_type, 'mismatch-ss' AS call_class")).distinct()


def burden_grid(calls: DataFrame, requested: DataFrame, interrogated: DataFrame, duplex: DataFrame, stranded: DataFrame, references: dict[str, tuple[DataFrame, DataFrame]], site: list[str]) -> DataFrame:
    """Burden rows of {all, unique} calls x {uncorrected, each reference}: (call_type, call_class, unique_calls, reftnc_corrected, reference, num_calls, num_calls_noncorrected, bases).

    calls have kind, call_type, call_class, reftnc_pyr, reftnc_template (null but for base changes and modified bases)
    and ``site``. interrogated has one row (bp). duplex (tnc, n) holds the interrogated pyrimidine trinucleotides of base pairs, stranded (tnc, n) those
    of both strands' templates. references name genome counts to correct to: (pyrimidine, template). Calls are counted
    once, mutations by site and then all by trinucleotide; the grid is made of those few rows. Unique calls are told of mutations
    alone, corrections of base changes and modified bases, by pyrimidine for base-change mutations and by template for the
    rest. Uncorrected rows have all interrogated base pairs, or twice that for single-strand classes, corrected ones those
    with a trinucleotide. Helper classes that were not requested drop out.
    """
    mutation = F.col("call_class") == "mutation"
    by_pyr = (F.col("kind") == "SBS") & mutation
    tnc = F.when(by_pyr, F.col("reftnc_pyr")).otherwise(F.col("reftnc_template"))
    own = ["kind", "call_type", "call_class"]
    sites = calls.groupBy(*own, tnc.alias("tnc"), *[F.when(mutation, F.col(c)).alias(c) for c in site]).agg(F.count(F.lit(1)).alias("n"))  # of other classes a row for each trinucleotide
    few = sites.groupBy(*own, "tnc").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("unique"))
    wide = few.select(*own, "tnc", F.inline(F.array(F.struct(F.lit(False).alias("unique_calls"), F.col("all").alias("n")), F.struct(F.lit(True).alias("unique_calls"), F.col("unique").alias("n"))))).where(~F.col("unique_calls") | mutation)
    pairs = duplex.agg(F.sum("n").alias("bp")).crossJoin(stranded.agg(F.sum("n").alias("both")))
    has = F.col("kind").isin("SBS", "MDB")
    plain = wide.groupBy(*own, "unique_calls").agg(F.sum("n").alias("num_calls")).crossJoin(F.broadcast(interrogated.select("bp")))
    bases = F.when(mutation, F.col("bp")).otherwise(2 * F.col("bp"))
    none = F.lit(None)
    rows = plain.select(*own, "unique_calls", F.when(has, F.lit(False)).alias("reftnc_corrected"), none.cast("string").alias("reference"), F.col("num_calls").cast("double").alias("num_calls"), none.cast("long").alias("num_calls_noncorrected"), bases.alias("bases"))
    for name, (pyr, template) in references.items():
        ratios = tnc_ratio(duplex, pyr).withColumn("side", F.lit(True)).unionByName(tnc_ratio(stranded, template).withColumn("side", F.lit(False)))
        met = wide.where(has & F.col("tnc").isNotNull()).withColumn("side", by_pyr).join(ratios.select("tnc", "side", "ratio"), ["tnc", "side"], "left")
        fixed = met.groupBy(*own, "unique_calls").agg(F.sum(F.when(F.col("ratio") > 0, F.col("n") / F.col("ratio")).otherwise(0.0)).alias("num_calls"), F.sum("n").alias("num_calls_noncorrected"))
        fixed = fixed.where(by_pyr | ~F.col("unique_calls")).crossJoin(F.broadcast(pairs))  # one row of sums
        rows = rows.unionByName(fixed.select(*own, "unique_calls", F.lit(True).alias("reftnc_corrected"), F.lit(name).alias("reference"), "num_calls", "num_calls_noncorrected", F.when(by_pyr, F.col("bp")).otherwise(F.col("both")).alias("bases")))
    told = F.when(mutation | F.col("reftnc_corrected"), F.col("unique_calls"))
    return rows.withColumn("unique_calls", F.coalesce(told, F.lit(None))).join(requested.select("call_type", "call_class").distinct(), ["call_type", "call_class"], "left_semi").drop("kind")
