"""Mixing sources to target weights, cut at each source's exact budget.

Every document gets a hash-random key. Within a source documents stand in key order, and a running total of their word
counts says where each begins; those before the source's budget are taken. A budget above the source's size takes all
of it for as many whole epochs as fit, and the rest from the front of the same order. The running totals are
distributed: keys are uniform, so equal slices of the key range are equal ranges of the sorted source. Each source has
about as many slices as a slice has documents, the square root of its documents; slice sums are added up per source,
and each slice goes on from there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bounded, scratch, stored, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, EPOCHS = (5.0, 2.0, 1.0), 1.5, 2.0
#: Copies of one document (equal in id, source and text) that one task spells out.
COPIES = 1 << 16


def _sizes(df: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(source, doc_id, key, size, n): n rows of equal id, source and text are one."""
    bounded(df.sparkSession)
    text, name = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))
    each = df.select(F.col(source_col).cast("string").alias("source"), F.col(id_col).cast("long").alias("doc_id"), F.md5(F.concat_ws(":", name, text)).alias("key"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"))
    return each.groupBy("source", "doc_id", "key", "size").agg(F.count(F.lit(1)).alias("n"))


def _numbered(sources: DataFrame) -> DataFrame:
    """sources with ``number``, from 0 by code point and null last, counted within ranges and across them."""
    part = stored(sources.repartitionByRange(F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id()), "ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = part.groupBy("part").agg(F.count(F.lit(1)).alias("held")).select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last("source"))) - 1
    return part.withColumn("inside", inside).join(starts, "part").withColumn("number", F.col("start") + F.col("inside")).drop("part", "start", "inside")


def _targets(sources: DataFrame, weights: tuple[float, ...], share: float, epochs: float) -> DataFrame:
    """sources (source, number, source_size, rows) with ``target``: shares by weight, held to epochs * source_size.

    What a limit cuts off is shared again by weight, until no source is above its own; each round is one sum.
    """
    held = stored(sources.withColumns({"weight": F.element_at(F.array(*map(F.lit, weights)), (F.col("number") % len(weights) + 1).cast("int")), "most": epochs * F.col("source_size")}), "sources")
    total = held.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while True:
        over = F.col("weight") * level >= F.col("most")
        got = held.agg(F.count_if(over), F.sum(F.when(over, F.col("most"))), F.sum(F.when(~over, F.col("weight")))).first()
        if got[0] == full or got[2] is None:
            break
        full, level = got[0], (share * total - (got[1] or 0.0)) / got[2]
    return held.withColumn("target", F.least(F.col("weight") * level, "most"))


def _clamp(c: Column, high: Column) -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(c, high))


def mix(df: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, key, copy, size, source_size, target, taken) of every row.

    size counts words; sources in code point order, null last, have the weights in turn and share ``share`` times all
    words, none more than ``epochs`` times its own. taken is the words that the mix takes of the row over all epochs; a
    source's sum is its target rounded down. The row at the cut is taken in part. Null and empty texts have size 0. Equal
    rows are told apart by ``copy``, the earlier ones taken first. Null ids are ids like any other; other columns are
    ignored; an empty table gives an empty result. Reruns give the same rows however the table is split into files.
    """
    with scratch(df.sparkSession):
        docs = stored(_sizes(df, id_col, text_col, source_col), "sizes", keep=True)
        sums = docs.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("rows"))
        plan = stored(_targets(_numbered(sums), weights, share, epochs).select("source", "number", "source_size", "rows", "target"), "targets", keep=True)
    place = F.conv(F.substring("key", 1, 13), 16, 10).cast("double") / float(1 << 52)
    slices = F.ceil(F.sqrt("rows"))
    docs = docs.withColumnRenamed("source", "_s").join(plan, F.col("_s").eqNullSafe(F.col("source"))).withColumn("slice", F.floor(place * slices))
    before = Window.partitionBy("number").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = docs.groupBy("number", "slice").agg(F.sum(F.col("size") * F.col("n")).alias("held")).select("number", "slice", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("number", "slice").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = docs.join(starts, ["number", "slice"]).withColumn("start", F.col("start") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(inside), F.lit(0)))
    few = placed.where(F.col("n") <= COPIES).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    runs = placed.where(F.col("n") > COPIES).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES)))).repartition("key", "run")
    many = runs.withColumn("copy", F.explode(F.sequence(F.col("run") * COPIES, F.least((F.col("run") + 1) * COPIES, "n") - 1))).drop("run")
    budget = F.floor("target")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    at = F.col("start") + F.col("copy") * F.col("size")
    taken = whole * F.col("size") + _clamp(budget - whole * F.col("source_size") - at, F.col("size"))
    return few.unionByName(many).select("doc_id", "source", "key", "copy", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mixture(df: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: float = EPOCHS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: (doc_id, source, epoch, n_words, text), a row for each time that a row of df is taken.

    A text taken in part is its first n_words words, joined by single spaces. Documents without words are never taken.
    """
    text, name = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(id_col).cast("long").cast("string"), F.lit(""))
    texts = df.select(F.md5(F.concat_ws(":", name, text)).alias("key"), text.alias("text")).dropDuplicates(["key"])
    rows = mix(df, weights, share, epochs, id_col, text_col, source_col).where("taken > 0")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("taken") / F.col("size")))))
    words = F.least("size", F.col("taken") - (F.col("epoch") - 1) * F.col("size"))
    out = rows.withColumn("n_words", words).join(texts, "key")
    part = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), F.col("n_words").cast("int")), " ")
    return out.select("doc_id", "source", "epoch", "n_words", F.when(F.col("n_words") < F.col("size"), part).otherwise(F.col("text")).alias("text"))


def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _sql() -> str:
    rounds = ["l0 as (select 0::double as level)"]
    for k in range(1, 13):  # more rounds than weights and sources of the test tables need; a settled level stays
        rounds.append(f"l{k} as (select coalesce((1.5 * (select sum(source_size) from p) - coalesce(sum(most) filter (w * level >= most), 0)) / nullif(sum(w) filter (w * level < most), 0), any_value(level)) as level from p, l{k - 1})")
    return (
        r"with d as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size, md5(coalesce(doc_id::varchar, '') || ':' || coalesce(text, '')) as key from documents),"
        " s as (select source, sum(size)::bigint as source_size from d group by source),"
        " p as (select source, source_size, 2.0::double * source_size as most, [5.0::double, 2.0, 1.0][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w from s),"
        f" {', '.join(rounds)},"
        " t as (select source, source_size, least(w * level, most) as target from p, l12),"
        " r as (select doc_id, size, source_size, target, floor(target)::bigint as b, coalesce(sum(size) over (partition by d.source order by key, doc_id rows between unbounded preceding and 1 preceding), 0)::bigint as began from d join t on d.source is not distinct from t.source)"
        " select doc_id, size::bigint as size, source_size, target, (case when source_size > 0 then b // source_size * size + greatest(0, least(size, b - b // source_size * source_size - began)) else 0 end)::bigint as taken from r"
    )


OP11_SQL = _sql()
