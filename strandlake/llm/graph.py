"""Connected components of an edge table, by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction: every neighbour is linked to the smallest node of its neighbourhood instead."""
    if large:
        around = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    moved = around.where("b > a") if large else around.unionAll(least.select("a", F.col("a").alias("b")))
    return moved.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of edges (a, b: long) reaches, itself included.

    Loops and repeated edges are allowed; an empty edge table gives an empty result. Every round is written to the
    shared folder; rounds grow with the logarithm of the largest component.
    """
    with scratch(edges.sparkSession):
        now = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
        seen = None
        while True:
            now = stored(_star(_star(now, True), False), "edges")
            mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if mark == seen or not mark[0]:
                break
            seen = mark
        now = stored(now, "edges", keep=True)
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots.select("node", F.col("node").alias("component")))
