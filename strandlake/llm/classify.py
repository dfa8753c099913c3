"""Fitting and applying subword classifiers on Spark: bounded labelled samples, one training task, scoring by scan."""

from __future__ import annotations

import pickle

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, trimmed
from .subword import Model, Scorer, Settings, calibrate, train


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id as decimal text, modulo n; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def sampled(labelled: DataFrame, rows: int, counts: dict | None = None) -> tuple[DataFrame, dict]:
    """At most ``rows`` of (doc_id, label), evenly over the labels as far as each has enough, and all labels' counts.

    Of each label those of least hash of the id, so the choice is the same in every run and at every size. A threshold
    on the hash leaves about twice as many to rank. Only ids and labels are read here, each id once.
    """
    counts = counts or {r.label: r.n for r in labelled.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    want = rows // max(1, len(counts))
    share, h = F.lit(0.0), F.xxhash64("doc_id")
    for label, n in counts.items():
        share = F.when(F.col("label") == label, F.lit(min(1.0, (2 * want + 20) / n))).otherwise(share)
    near = labelled.where((h.cast("double") / 2.0**64 + 0.5) <= share)  # doubles are fine enough for any count
    rank = F.row_number().over(Window.partitionBy("label").orderBy(h, "doc_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= want).drop("rank"), counts


def fit(docs: DataFrame, labelled: DataFrame, rows: int, settings: Settings, prior: bool) -> Model | None:
    """Trains on a sample of the labelled documents' whole texts, in one task; a fifth is held back to calibrate.

    ``rows`` bounds the sample. With ``prior``, scores follow the labels' true shares instead of the sample's. None if
    there is no labelled document to learn from.
    """
    chosen, counts = sampled(labelled, rows)
    sample = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", F.col("label").cast("string").alias("label")).agg(F.min("text").alias("text"))  # at most ``rows`` rows
    sample = sample.select("doc_id", "text", "label")

    def run(batches):
        data = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        held = [r for k, r in enumerate(data) if k % 5 == 4]
        used = [r for k, r in enumerate(data) if k % 5 != 4]
        if not used:
            return
        model = train([r[1] for r in used], [r[2] for r in used], settings)
        true = {str(k): n for k, n in counts.items()} if prior else None
        model = calibrate(model, [r[1] for r in held], [r[2] for r in held], true)
        if held:
            p = Scorer(model).probabilities([r[1] for r in held])
            right = sorted(float(q.max()) for q, r in zip(p, held, strict=True) if model.labels[int(q.argmax())] == r[2])
            model.floor = min(0.5, right[len(right) // 200]) if right else 0.0
        yield pa.RecordBatch.from_arrays([pa.array([model.dumps()], pa.binary())], names=["model"])

    got = sample.repartition(1).mapInArrow(trimmed(run), "model binary").collect()
    return pickle.loads(got[0].model) if got else None


def scored(docs: DataFrame, model: Model | None, ddl: str, row) -> DataFrame:
    """docs (doc_id, text) through row(ids, texts, scorer), which gives one record batch of the columns in ddl.

    The scorer is None where there is no model.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model and model.dumps())

    def run(batches):
        scorer = sent.value and Scorer(pickle.loads(sent.value))
        for part in slices(batches):
            yield row(part.column(0), part.column(1).to_pylist(), scorer)

    return docs.mapInArrow(trimmed(run), ddl)
