"""Toxicity scores from averaged subword embeddings and a linear softmax, learned from labelled documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .classify import fit, fold, scored
from .common import documents, record, table
from .subword import Model, Settings

#: Labelled documents that the classifier is fitted on, at most about; half of each label if there are so many.
ROWS = 3000
SETTINGS = Settings(buckets=1 << 18, passes=24, step=3, common=1.0, sparse=1e-5)


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = ROWS, settings: Settings = SETTINGS) -> Model | None:
    """A model of labels (doc_id, toxic 0/1), from documents outside the held-out fold (crc32(doc_id) mod 5 = 0).

    Null ids and labels are skipped; a document labelled twice counts as toxic if either label says so.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("label")).dropna()
    known = known.groupBy("doc_id").agg(F.max("label").alias("label")).where(fold("doc_id", 5) != 0)
    return fit(documents(docs), known, rows, settings, prior=True)


def score_toxicity(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, predicted) of every row: the model's probability of label 1, and 1 where it is 0.5 or more.

    Null and empty texts get the score of an empty bag. Repeated rows and null ids each give a row; other columns are
    ignored; an empty table gives an empty result. Without a model, or one that knows of label 1, all score 0.
    """
    ddl = "doc_id long,score double,predicted int"
    toxic = model.labels.index("1") if model and "1" in model.labels else None

    def row(ids, texts, scorer):
        p = scorer.probabilities(texts)[:, toxic] if toxic is not None else [0.0] * len(texts)
        return record(ddl, ids, p, [int(x >= 0.5) for x in p])

    return scored(documents(df, id_col, text_col), model, ddl, row)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scores = score_toxicity(docs, model)
    return scores.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
