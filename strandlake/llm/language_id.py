"""Language of whole texts from averaged hashed subword embeddings and a linear softmax, with calibrated rejection."""

from __future__ import annotations

import pickle

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .classify import fit, fold, scored
from .common import documents, record, slices, table, trimmed
from .subword import Model, Scorer, Settings

#: Documents that the classifier is fitted on, at most about; evenly over the languages if there are so many.
ROWS = 1600
SETTINGS = Settings(shortest=1, longest=3, passes=5, dims=8, common=0.1)
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def fit_language(docs: DataFrame, rows: int = ROWS, settings: Settings = SETTINGS, folds: int = 3, held_out: int = 1) -> Model | None:
    """A model of docs (doc_id, text, lang) outside the held-out fold, None without any; rows with a null id or lang are skipped."""
    known = docs.select(F.col("doc_id").cast("long"), F.col("lang").alias("label")).dropna()
    known = known.where(fold("doc_id", folds) != held_out).groupBy("doc_id").agg(F.min("label").alias("label"))
    return fit(documents(docs), known, rows, settings, prior=False)


def _judged(texts: list, scorer) -> tuple[list, list, list]:
    """lang_pred, score and rejected of texts."""
    known = [bool(_LETTER.search(t)) for t in texts]
    if scorer is None:
        return [UNKNOWN] * len(texts), [0.0] * len(texts), [not k for k in known]
    p = scorer.probabilities(texts)
    best, top = p.argmax(axis=1), p.max(axis=1)
    names = [scorer.model.labels[b] if k else UNKNOWN for b, k in zip(best, known, strict=True)]
    score = [float(t) if k else 0.0 for t, k in zip(top, known, strict=True)]
    return names, score, [not k or s < scorer.model.floor for s, k in zip(score, known, strict=True)]


def identify(df: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row.

    lang_pred is the likeliest learned language and score its probability; und and 0 where the text is null or has no
    letter. rejected: und, or a score under the model's floor, which 99.5 in 100 rightly told calibration texts reach
    and which is no more than a half.
    Without a model all are und, and those without a letter rejected.
    Repeated rows and null ids each give a row; other columns are ignored; an empty table gives an empty result.
    """
    ddl = "doc_id long,lang_pred string,score double,rejected boolean"

    def row(ids, texts, scorer):
        return record(ddl, ids, *_judged(texts, scorer))

    return scored(documents(df, id_col, text_col), model, ddl, row)


def recognized(df: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The rows of df that identify doesn't reject, with all columns; each row is judged by its own text, whatever its id."""
    sent = df.sparkSession.sparkContext.broadcast(model and model.dumps())

    def run(batches):
        scorer = sent.value and Scorer(pickle.loads(sent.value))
        for part in slices(batches, text_col):
            texts = [t or "" for t in part.column(text_col).to_pylist()]
            yield part.filter(pa.array([not r for r in _judged(texts, scorer)[2]], pa.bool_()))

    return df.mapInArrow(trimmed(run), df.schema)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = identify(docs, fit_language(docs))
    return out.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
