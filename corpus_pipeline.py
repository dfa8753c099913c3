"""Corpus pipeline over documents: language ID, near-copy removal, repeated-passage removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last keep the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandlake.llm.common import stored, table
from strandlake.llm.decontaminate import uncontaminated
from strandlake.llm.jaccard_join import keep_one
from strandlake.llm.language_id import fit_language, recognized
from strandlake.llm.packing import pack
from strandlake.llm.repeats import with_text_kept


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model doesn't reject; it learns from the langs of the stage's own input."""
    return recognized(docs, fit_language(docs))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies."""
    return keep_one(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the long passages that occur more than once in what is left."""
    return with_text_kept(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in windows of 4096 ids."""
    pieces = pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [("language", language), ("near_copies", near_copies), ("repeats", repeats), ("decontamination", decontamination), ("packing", packing)]

#: No stage has SQL. Tests cover the stages by themselves; of the whole they check columns, the share left and leaks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each reads what the one before it wrote."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
