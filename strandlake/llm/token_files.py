"""Token-id files: documents in ascending id order, their ids in directly addressable codes.

A file is a Parquet table of segments in order, each of whole documents with about SEGMENT ids: ``part`` and
``before`` (its file and the ids before it there), ``doc_ids``, ``lengths`` (ids per document), ``n_tokens`` and ``codes`` (dac.encode of all its ids). The
segment of a document is found by the statistics of ``first_doc``, and any id in it by dac.Reader without decoding.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import dac
from .common import documents, new_path, record, slices, table, trimmed
from .tokens import AT_ONCE, encoder

VOCAB, END_ID = "word_bpe_49k.json", 1
#: Ids after which a segment is closed; a longer document is a segment of its own.
SEGMENT = 1 << 17

_SEGMENTS = "part int, before long, first_doc long, last_doc long, doc_ids array<long>, lengths array<long>, n_tokens long, codes binary"
_ARROW = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("first_doc", pa.int64()), ("last_doc", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("codes", pa.binary())])


def write_tokens(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocab: str = VOCAB, end_id: int = END_ID) -> None:
    """Writes the ids of every text of df, each with end_id last, as segments in ascending id order.

    Null and empty texts have end_id alone. Rows of equal id keep the order of their texts, and null ids come first.
    Other columns are ignored; an empty table gives an empty file.
    """
    ordered = documents(df, id_col, text_col).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        coder, part, before = encoder(vocab, end_id), TaskContext.get().partitionId(), 0
        ids, sizes, codes, held = [], [], [], 0

        def closed():
            nonlocal ids, sizes, codes, held, before
            known = [i for i in ids if i is not None]
            row = [part, before, known[0] if known else None, known[-1] if known else None, ids, sizes, held, dac.encode(np.concatenate(codes))]
            before += held
            ids, sizes, codes, held = [], [], [], 0
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW, strict=True)], schema=_ARROW)

        for batch in slices(batches, size=AT_ONCE):
            flat, counts = coder.encode(batch.column(1).to_pylist())
            at = 0
            for doc, k in zip(batch.column(0).to_pylist(), counts.tolist(), strict=True):
                ids.append(doc)
                sizes.append(k)
                codes.append(flat[at : at + k])
                at += k
                held += k
                if held >= SEGMENT:
                    yield closed()
        if ids:
            yield closed()

    ordered.mapInArrow(trimmed(run), _SEGMENTS).write.parquet(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Segments of a token file with ``base``, the number of ids before each in the whole file."""
    segments = spark.read.schema(_SEGMENTS).parquet(path)
    parts = segments.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row for each file written
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_base"))
    bases = F.broadcast(parts.select("part", "part_base"))  # a row for each task that wrote, so no more than its shuffle partitions
    return segments.join(bases, "part").withColumn("base", F.col("part_base") + F.col("before"))


def document_tokens(segments: DataFrame) -> DataFrame:
    """(doc_id, start, ids) of every document, ids as little-endian unsigned 32-bit integers."""

    def run(batches):
        for batch in batches:
            for docs, lengths, codes, base in zip(*(batch.column(c) for c in range(4)), strict=True):
                sizes = np.array(lengths.as_py(), np.int64)
                ends = np.concatenate(([0], np.cumsum(sizes)))
                raw = dac.Reader(codes.as_buffer()).all().astype("<u4").tobytes()
                yield record("doc_id long,start long,ids binary", pa.array(docs.as_py(), pa.int64()), base.as_py() + ends[:-1], pa.array([raw[4 * a : 4 * b] for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()))

    return segments.select("doc_ids", "lengths", "codes", "base").mapInArrow(trimmed(run), "doc_id long,start long,ids binary")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path)
    rows = document_tokens(read_tokens(spark, path))
    return rows.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
