"""Helpers that the document operators share: the shared folder, written tables, Arrow slices of text."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one numpy step works on; bounds a worker's memory whatever the Arrow batch holds.
SLICE_BYTES = 2 << 20
#: Bytes of an Arrow batch on its way to and from a worker.
BATCH_BYTES = 4 << 20


#: Paths written inside the open scratch() blocks, on the driver.
_SCRATCH: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """A folder that driver and executors all see: spark.checkpoint.dir. In local mode alone one is made where it is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="strandlake-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/strandlake/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: a lineage cut that survives lost executors.

    Inside scratch() the files go when that ends, unless they are to be kept.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    if _SCRATCH and not keep:
        _SCRATCH[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession):
    """Deletes on leaving what was stored inside."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for name in _SCRATCH.pop():
            removed(spark, name)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a table that stored() or a writer made in the shared folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def bounded(spark: SparkSession) -> None:
    """Bounds the session's Arrow batches by bytes where its user has not: by rows alone, those of whole texts take much memory."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def documents(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id (long) and text (null becomes empty) alone, whatever else and under whatever names df carries."""
    bounded(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What a worker keeps between the tasks of one stage, and that stage.
_KEPT: dict = {}


def _of_this_stage() -> dict:
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if _KEPT.get("stage") != stage:
        _KEPT.clear()
        _KEPT["stage"] = stage
    return _KEPT


def kept(key: tuple, make):
    """make(), once for all tasks of a stage that a worker runs; it goes when the worker turns to another stage."""
    held = _of_this_stage()
    if key not in held:
        held[key] = make()
    return held[key]


def trimmed(run):
    """run, a function of record batches for mapInArrow, that gives freed memory back to the system when a task ends.

    Spark keeps Python workers for later tasks, and the allocators of idle ones keep what they once had.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _of_this_stage()
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
            if trim:
                trim(0)

    return work


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Row ranges of the batches whose text column holds about ``size`` bytes; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, ends = text_buffer(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, ends[at] + size, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column as one uint8 array, and the n + 1 offsets of its rows in that array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a Spark DDL string of long, int, boolean, double, string and binary columns."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (part.split() for part in ddl.split(","))])


def record(ddl: str, *columns) -> pa.RecordBatch:
    schema = arrow_schema(ddl)
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
