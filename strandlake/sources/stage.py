"""Tables written between steps, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. In local mode alone one is made where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="strandlake-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


#: Rows of a file at most: a small file is one task, however much its readers derive from each row.
ROWS = 1 << 15


def staged(df: DataFrame, name: str) -> DataFrame:
    """df as written to the shared folder: later steps read it, in few words of a plan, and a lost executor costs no more than its task."""
    path = f"{shared_folder(df.sparkSession)}/strandlake/{name}-{uuid.uuid4().hex}"
    df.write.option("maxRecordsPerFile", ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
