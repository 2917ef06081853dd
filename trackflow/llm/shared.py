"""Tables in the cluster's shared folder, and folds by id."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only in local mode with nothing set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, lost executors cost nothing.

    What a step numbers or salts is fixed by this, as every later reader sees the same rows."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_fold(key: str, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null for a null id."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds
