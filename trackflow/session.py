"""Lineage cuts that survive executor loss."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only in local mode with nothing set."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="trackflow-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder, of rows that several steps read."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Held:
    """Tables that several steps of a micro-batch read, in the job's own folder; they go with the batch.

    Written rather than cached: cached rows of cached rows would be planned, and printed, over and over."""

    def __init__(self, spark: SparkSession, out: str):
        self.spark, self.name = spark, f"{out}/_work/{uuid.uuid4().hex}"
        self.count = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.name}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.name)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
