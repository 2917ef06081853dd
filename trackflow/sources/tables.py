"""Tables at rest: cleaned trajectories, points by date, alert log, latest state, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackflow.sources.versions import Folder, Versioned


def write_cleaned(cleaned: DataFrame, path: str) -> bool:
    """Write the cleaned table by event date; nothing is written for an empty one."""
    if cleaned.isEmpty():
        return False
    dated = cleaned.withColumn("event_date", F.to_date("timestamp"))
    dated.write.mode("overwrite").partitionBy("event_date").parquet(path)
    return True


def write_points(points: DataFrame, path: str, mode: str = "append") -> None:
    """Points partitioned by date, so that a time range reads only its days."""
    dated = points.withColumn("point_date", F.to_date(F.timestamp_millis("time_ms")))
    dated.write.mode(mode).partitionBy("point_date").parquet(path)


def write_point_batch(points: DataFrame, path: str, batch_id: int) -> None:
    """Points of one micro-batch by date; repeating a batch replaces them."""
    dated = points.withColumn("point_date", F.to_date(F.timestamp_millis("time_ms")))
    dated.write.mode("overwrite").partitionBy("point_date").parquet(f"{path}/batch={batch_id}")


def read_points(
    spark: SparkSession, path: str, start_ms: int | None = None, stop_ms: int | None = None
) -> DataFrame:
    """Points of [start, stop): days are pruned, times are pushed to the scan."""
    points = spark.read.parquet(path)
    for bound, low in ((start_ms, True), (stop_ms, False)):
        if bound is not None:
            day = F.to_date(F.timestamp_millis(F.lit(bound)))
            points = points.where(F.col("point_date") >= day if low else F.col("point_date") <= day)
            time = F.col("time_ms")
            points = points.where(time >= bound if low else time < bound)
    return points.drop("point_date", "batch")


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One micro-batch of an append-only table; repeating a batch replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def last_batch(spark: SparkSession, path: str) -> int:
    """The last micro-batch of a table, -1 before the first."""
    return max((int(n.split("=")[1]) for n in Folder(spark, path).names() if n.startswith("batch=")), default=-1)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path).drop("batch")


def read_latest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """Current row per taxi, or that as of a version; None before the first one."""
    return Versioned(spark, path, "taxi_id").read(version)


def write_log_batch(log: DataFrame, path: str, batch_id: int) -> None:
    """Alert log rows of one micro-batch by day, and an index of the folders: rows, first and last seq.

    Repeating a batch replaces its folders."""
    dated = log.withColumns({"log_date": F.to_date("updated_at"), "batch": F.lit(batch_id)})
    rows = dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    rows.partitionBy("log_date", "batch").parquet(f"{path}/rows")
    index = dated.groupBy("log_date", "batch").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")
    )
    write_batch(index.drop("batch"), f"{path}/index", batch_id)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the folders in the index: those that a failed attempt left under another day are not."""
    rows, index = spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/index")
    index = index.select(F.col("log_date").alias("_date"), F.col("batch").alias("_batch"))
    same = F.col("log_date").eqNullSafe(F.col("_date")) & (F.col("batch") == F.col("_batch"))
    return rows.join(index, same, "left_semi").drop("log_date", "batch")


def newest_log_rows(spark: SparkSession, path: str, n: int) -> DataFrame:
    """The rows of the log that can be among its ``n`` newest: those of the few folders that hold them.

    Of the ``n`` folders with the latest last rows, the ones with the latest first rows that have ``n`` rows
    together give a row that none of the ``n`` newest is older than; folders that end before it are not read."""
    index = spark.read.parquet(f"{path}/index")
    folders = index.orderBy(F.col("last_seq").desc()).limit(n).collect()
    have, oldest = 0, None
    for f in sorted(folders, key=lambda f: -f.first_seq):
        have, oldest = have + f.n, f.first_seq
        if have >= n:
            break
    wanted = [f for f in folders if f.last_seq >= oldest] if have >= n else folders
    paths = [f"{path}/rows/log_date={f.log_date or '__HIVE_DEFAULT_PARTITION__'}/batch={f.batch}" for f in wanted]
    if not paths:
        return read_log(spark, path)
    return spark.read.parquet(*paths)


def write_report(windows: DataFrame, summary: DataFrame, path: str) -> None:
    """Benchmark report as JSON: metadata and the window series."""
    summary.write.mode("overwrite").json(f"{path}/analysis_metadata")
    series = windows.orderBy("window_start_utc_ms")
    series.write.mode("overwrite").json(f"{path}/time_series_data")


def read_report(spark: SparkSession, path: str, series: T.StructType) -> DataFrame:
    """The window series of a report."""
    return spark.read.schema(series).json(f"{path}/time_series_data")
