"""Aggregates per event-time window over micro-batches: complete at the end, late rows kept apart.

Each micro-batch is combined into one row per window (and key), merged with the windows that are still
open. Windows that the watermark has passed are written once; rows that come after that go to a table of
their own, where they can be read and counted. ``close`` writes the windows that are open when the input
ends.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.session import Held
from trackflow.sources.tables import last_batch, write_batch

START = "window_start"


@dataclass(frozen=True)
class Aggregates:
    """Keys besides the window; aggregates of rows, and of such aggregates."""

    keys: tuple[str, ...]
    first: tuple[Column, ...]
    again: tuple[Column, ...]


def counts() -> Aggregates:
    """Rows and their latency per window."""
    latency = F.col("processed_at_utc_ms") - F.col("sent_at_utc_ms")
    merge = {"pings": F.sum, "latency_sum_ms": F.sum, "latency_max_ms": F.max, "latency_min_ms": F.min}
    first = (
        F.count(F.lit(1)).alias("pings"),
        F.sum(latency).alias("latency_sum_ms"),
        F.max(latency).alias("latency_max_ms"),
        F.min(latency).alias("latency_min_ms"),
    )
    return Aggregates((), first, tuple(f(n).alias(n) for n, f in merge.items()))


def latest(columns: list[str]) -> Aggregates:
    """Per taxi and window the last row in arrival order."""
    rest = F.struct("seq", *[c for c in columns if c not in ("seq", "taxi_id")])
    return Aggregates(("taxi_id",), (F.max_by(rest, "seq").alias("_last"),), (F.max_by("_last", "_last.seq").alias("_last"),))


class Windows:
    """A sink of micro-batches; repeating one replaces what it wrote."""

    def __init__(self, out: str, aggregates: Aggregates, seconds: int = 300, lateness_s: int = 0, time: str = "event_s"):
        self.out, self.aggregates = out, aggregates
        self.seconds, self.lateness_s, self.time = seconds, lateness_s, time

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, hold = batch.sparkSession, Held(batch.sparkSession, self.out)
        start = F.col(self.time) - F.pmod(F.col(self.time), F.lit(self.seconds))
        rows = hold(batch.where(F.col(self.time).isNotNull()).withColumn(START, start.cast("bigint")))
        before = None if batch_id <= 0 else self._mark(spark, batch_id - 1)
        late = F.lit(False) if before is None else F.col(START) + self.seconds <= before
        write_batch(rows.where(late), f"{self.out}/late", batch_id)
        merged = rows.where(~late).groupBy(START, *self.aggregates.keys).agg(*self.aggregates.first)
        if batch_id > 0:
            merged = self._merge(merged.unionByName(self._open(spark, merged, batch_id - 1)))
        merged = hold(merged)
        newest = rows.agg(F.max(self.time).alias("t")).first().t
        mark = max([m for m in (before, None if newest is None else newest - self.lateness_s) if m is not None], default=None)
        passed = F.lit(False) if mark is None else F.col(START) + self.seconds <= mark
        write_batch(merged.where(passed), f"{self.out}/closed", batch_id)
        write_batch(merged.where(~passed), f"{self.out}/open", batch_id)
        write_batch(spark.range(1).select(F.lit(mark).cast("bigint").alias("mark")), f"{self.out}/mark", batch_id)
        hold.release()

    def close(self, spark: SparkSession) -> None:
        """The input has ended: what is open is final."""
        last = last_batch(spark, f"{self.out}/open")
        if last >= 0:
            write_batch(spark.read.parquet(f"{self.out}/open/batch={last}"), f"{self.out}/closed", last + 1)

    def closed(self, spark: SparkSession) -> DataFrame:
        """Final windows, with the end of each."""
        rows = spark.read.parquet(f"{self.out}/closed").drop("batch")
        rows = rows.withColumn("window_end", F.col(START) + self.seconds)
        return rows.select("*", "_last.*").drop("_last", "window_end") if "_last" in rows.columns else rows

    def late(self, spark: SparkSession) -> DataFrame:
        """Rows that came after their window was final."""
        return spark.read.parquet(f"{self.out}/late").drop("batch")

    def _mark(self, spark: SparkSession, batch_id: int) -> int | None:
        return spark.read.parquet(f"{self.out}/mark/batch={batch_id}").first().mark

    def _open(self, spark: SparkSession, like: DataFrame, batch_id: int) -> DataFrame:
        return spark.read.schema(like.schema).parquet(f"{self.out}/open/batch={batch_id}")

    def _merge(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(START, *self.aggregates.keys).agg(*self.aggregates.again)
