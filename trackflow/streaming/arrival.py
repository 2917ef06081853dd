"""One arrival order over several partitions and topics.

A message's arrival time is the latest sending time up to it within its partition, so a partition's own
order is never broken. Messages are released in the order of (arrival time, topic, partition, offset), once
every partition has passed their time; the others are held back in a table until a later micro-batch.
``seq`` packs the arrival time with the place within that millisecond: unique, rising, and the same
whether messages are numbered at once or over micro-batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trackflow.session import Held
from trackflow.sources.tables import last_batch, write_batch

PLACES = 1 << 21  # messages within one millisecond
SOURCE = ["topic", "partition"]
ARRIVAL = "_arrival_ms"


def arrival_times(rows: DataFrame, sent: str, opened: Column | None = None) -> DataFrame:
    """Rows with the latest sending time up to each within its partition.

    ``opened`` is a time that a partition cannot fall behind; without any sending time it is 0."""
    upto = Window.partitionBy(*SOURCE).orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    latest = F.max(F.col(sent).cast("bigint")).over(upto)
    floor = F.lit(0).cast("bigint") if opened is None else F.coalesce(opened, F.lit(0).cast("bigint"))
    return rows.withColumn(ARRIVAL, F.greatest(latest, floor))


def numbered(rows: DataFrame) -> DataFrame:
    """``seq`` from complete milliseconds of arrival; more messages in one than it can number fail."""
    place = F.row_number().over(Window.partitionBy(ARRIVAL).orderBy(*SOURCE, "offset")) - 1
    message = F.lit(f"more than {PLACES} messages arrived within a millisecond")
    packed = F.when(F.col("_place") < PLACES, F.col(ARRIVAL) * PLACES + F.col("_place"))
    seq = packed.otherwise(F.raise_error(message).cast("bigint"))
    return rows.withColumn("_place", place).withColumn("seq", seq).drop("_place")


def in_arrival_order(rows: DataFrame, sent: str = "sent_at_utc_ms") -> DataFrame:
    """All messages of a table (topic, partition, offset, a sending time) with their ``seq``."""
    return numbered(arrival_times(rows, sent)).drop(ARRIVAL)


class Arrival:
    """Releases the messages of micro-batches in arrival order.

    Nothing is released before ``partitions`` of them have been seen. A partition that has been silent
    for ``idle_s`` seconds (0: never) is not waited for; what it sends later arrives at the time that
    has been released by then."""

    def __init__(self, out: str, partitions: int, idle_s: int = 0, sent: str = "sent_at_utc_ms"):
        self.out, self.partitions, self.idle_s, self.sent = f"{out}/arrival", partitions, idle_s, sent

    def _before(self, name: str, like: DataFrame, batch_id: int) -> DataFrame:
        spark = like.sparkSession
        if batch_id <= 0:
            return like.limit(0)
        return spark.read.schema(like.schema).parquet(f"{self.out}/{name}/batch={batch_id - 1}")

    def release(self, rows: DataFrame, batch_id: int, hold: Held, end: bool = False) -> DataFrame:
        """Rows that every partition has passed, with ``seq``; at the end of the input all rows."""
        now = F.unix_millis(F.current_timestamp())
        fronts = rows.select(
            *SOURCE, F.lit(0).cast("bigint").alias("front_ms"), now.alias("seen_ms"),
            F.lit(0).cast("bigint").alias("bound_ms"),
        )
        # One row per partition.
        known = self._before("fronts", fronts, batch_id)
        released = known.agg(F.max("bound_ms").alias("_released"))
        opened = known.select(*[F.col(c).alias(f"_{c}") for c in SOURCE], F.col("front_ms").alias("_front"))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SOURCE]
        new = rows.join(opened, same[0] & same[1], "left").crossJoin(F.broadcast(released))
        floor = F.greatest(F.col("_front"), F.col("_released"))
        new = arrival_times(new, self.sent, floor).select(*rows.columns, ARRIVAL)
        new = hold(new)
        passed = new.groupBy(*SOURCE).agg(F.max(ARRIVAL).alias("front_ms")).withColumns(
            {"seen_ms": now, "bound_ms": F.lit(0).cast("bigint")}
        )
        fronts = known.unionByName(passed).groupBy(*SOURCE).agg(
            *[F.max(c).alias(c) for c in ("front_ms", "seen_ms", "bound_ms")]
        )
        awake = F.col("seen_ms") > now - self.idle_s * 1000 if self.idle_s else F.lit(True)
        slowest = fronts.agg(
            F.when(F.count(F.lit(1)) >= self.partitions, F.min(F.when(awake, F.col("front_ms")))).alias("_slowest"),
            F.max("bound_ms").alias("_bound"),
        )
        bound = F.greatest("_bound", "_slowest", F.lit(0))
        fronts = fronts.drop("bound_ms").crossJoin(F.broadcast(slowest.select(bound.cast("bigint").alias("bound_ms"))))
        fronts = hold(fronts)
        write_batch(fronts, f"{self.out}/fronts", batch_id)
        waiting = self._before("waiting", new, batch_id).unionByName(new)
        limit = fronts.agg(F.max("bound_ms").alias("_limit"))
        due = F.lit(True) if end else F.coalesce(F.col(ARRIVAL) < F.col("_limit"), F.lit(False))
        waiting = hold(waiting.crossJoin(F.broadcast(limit)).withColumn("_due", due).drop("_limit"))
        write_batch(waiting.where(~F.col("_due")).drop("_due"), f"{self.out}/waiting", batch_id)
        return numbered(waiting.where("_due").drop("_due")).drop(ARRIVAL)

    def last_batch(self, spark: SparkSession) -> int:
        """The last micro-batch, -1 before the first."""
        return last_batch(spark, f"{self.out}/fronts")

    def nothing(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """No rows, as those of a micro-batch."""
        return spark.read.parquet(f"{self.out}/waiting/batch={batch_id}").drop(ARRIVAL).limit(0)
