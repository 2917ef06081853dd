"""Taxis that fall silent (off by default), and sessions split at long gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.config import DEFAULTS, INACTIVE, Settings
from trackflow.operators.motion import is_end
from trackflow.operators.ordered import Ordered


def inactive_trips(pings: Ordered, cfg: Settings = DEFAULTS, as_of: int | None = None) -> DataFrame:
    """A copy, marked inactive, of each non-``end`` row with no successor within the timeout.

    ``as_of`` (event seconds) stands for the present; the newest event time by default.
    """
    rows = pings.where(F.col("event_s").isNotNull())
    if as_of is None:
        as_of = rows.df.agg(F.max("event_s")).first()[0]
    rows = rows.last_before(descending=True, _next=F.struct(F.col("event_s").alias("s")))
    silence = F.coalesce(F.col("_next.s"), F.lit(as_of)) - F.col("event_s")
    silent = rows.where(~is_end() & (silence > cfg.inactivity_timeout_s)).drop("_next")
    return silent.rows().withColumn("trip_status", F.lit(INACTIVE))


def trip_sessions(pings: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Event-time sessions per taxi: a gap of the timeout or more starts a new one.

    Rows are first counted per (taxi, second), so a second is unique within its taxi and can serve
    as the order column for chunking.
    """
    seconds = pings.where(F.col("event_s").isNotNull()).groupBy("taxi_id", "event_s")
    seconds = seconds.agg(F.count(F.lit(1)).alias("pings"))
    rows = Ordered.by_key(seconds, "taxi_id", "event_s", cfg.max_group_rows)
    rows = rows.last_before(_prev=F.col("event_s"))
    opens = F.col("_prev").isNull() | (F.col("event_s") - F.col("_prev") >= cfg.inactivity_timeout_s)
    rows = rows.add(_opens=F.when(opens, F.col("event_s")))
    rows = rows.last_before(_open=F.col("_opens"))
    start = F.coalesce(F.col("_opens"), F.col("_open"))
    return rows.rows().groupBy("taxi_id", start.alias("session_start")).agg(
        (F.max("event_s") + cfg.inactivity_timeout_s).alias("session_end"),
        F.sum("pings").alias("pings"),
    )
