"""Stand-in for GPS pings made from the ``events`` table (see FIXTURES.md, section B)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackflow.config import ACTIVE, END, INACTIVE
from trackflow.functions.numbers import int_div
from trackflow.sources.streams import file_stream

# Fixed values of the stand-in.
EPOCH_2008_02_02 = 1201910400
EPOCH_MS_2024_01_01 = 1704067200000


def events_to_pings(events: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Pings of the events; a stream takes each taxi's last event from the stored ``history``."""
    base = _typed(events)
    stored = base if history is None else _typed(history)
    k, kind = F.col("k"), F.col("event_type")
    lat = F.lit(39.9163) + (k - 50) / F.lit(50.0) * F.lit(0.12)
    lon = F.lit(116.3972) + (F.col("_cents") % 100 - 50) / F.lit(50.0) * F.lit(0.15)
    late = F.when((kind == "error") & (k == 2), 20000).otherwise(0)
    last = stored.groupBy(F.col("taxi_id").alias("_taxi")).agg(F.max("seq").alias("_last"))
    same = (F.col("taxi_id") == F.col("_taxi")) & (F.col("seq") == F.col("_last"))
    return base.join(last, same, "left").select(
        "seq", "taxi_id", "k", "event_type", "event_s",
        F.when((kind == "view") & (k == 0), None).otherwise(lat).alias("latitude"),
        lon.alias("longitude"),
        F.when(F.col("_last").isNotNull() | ((kind == "error") & (k < 5)), END)
        .when((kind == "signup") & (k >= 95), INACTIVE)
        .otherwise(ACTIVE)
        .alias("trip_status"),
        "sent_at_utc_ms",
        (F.col("sent_at_utc_ms") + F.col("_lag") - late).cast("bigint").alias("processed_at_utc_ms"),
    )


def _typed(events: DataFrame) -> DataFrame:
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return events.select(
        F.col("event_id").alias("seq"),
        (F.col("user_id") + 1).cast("int").alias("taxi_id"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (int_div(ms - EPOCH_MS_2024_01_01, 60000) + EPOCH_2008_02_02).alias("event_s"),
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("_cents"),
        F.round(F.col("value") * 20).cast("bigint").alias("_lag"),
        ms.alias("sent_at_utc_ms"),
    )


def load_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_pings(spark.read.parquet(f"{sf_dir}/events.parquet"))


def stream_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    stream = file_stream(spark, sf_dir, events.schema, pattern="events.parquet")
    return events_to_pings(stream, events)


def raw_pings(pings: DataFrame) -> DataFrame:
    """Dirty raw rows: bad coordinates, missing ids, unparsable times and repeated lines."""
    k = F.col("k")
    copies = F.when(k == 6, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    time = F.date_format(F.timestamp_seconds("event_s"), "yyyy-MM-dd HH:mm:ss")
    bad_time = (k == 5) & (F.col("event_type") == "click")
    return pings.withColumn("_copy", F.explode(copies)).select(
        F.when(k != 4, F.col("taxi_id")).alias("taxi_id"),
        F.when(bad_time, "bad").otherwise(time).alias("timestamp"),
        F.when(k == 1, 500.0).when(k == 2, None).otherwise(F.col("longitude")).alias("longitude"),
        F.when(k == 3, -95.0).otherwise(F.col("latitude")).alias("latitude"),
        F.concat(F.col("taxi_id").cast("string"), F.lit(".txt")).alias("file"),
        (F.col("seq") * 2 + F.col("_copy")).alias("line"),
        "trip_status",
    )


def conflict_pings(pings: DataFrame) -> DataFrame:
    """Pings, and for some of them a second position at the same time."""
    rows = pings.select(
        "seq", "taxi_id", F.col("event_s").alias("timestamp"), "latitude", "longitude", "k"
    )
    moved = rows.where(F.col("k") == 7).withColumns(
        {"latitude": F.col("latitude") + 0.01, "seq": F.col("seq") + 1_000_000}
    )
    return rows.unionByName(moved).drop("k")
