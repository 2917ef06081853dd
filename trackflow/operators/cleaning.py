"""Cleaning of raw trajectories and the replay schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.config import ACTIVE, DEFAULTS, END, Settings
from trackflow.operators.ordered import Ordered
from trackflow.session import cut

BAD = -1.0  # fixed value: sentinel of a missing or impossible coordinate
COLUMNS = ["taxi_id", "timestamp", "longitude", "latitude"]


def sentinel(column: str, bound: int) -> Column:
    """The coordinate, or the sentinel if it is missing or outside [-bound, bound]."""
    return F.when(F.col(column).between(-bound, bound), F.col(column)).otherwise(F.lit(BAD))


def taxi_from_file(file: Column) -> Column:
    return F.regexp_extract(file, r"([^/]*)\.[^./]*$", 1).try_cast("int")


def limit_files(raw: DataFrame, limit: int) -> DataFrame:
    """Rows of the first ``limit`` files by name; files without rows are never counted."""
    if limit < 1:
        raise ValueError("file limit must be positive")
    chosen = raw.select("file").distinct().orderBy("file").limit(limit)
    return raw.join(chosen, "file", "left_semi")


def sentinel_coords(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {"longitude": sentinel("longitude", 180), "latitude": sentinel("latitude", 90)}
    )


def fill_and_parse(raw: DataFrame) -> DataFrame:
    """Taxi id from the file where missing, sentinels, parsed time; rows without a time go."""
    filled = sentinel_coords(raw).withColumns(
        {
            "taxi_id": F.coalesce(F.col("taxi_id"), taxi_from_file(F.col("file"))),
            "timestamp": F.try_to_timestamp("timestamp"),
        }
    )
    return filled.where(F.col("timestamp").isNotNull())


def mark_trip_status(parsed: DataFrame) -> DataFrame:
    """``end`` on the last surviving row of each file, ``active`` on the others.

    The last line per file is a map-side aggregate; joining on (file, line) spreads large files.
    """
    last = parsed.groupBy(F.col("file").alias("_file")).agg(F.max("line").alias("_line"))
    same = (F.col("file") == F.col("_file")) & (F.col("line") == F.col("_line"))
    marked = parsed.join(last, same, "left")
    status = F.when(F.col("_line").isNotNull(), END).otherwise(ACTIVE)
    return marked.withColumn("trip_status", status).drop("_file", "_line")


def distinct_rows(marked: DataFrame) -> DataFrame:
    """Exact duplicates of (id, time, position, status) collapse across all files."""
    return marked.select(*COLUMNS, "trip_status").distinct()


def clean(raw: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Raw rows (four columns, file, line) to the cleaned trajectory table."""
    limited = raw if cfg.file_limit is None else limit_files(raw, cfg.file_limit)
    return distinct_rows(mark_trip_status(fill_and_parse(limited)))


def in_time_order(cleaned: DataFrame) -> DataFrame:
    """Global order for consumers that need one (a range exchange)."""
    return cleaned.orderBy("timestamp", "taxi_id", "trip_status", "longitude", "latitude")


def second_batches(cleaned: DataFrame) -> DataFrame:
    """Rows per second of event time."""
    return cleaned.groupBy(F.date_trunc("second", "timestamp").alias("batch_time")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def replay_schedule(cleaned: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """When each one-second batch is sent: delay before it and offset from the first batch.

    Delays follow the gaps between batches (actual) or are fixed (simulated); both divide by the
    speed. Times are whole seconds, so the offset is an exact sum over all batches in order.
    """
    batches = second_batches(cleaned).select(F.unix_seconds("batch_time").alias("batch_s"), "messages")
    batches = cut(batches)  # one row per second; otherwise measuring it would clean everything twice
    rows = Ordered.globally(batches, "batch_s", cfg.max_group_rows)
    rows = rows.last_before(_prev=F.col("batch_s"))
    gap = F.lit(1) if cfg.replay_mode == "simulated" else F.col("batch_s") - F.col("_prev")
    gap = F.when(F.col("_prev").isNull(), F.lit(0)).otherwise(gap).cast("bigint")
    rows = rows.add(_gap=gap).sum_since(None, _offset=F.col("_gap"))
    speed = F.lit(cfg.replay_speed)
    return rows.rows().select(
        "batch_s", "messages",
        (F.col("_gap") / speed).alias("delay_s"),
        (F.col("_offset") / speed).alias("offset_s"),
    )


def as_sent(cleaned: DataFrame, start_ms: int, cfg: Settings = DEFAULTS) -> DataFrame:
    """Cleaned rows as the pings that a replay begun at ``start_ms`` sends: ``seq`` in time order,
    ``event_s`` and ``sent_at_utc_ms``, ready for the keyed chain and for outgoing messages.

    Numbered in two steps: the messages before each second, plus the place within the second.
    """
    cleaned = cut(cleaned)
    schedule = Ordered.globally(replay_schedule(cleaned, cfg), "batch_s", cfg.max_group_rows)
    seconds = schedule.sum_since(None, _upto=F.col("messages")).rows().select(
        "batch_s",
        (F.col("_upto") - F.col("messages")).alias("_before"),
        (F.lit(start_ms) + F.round(F.col("offset_s") * 1000)).cast("bigint").alias("sent_at_utc_ms"),
    )
    inside = Window.partitionBy("event_s").orderBy("taxi_id", "trip_status", "longitude", "latitude")
    rows = cleaned.withColumn("event_s", F.unix_seconds(F.date_trunc("second", "timestamp")))
    return rows.join(seconds, F.col("event_s") == F.col("batch_s")).select(
        (F.col("_before") + F.row_number().over(inside)).alias("seq"),
        *COLUMNS, "event_s", "trip_status", "sent_at_utc_ms",
    )
