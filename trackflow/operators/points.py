"""Time-series points: one row per measurement, tags, fields and time (epoch ms)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.functions.messages import event_text

TAXI_FIELDS = [
    "speed", "avg_speed", "latitude", "longitude", "distance_from_forbidden_city_km",
    "total_distance_km", "sent_at_utc_ms",
]


def taxi_points(processed: DataFrame) -> DataFrame:
    """``taxi_metrics``: a row with a missing number or time gives no point."""
    numbers = ["speed", "avg_speed", "latitude", "longitude", "distance_from_forbidden_city_km",
               "total_distance_km", "sent_at_utc_ms", "processed_at_utc_ms"]
    return processed.na.drop(subset=numbers).select(
        "seq",
        F.coalesce(F.col("taxi_id").cast("string"), F.lit("unknown")).alias("taxi_id"),
        F.coalesce(F.col("trip_status"), F.lit("active")).alias("trip_status"),
        "speed", "avg_speed", "latitude", "longitude",
        F.coalesce(F.col("is_valid_speed"), F.lit(False)).alias("is_valid_speed"),
        "distance_from_forbidden_city_km",
        F.coalesce(F.col("is_in_range"), F.lit(False)).alias("is_in_range"),
        "total_distance_km",
        event_text(F.col("event_s")).alias("timestamp"),
        F.col("sent_at_utc_ms").cast("double").alias("sent_at_utc_ms"),
        F.col("processed_at_utc_ms").alias("time_ms"),
    )


def fleet_points(rows: DataFrame) -> DataFrame:
    """``taxi_fleet_metrics``: eight fields; a row with a missing one gives no point."""
    fields = [c for c in rows.columns if c.endswith(("_count", "_change", "_km"))]
    points = rows.na.drop(subset=fields)
    return points.select("seq", *fields, F.col("processed_at_utc_ms").alias("time_ms"))


def alert_points(alerts: DataFrame) -> DataFrame:
    """``taxi_violation_alerts``: fields default to 0.0."""
    return alerts.select(
        "seq",
        F.coalesce(F.col("taxi_id").cast("string"), F.lit("unknown")).alias("taxi_id"),
        F.coalesce(F.col("alert_type"), F.lit("unknown")).alias("alert_type"),
        F.coalesce(F.col("distance_km"), F.lit(0.0)).alias("distance_km"),
        F.coalesce(F.col("speed"), F.lit(0.0)).alias("speed"),
        F.col("processed_at_utc_ms").alias("time_ms"),
    )


def to_fields(points: DataFrame, ids: list[str], fields: list[str]) -> DataFrame:
    """Wide to narrow: one row per (id, field, value)."""
    wide = points.select(*ids, *[F.col(f).cast("double").alias(f) for f in fields])
    return wide.unpivot(ids, fields, "field", "value")


def from_fields(narrow: DataFrame, ids: list[str], fields: list[str]) -> DataFrame:
    """Narrow to wide; the known field list spares the pass that would collect it."""
    return narrow.groupBy(*ids).pivot("field", fields).agg(F.max("value"))


def in_range(points: DataFrame, start_ms: int | None, stop_ms: int | None) -> DataFrame:
    """Time filter, start inclusive and stop exclusive; literals reach the Parquet scan."""
    keep: Column = F.lit(True)
    if start_ms is not None:
        keep = keep & (F.col("time_ms") >= start_ms)
    if stop_ms is not None:
        keep = keep & (F.col("time_ms") < stop_ms)
    return points.where(keep)
