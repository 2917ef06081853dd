"""Trend queries over time-series points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.config import DEFAULTS, GEOFENCE_ALERT, SPEED_ALERT, Settings
from trackflow.functions.numbers import (
    half_up_ratio,
    int_div,
    latency_seconds,
    nullable_percent_change,
)
from trackflow.operators.points import in_range


def window_stop(time_ms: Column, seconds: int) -> Column:
    """End of the epoch-aligned window that holds the time."""
    width = seconds * 1000
    return time_ms - F.pmod(time_ms, F.lit(width).cast("bigint")) + width


def iso(time_ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(time_ms), "yyyy-MM-dd'T'HH:mm:ss.SSS")


FLEET_COUNTS = ["active_taxis_count", "in_transit_taxis_count", "trip_ended_taxis_count"]


def fleet_parts(fleet_points: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Per window the sum and the number of each count: parts of a trend that can be added up."""
    stop = window_stop(F.col("time_ms"), cfg.trend_window_s)
    sums = [agg(n).alias(f"{n}_{kind}") for n in FLEET_COUNTS for kind, agg in (("sum", F.sum), ("n", F.count))]
    return fleet_points.groupBy(stop.alias("stop_ms")).agg(*sums)


def fleet_trend_of_parts(parts: DataFrame) -> DataFrame:
    """The trend of any number of parts."""
    means = parts.groupBy("stop_ms").agg(
        *[int_div(F.sum(f"{n}_sum"), F.sum(f"{n}_n")).alias(n) for n in FLEET_COUNTS]
    )
    filled = means.fillna(0, subset=FLEET_COUNTS)
    return filled.orderBy("stop_ms").select(iso(F.col("stop_ms")).alias("time"), *FLEET_COUNTS)


def fleet_metrics_trend(fleet_points: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Mean of the three counts per window, cut to whole numbers, labelled with the window's end."""
    return fleet_trend_of_parts(fleet_parts(fleet_points, cfg))


def latency_summary(
    processed: DataFrame, as_of_ms: int, long_s: int = 300, short_s: int = 5
) -> DataFrame:
    """Max, min and mean latency of the long range, and their change against the short range.

    One scan and one aggregate: the short range is a condition inside it.
    """
    points = processed.withColumn("time_ms", F.col("processed_at_utc_ms"))
    points = in_range(points, as_of_ms - long_s * 1000, as_of_ms)
    ms = F.col("time_ms") - F.col("sent_at_utc_ms")
    recent = F.when(F.col("time_ms") >= as_of_ms - short_s * 1000, ms)

    def three(value: Column) -> Column:
        return value / F.lit(1000.0)

    stats = points.agg(
        three(F.max(ms)).alias("max"), three(F.max(recent)).alias("max_recent"),
        three(F.min(ms)).alias("min"), three(F.min(recent)).alias("min_recent"),
        F.when(F.count(ms) > 0, three(half_up_ratio(F.sum(ms), F.count(ms)))).alias("mean"),
        F.when(
            F.count(recent) > 0, three(half_up_ratio(F.sum(recent), F.count(recent)))
        ).alias("mean_recent"),
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(s).alias("stat"),
                F.col(s).alias("latency_in_seconds"),
                nullable_percent_change(F.col(s), F.col(f"{s}_recent")).alias(
                    "change_from_last_5s_percent"
                ),
            )
            for s in ("max", "min", "mean")
        ]
    )
    return stats.select(F.inline(rows))


def incident_parts(alert_points: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Per taxi and window the number of alerts of each kind."""
    stop = window_stop(F.col("time_ms"), cfg.trend_window_s)
    kind = F.col("alert_type")
    return alert_points.groupBy("taxi_id", stop.alias("stop_ms")).agg(
        F.count_if(kind == GEOFENCE_ALERT).alias("geofence_violation_count"),
        F.count_if(kind == SPEED_ALERT).alias("speed_violation_count"),
    )


def incident_trend_of_parts(parts: DataFrame, per_taxi: bool = False, taxi_id: str | None = None) -> DataFrame:
    """The trend of any number of parts, newest window first; for the fleet, all taxis, or one."""
    rows = parts if taxi_id is None else parts.where(F.col("taxi_id") == taxi_id)
    keys = ["taxi_id"] if per_taxi or taxi_id is not None else []
    names = ["geofence_violation_count", "speed_violation_count"]
    counts = rows.groupBy(*keys, "stop_ms").agg(*[F.sum(n).alias(n) for n in names])
    return counts.orderBy(F.col("stop_ms").desc(), *keys).select(
        *keys, iso(F.col("stop_ms")).alias("time"), *names,
        (F.col(names[0]) + F.col(names[1])).alias("total_violation_count"),
    )


def incident_trend(
    alert_points: DataFrame, cfg: Settings = DEFAULTS, per_taxi: bool = False,
    taxi_id: str | None = None,
) -> DataFrame:
    """Alerts of each kind per window, newest window first; for the fleet, all taxis, or one."""
    return incident_trend_of_parts(incident_parts(alert_points, cfg), per_taxi, taxi_id)


def taxi_trend(points: DataFrame, value: Column, name: str, taxi_id: str | None = None) -> DataFrame:
    """One value over time: for one taxi in time order, or for every taxi without a global order.

    Ordering the points of all taxis would need a range exchange, whose sampling computes the
    points twice; each row carries its taxi and time instead.
    """
    shown = ["taxi_id", iso(F.col("time_ms")).alias("time"), value.alias(name)]
    if taxi_id is None:
        return points.select(*shown)
    return points.where(F.col("taxi_id") == taxi_id).orderBy("time_ms", "seq").select(*shown)


def taxi_speed_trend(points: DataFrame, taxi_id: str | None = None) -> DataFrame:
    return taxi_trend(points, F.col("speed"), "speed_in_km_per_hour", taxi_id)


def taxi_average_speed_trend(points: DataFrame, taxi_id: str | None = None) -> DataFrame:
    return taxi_trend(points, F.col("avg_speed"), "average_speed_in_km_per_hour", taxi_id)


def taxi_latency_trend(points: DataFrame, taxi_id: str | None = None) -> DataFrame:
    latency = latency_seconds(F.col("time_ms"), F.col("sent_at_utc_ms").cast("bigint"))
    return taxi_trend(points, latency, "event_latency_in_seconds", taxi_id)
