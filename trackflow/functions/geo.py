"""Great-circle distance and the class columns derived from position, speed and status."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from trackflow.config import ACTIVE, DEFAULTS, END, INACTIVE, Settings

EARTH_RADIUS_KM = 6371  # fixed value


# The same body for SQL text.
_LAT, _LON = "sin(radians(lat2 - lat1) / 2)", "sin(radians(lon2 - lon1) / 2)"
_CHORD = f"({_LAT} * {_LAT} + cos(radians(lat1)) * cos(radians(lat2)) * {_LON} * {_LON})"
_HAVERSINE = f"atan2(sqrt({_CHORD}), sqrt(1 - {_CHORD})) * {2 * EARTH_RADIUS_KM}"


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    return F.atan2(F.sqrt(chord), F.sqrt(1 - chord)) * (2 * EARTH_RADIUS_KM)


def register_sql(spark: SparkSession) -> None:
    """Make ``haversine_km`` callable from SQL text; Catalyst inlines the body."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION haversine_km"
        "(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE RETURN"
        f" {_HAVERSINE}"
    )


def distance_to_centre(lat: Column, lon: Column, cfg: Settings = DEFAULTS) -> Column:
    return haversine_km(lat, lon, F.lit(cfg.centre_lat), F.lit(cfg.centre_lon))


def trip_label(status: Column, speed: Column) -> Column:
    return (
        F.when((status == ACTIVE) & (speed == 0), "Connected")
        .when((status == ACTIVE) & (speed > 0), "In Transit")
        .when(status.isin(ACTIVE, INACTIVE), "Reconnecting...")
        .when(status == END, "Trip Complete")
        .otherwise("Status Unknown")
    )


def speed_band(status: Column, speed: Column) -> Column:
    return (
        F.when(status.isin(INACTIVE, END, "N/A"), "neutral")
        .when((speed > 0) & (speed <= 50), "safe")
        .when(speed > 50, "high")
        .otherwise("idle")
    )


def distance_band(distance_km: Column) -> Column:
    return F.when(distance_km > 15, "out").when(distance_km > 10, "warn").otherwise("safe")


def marker_class(in_range: Column, status: Column, speed: Column, valid: Column) -> Column:
    moving = in_range & valid & (status == ACTIVE)
    return (
        F.when(moving & (speed == 0), "connected")
        .when(moving & (speed > 0), "in_transit")
        .when(in_range & (status == END), "trip_ended")
        .otherwise("default")
    )


def performance_zone(latency_s: Column) -> Column:
    return (
        F.when(latency_s < 1, "excellent")
        .when(latency_s < 5, "good")
        .when(latency_s < 10, "acceptable")
        .when(latency_s >= 10, "poor")
    )
