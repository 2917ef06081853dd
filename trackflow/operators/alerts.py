"""Edge-triggered geofence and speed alerts, the alert log and its queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackflow.config import DEFAULTS, GEOFENCE_ALERT, SPEED_ALERT, Settings
from trackflow.functions.geo import distance_to_centre
from trackflow.functions.numbers import is_valid
from trackflow.operators.motion import is_end, located
from trackflow.operators.ordered import Ordered


def centred(pings: Ordered, cfg: Settings = DEFAULTS) -> Ordered:
    """Rows with a position, and their distance to the centre."""
    km = distance_to_centre(F.col("latitude"), F.col("longitude"), cfg)
    return pings.where(located()).add(_km=km)


def in_ring(cfg: Settings) -> Column:
    ring = (F.col("_km") > cfg.warning_km) & (F.col("_km") <= cfg.range_km)
    return ring & is_valid(F.col("is_valid_speed"))


def warned_state(cfg: Settings) -> Column:
    """Whether the key counts as warned after this row; null leaves that as it was.

    A row inside the warning radius and the end of a trip arm the alert again; a row beyond the
    outer radius does nothing.
    """
    armed = is_end() | (F.col("_km") <= cfg.warning_km)
    return F.when(armed, False).when(in_ring(cfg), True)


def alerted_state(cfg: Settings) -> Column:
    """Whether the key counts as alerted for speed after this row; null leaves that as it was."""
    return F.when(speed_known(), (F.col("speed") > cfg.speed_limit_kmph) & ~is_end())


def speed_known() -> Column:
    return F.col("speed").isNotNull() & is_valid(F.col("is_valid_speed"))


def add_geofence(rows: Ordered, cfg: Settings) -> Ordered:
    return rows.add(
        distance_from_forbidden_city_km=F.round("_km", 2),
        is_in_range=F.col("_km") <= cfg.range_km,
        geofence_alert=in_ring(cfg) & ~F.coalesce(F.col("_warned"), F.lit(False)),
    ).drop("_km", "_warned")


def add_speeding(rows: Ordered, cfg: Settings) -> Ordered:
    above = speed_known() & (F.col("speed") > cfg.speed_limit_kmph)
    alert = above & ~F.coalesce(F.col("_alerted"), F.lit(False))
    return rows.add(speed_alert=F.coalesce(alert, F.lit(False))).drop("_alerted")


def geofence(pings: Ordered, cfg: Settings = DEFAULTS) -> Ordered:
    """Distance to the centre, range flag, and ``geofence_alert`` on entering the ring."""
    rows = centred(pings, cfg)
    return add_geofence(rows.last_before(_warned=warned_state(cfg)), cfg)


def speeding(pings: Ordered, cfg: Settings = DEFAULTS) -> Ordered:
    """``speed_alert`` on the first row above the limit; at or below it arms the alert again."""
    return add_speeding(pings.last_before(_alerted=alerted_state(cfg)), cfg)


def _alert_rows(processed: DataFrame, flag: str, kind: str, value: Column, name: str) -> DataFrame:
    return processed.where(F.col(flag)).select(
        "taxi_id", "seq", "event_s", "latitude", "longitude", "trip_status", "processed_at_utc_ms",
        value.alias(name), F.lit(kind).alias("alert_type"),
    )


def geofence_alerts(processed: DataFrame) -> DataFrame:
    km = F.col("distance_from_forbidden_city_km")
    return _alert_rows(processed, "geofence_alert", GEOFENCE_ALERT, km, "distance_km")


def speed_alerts(processed: DataFrame) -> DataFrame:
    return _alert_rows(processed, "speed_alert", SPEED_ALERT, F.col("speed"), "speed")


def all_alerts(processed: DataFrame) -> DataFrame:
    """Both kinds from one pass: a row raising both becomes two rows."""
    geo = F.when(
        F.col("geofence_alert"),
        F.struct(
            F.lit(GEOFENCE_ALERT).alias("alert_type"),
            F.col("distance_from_forbidden_city_km").alias("distance_km"),
            F.lit(None).cast("double").alias("speed"),
        ),
    )
    fast = F.when(
        F.col("speed_alert"),
        F.struct(
            F.lit(SPEED_ALERT).alias("alert_type"),
            F.lit(None).cast("double").alias("distance_km"),
            F.col("speed").alias("speed"),
        ),
    )
    raised = processed.where(F.col("geofence_alert") | F.col("speed_alert"))
    return raised.select(
        "taxi_id", "seq", "event_s", "latitude", "longitude", "trip_status", "processed_at_utc_ms",
        F.inline(F.array_compact(F.array(geo, fast))),
    )


def incident_log(alerts: DataFrame) -> DataFrame:
    """Alert log rows: only complete alerts, with an id that a replay reproduces."""
    complete = alerts.where((F.col("taxi_id") != 0) & (F.col("alert_type") != ""))
    identity = F.concat_ws("|", "taxi_id", "alert_type", "seq")
    return complete.select(
        F.substring(F.sha2(identity, 256), 1, 16).alias("incident_id"),
        "taxi_id", "alert_type",
        F.date_format(F.timestamp_seconds("event_s"), "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        "latitude", "longitude", "trip_status",
        F.when(F.col("alert_type") == GEOFENCE_ALERT, F.col("distance_km")).alias("distance_km"),
        F.when(F.col("alert_type") == SPEED_ALERT, F.col("speed")).alias("speed"),
        F.date_format(
            F.timestamp_millis("processed_at_utc_ms"), "yyyy-MM-dd HH:mm:ss"
        ).alias("updated_at"),
        "seq",
    )


def incident_counts(log: DataFrame) -> DataFrame:
    kind = F.col("alert_type")
    return log.agg(
        F.count(F.lit(1)).alias("total_incidents"),
        F.count_if(kind == GEOFENCE_ALERT).alias("geofence_violations"),
        F.count_if(kind == SPEED_ALERT).alias("speed_violations"),
    )


def arrival(descending: bool) -> list[Column]:
    cols = [F.col("seq"), F.col("alert_type")]
    return [c.desc() if descending else c.asc() for c in cols]


def newest_first(log: DataFrame) -> DataFrame:
    return log.orderBy(*arrival(True))


def by_update(log: DataFrame) -> DataFrame:
    return log.orderBy(F.col("updated_at").desc(), *arrival(True))


def last_incidents(log: DataFrame, n: int = 50) -> DataFrame:
    """The ``n`` newest, oldest of them first."""
    return newest_first(log).limit(n).orderBy(*arrival(False))


def with_latest_taxi(log: DataFrame, latest: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """Left lookup of each incident's taxi in the latest-state table (one row per taxi).

    The table grows with the fleet, so it is not broadcast; only the rows of taxis with very many
    incidents are.
    """
    state = latest.select(
        F.col("taxi_id").alias("_id"),
        F.col("trip_status").alias("latest_status"),
        F.col("latitude").alias("latest_latitude"),
        F.col("longitude").alias("latest_longitude"),
        F.col("speed").alias("latest_speed"),
    )
    return log.join(state, F.col("taxi_id") == F.col("_id"), "left").drop("_id")
