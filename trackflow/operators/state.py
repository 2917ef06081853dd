"""Latest state per taxi, fleet size, snapshot and the map's display rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackflow.config import ACTIVE, DEFAULTS, END, Settings

# Outer radius of the display filter.
DISPLAY_RADIUS_KM = 15


def latest_per_taxi(processed: DataFrame, order: str = "seq") -> DataFrame:
    """Last row per taxi in arrival order; rows without a usable id are rejected.

    ``max_by`` combines on the map side, so a taxi with very many rows costs one row per task.
    """
    rest = [c for c in processed.columns if c != "taxi_id"]
    usable = processed.where(F.col("taxi_id") != 0)
    last = usable.groupBy("taxi_id").agg(F.max_by(F.struct(*rest), order).alias("_last"))
    return last.select("taxi_id", "_last.*")


def taxi_ids(latest: DataFrame) -> DataFrame:
    return latest.select("taxi_id").distinct().orderBy("taxi_id")


def fleet_snapshot(latest: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    """All taxis by id with the run's settings."""
    return latest.withColumns(
        {
            "total_taxi_fleet_size": F.lit(cfg.fleet_size),
            "data_replay_mode": F.lit(cfg.replay_mode),
            "data_replay_speed": F.lit(cfg.replay_speed),
        }
    ).orderBy("taxi_id")


def fleet_now(latest: DataFrame, fleet_rows: DataFrame, order: str = "seq") -> DataFrame:
    """The current fleet row and the number of known taxis, as one row.

    Both are aggregates, so they meet in one aggregate over a union instead of a product; with no
    fleet row yet, its columns are null.
    """
    names = [c for c in fleet_rows.columns if c != order]
    newest = fleet_rows.agg(F.max_by(F.struct(*names), order).alias("_fleet"))
    size = latest.agg(F.count_distinct("taxi_id").alias("current_taxi_fleet_size"))
    both = newest.unionByName(size, allowMissingColumns=True)
    both = both.agg(
        F.first("_fleet", ignorenulls=True).alias("_fleet"),
        F.max("current_taxi_fleet_size").alias("current_taxi_fleet_size"),
    )
    return both.select("_fleet.*", "current_taxi_fleet_size")


def merge_latest(current: DataFrame, update: DataFrame) -> DataFrame:
    """Field-level merge by taxi: a field present in the update replaces the current one.

    Both sides hold one row per taxi, so no key is heavier than another.
    """
    names = [c for c in current.columns if c != "taxi_id"]
    extra = [c for c in update.columns if c not in current.columns]
    new = update.select(F.col("taxi_id").alias("_id"), *[
        F.col(c).alias(f"_new_{c}") for c in update.columns if c != "taxi_id"
    ])
    merged = current.join(new, F.col("taxi_id") == F.col("_id"), "full_outer")
    return merged.select(
        F.coalesce("_id", "taxi_id").alias("taxi_id"),
        *[
            F.coalesce(f"_new_{c}", c).alias(c) if c in update.columns else F.col(c)
            for c in names
        ],
        *[F.col(f"_new_{c}").alias(c) for c in extra],
    )


def displayed(
    latest: DataFrame,
    stationary: bool = True,
    in_transit: bool = True,
    ended: bool = True,
    outside: bool = False,
) -> DataFrame:
    """Taxis that the map shows under its four switches."""
    status, speed = F.col("trip_status"), F.col("speed")
    shown = F.coalesce(F.col("is_valid_speed"), F.lit(False))
    hide = []
    if not ended:
        hide.append(status == END)
    if not stationary:
        hide.append((status == ACTIVE) & (speed <= 0))
    if not in_transit:
        hide.append((status == ACTIVE) & (speed > 0))
    if not outside:
        hide.append(F.col("distance_from_forbidden_city_km") > DISPLAY_RADIUS_KM)
    for rule in hide:
        shown = shown & ~F.coalesce(rule, F.lit(False))
    return latest.where(shown)


def latest_per_tumbling(pings: DataFrame, seconds: int = 5) -> DataFrame:
    """Last row in arrival order of each taxi in each fixed window of event time."""
    start = F.col("event_s") - F.col("event_s") % seconds
    rest = [c for c in pings.columns if c != "taxi_id"]
    last = pings.groupBy("taxi_id", start.alias("window_start"))
    last = last.agg(F.max_by(F.struct(*rest), "seq").alias("_last"))
    return last.select("taxi_id", "window_start", "_last.*")
