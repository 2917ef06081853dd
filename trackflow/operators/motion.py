"""Keyed motion operators: de-duplicate, down-sample, speed, average speed, distance.

Each takes and returns an ``Ordered`` of pings with columns taxi_id, seq, event_s, latitude,
longitude, trip_status. State is cleared after an ``end`` row that the operator accepts; rows it
rejects do not touch the state, so each step filters first and then looks back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from trackflow.config import ACTIVE, DEFAULTS, END, INACTIVE, Settings
from trackflow.functions.geo import haversine_km
from trackflow.functions.numbers import half_up_ratio, is_valid
from trackflow.operators.ordered import Ordered


def is_end():
    return F.coalesce(F.col("trip_status") == END, F.lit(False))


def located():
    return F.col("latitude").isNotNull() & F.col("longitude").isNotNull()


def trip_segments(pings: Ordered) -> Ordered:
    """``seg``: how many trips of the key have ended before this row."""
    ends = is_end().cast("bigint")
    return pings.sum_since(None, _ends=ends).add(seg=F.col("_ends") - ends).drop("_ends")


def dedup_same_timestamp(pings: Ordered) -> Ordered:
    """Drop an active row whose time equals that of the row before it in the trip."""
    rows = pings.where(F.col("event_s").isNotNull())
    rows = rows.last_before(_prev=F.struct(F.col("event_s").alias("s"), is_end().alias("ended")))
    repeats = ~F.col("_prev.ended") & (F.col("_prev.s") == F.col("event_s"))
    active = F.col("trip_status").eqNullSafe(ACTIVE)
    return rows.where(~(active & F.coalesce(repeats, F.lit(False)))).drop("_prev")


def downsample(pings: Ordered, interval_s: int = DEFAULTS.emit_interval_s) -> Ordered:
    """Keep ``end`` rows, and others at least ``interval_s`` after the last one kept in the trip."""
    rows = pings.where(F.col("event_s").isNotNull())
    return rows.sample_every(interval_s, "event_s", is_end())


def speed(pings: Ordered, cfg: Settings = DEFAULTS) -> Ordered:
    """``speed`` (km/h, 2 decimals) against the row before in the trip, and ``is_valid_speed``."""
    rows = pings.where(F.col("event_s").isNotNull() & located())
    rows = rows.last_before(
        _prev=F.struct("latitude", "longitude", "event_s", is_end().alias("ended"))
    )
    first = F.coalesce(F.col("_prev.ended"), F.lit(True))
    hours = (F.col("event_s") - F.col("_prev.event_s")) / F.lit(3600.0)
    km = haversine_km(
        F.col("latitude"), F.col("longitude"), F.col("_prev.latitude"), F.col("_prev.longitude")
    )
    forward = ~first & (hours > 0)
    raw = F.when(forward, km / hours)
    kmph = F.when(raw < cfg.stationary_kmph, 0.0).otherwise(raw)
    rows = rows.add(_first=first, _forward=forward, _kmph=kmph).drop("_prev")
    known = (
        F.when(F.col("_first"), F.lit(0.0))
        .when(F.col("_forward") & (F.col("_kmph") <= cfg.max_valid_kmph), F.col("_kmph"))
    )
    rows = rows.add(_known=known)
    # Last valid speed of the trip: kept in a struct so that an ``end`` row can clear it.
    memory = F.when(is_end(), F.struct(F.lit(None).cast("double").alias("v"))).when(
        F.col("_known").isNotNull(), F.struct(F.col("_known").alias("v"))
    )
    rows = rows.last_before(_memory=memory)
    stale = ~F.col("_first") & ~F.col("_forward") & F.col("trip_status").eqNullSafe(INACTIVE)
    kmph = F.when(stale, F.col("_memory.v")).otherwise(F.col("_known"))
    return rows.add(
        speed=F.round(F.coalesce(kmph, F.lit(0.0)), 2), is_valid_speed=kmph.isNotNull()
    ).drop("_first", "_forward", "_kmph", "_known", "_memory")


def average_speed(pings: Ordered) -> Ordered:
    """``avg_speed`` over the trip so far; rows without a valid speed go unless they end the trip.

    Speeds have two decimals, so hundredths are summed as integers: exact in any order.
    """
    valid = is_valid(F.col("is_valid_speed")) & F.col("speed").isNotNull()
    counted = valid & F.col("trip_status").isin(ACTIVE, END)
    rows = pings.sum_since(
        is_end(),
        exact=True,
        _sum=F.when(counted, F.round(F.col("speed") * 100).cast("bigint")).otherwise(0),
        _n=counted.cast("bigint"),
    )
    mean = F.when(F.col("_n") > 0, half_up_ratio(F.col("_sum"), F.col("_n")) / 100.0)
    rows = rows.add(avg_speed=F.coalesce(mean, F.lit(0.0))).drop("_sum", "_n")
    return rows.where(valid | is_end())


def travelled(pings: Ordered) -> Ordered:
    """Rows that count towards the distance."""
    return pings.where(
        located() & F.col("event_s").isNotNull() & is_valid(F.col("is_valid_speed"))
    )


def last_position():
    """What the next counting row of the key needs from this one."""
    return F.struct("latitude", "longitude", is_end().alias("ended"))


def distance(pings: Ordered) -> Ordered:
    """``total_distance_km`` (3 decimals) over the valid rows of the trip."""
    return add_distance(travelled(pings).last_before(_prev=last_position()))


def add_distance(rows: Ordered) -> Ordered:
    leg = F.when(
        ~F.col("_prev.ended"),
        haversine_km(
            F.col("latitude"), F.col("longitude"), F.col("_prev.latitude"), F.col("_prev.longitude")
        ),
    )
    # Legs are whole micrometres, so that their sums do not depend on how rows are grouped.
    legs = F.round(F.coalesce(leg, F.lit(0.0)) * 1e9).cast("bigint")
    rows = rows.add(_leg=legs).drop("_prev")
    rows = rows.sum_since(is_end(), exact=True, _um=F.col("_leg"))
    return rows.add(total_distance_km=half_up_ratio(F.col("_um"), F.lit(1_000_000)) / 1000.0).drop("_leg", "_um")
