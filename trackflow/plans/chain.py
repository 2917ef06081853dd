"""The whole keyed chain as one batch plan over one exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trackflow.config import DEFAULTS, Settings
from trackflow.operators import alerts, motion
from trackflow.operators.ordered import Ordered


def ordered_pings(pings: DataFrame, cfg: Settings = DEFAULTS) -> Ordered:
    return Ordered.by_key(pings, "taxi_id", "seq", cfg.max_group_rows)


def averaged(pings: Ordered, cfg: Settings = DEFAULTS) -> Ordered:
    """De-duplicate, down-sample, speed, average speed."""
    rows = motion.downsample(motion.dedup_same_timestamp(pings), cfg.emit_interval_s)
    return motion.average_speed(motion.speed(rows.settled(), cfg).settled())


def moving(pings: Ordered, cfg: Settings = DEFAULTS) -> Ordered:
    """The chain up to the distance: what fleet metrics read."""
    return motion.distance(averaged(pings, cfg))


def chained(pings: Ordered, cfg: Settings = DEFAULTS) -> Ordered:
    """Every processed ping, with both alert flags.

    The rows that count towards the distance are the rows that the alerts read, so one look back
    serves all three; the distance comes last, as its sums are the only step that needs another
    sort order than (key, order).
    """
    rows = alerts.centred(motion.travelled(averaged(pings, cfg)), cfg)
    rows = rows.last_before(
        _warned=alerts.warned_state(cfg),
        _alerted=alerts.alerted_state(cfg),
        _prev=motion.last_position(),
    )
    rows = alerts.add_speeding(alerts.add_geofence(rows, cfg), cfg)
    return motion.add_distance(rows)


def process(pings: DataFrame, cfg: Settings = DEFAULTS) -> DataFrame:
    return chained(ordered_pings(pings, cfg), cfg).rows()
