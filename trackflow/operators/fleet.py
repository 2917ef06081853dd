"""Fleet metrics: one un-keyed running state over all taxis in arrival order, without one task.

Each row changes the fleet by a difference against the same taxi's row before it. Differences are
whole numbers (counts, and metres of distance), so their running sums are exact in any grouping and
are taken chunk by chunk over the arrival order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackflow.config import ACTIVE, DEFAULTS, END, Settings
from trackflow.functions.numbers import half_up_ratio, safe_percent_change
from trackflow.operators.ordered import CHUNK, Ordered
from trackflow.session import cut

COUNTS = ("active", "ended", "transit")
TOTALS = (*COUNTS, "metres")


def differences(moving: Ordered, cfg: Settings) -> Ordered:
    """What each row adds to the fleet totals."""
    status = F.col("trip_status")
    transit = F.coalesce(F.col("speed"), F.lit(0.0)) > cfg.in_transit_kmph
    state = F.when(
        status.isin(ACTIVE, END),
        F.struct(
            (status == ACTIVE).cast("bigint").alias("active"),
            (status == END).cast("bigint").alias("ended"),
            ((status == ACTIVE) & transit).cast("bigint").alias("transit"),
        ),
    )
    metres = F.round(F.coalesce(F.col("total_distance_km"), F.lit(0.0)) * 1000).cast("bigint")
    rows = moving.where(F.col("event_s").isNotNull()).add(_state=state, _metres=metres)
    rows = rows.last_before(_was=F.col("_state"), _metres_was=F.col("_metres"))
    change = {
        f"_d_{n}": F.when(
            F.col("_state").isNotNull(),
            F.col(f"_state.{n}") - F.coalesce(F.col(f"_was.{n}"), F.lit(0)),
        ).otherwise(F.lit(0)).cast("bigint")
        for n in COUNTS
    }
    change["_d_metres"] = F.col("_metres") - F.coalesce(F.col("_metres_was"), F.lit(0))
    return rows.add(**change).drop("_state", "_metres", "_was", "_metres_was")


def fleet_rows(moving: Ordered, cfg: Settings = DEFAULTS) -> DataFrame:
    """Fleet counts, distance and percent changes as of every row of the chain."""
    return fleet_totals(differences(moving, cfg).rows().withColumnRenamed(moving.order, "seq"), cfg)


def fleet_totals(
    changes: DataFrame, cfg: Settings = DEFAULTS, with_state: bool = False,
    hold: Callable[[DataFrame], DataFrame] = cut,
) -> DataFrame:
    """Running totals of the differences in arrival order, with their changes.

    Changes compare the totals at the latest re-baseline row with those at the one before it.
    Re-baseline rows are found among the rows later than all rows before them (no other can be one),
    at least ``rebaseline_s`` apart. Those rows are few, and all steps after the totals run on them.
    """
    order = "seq"
    slim = changes.select(
        order, "taxi_id", "event_s", "processed_at_utc_ms", *[f"_d_{n}" for n in TOTALS]
    )
    rows = Ordered.globally(slim, order, cfg.max_group_rows, hold)
    totals = rows.totals({"_top": F.col("event_s")}, **{n: F.col(f"_d_{n}") for n in TOTALS})
    totals = totals.drop(*[f"_d_{n}" for n in TOTALS])

    records = totals.df.where(F.col("event_s") > F.coalesce(F.col("_top"), F.col("event_s") - 1))
    records = totals.like(totals.hold(records.select(order, CHUNK, "event_s", *TOTALS)))
    # Totals at the base before this one. The base before the first change counts as an empty
    # fleet, so that a change needs a base whose own predecessor exists.
    snapshot = F.struct(*[F.col(n).alias(n) for n in TOTALS])
    bases = records.sample_every(cfg.rebaseline_s, "event_s").last_before(_from=snapshot)
    bases = bases.last_before(_second=F.col("_from.active"))
    percents = F.struct(
        *[
            F.coalesce(
                F.when(
                    F.col("_second").isNotNull(),
                    safe_percent_change(_shown(n, F.col(n)), _shown(n, F.col(f"_from.{n}"))),
                ),
                F.lit(0.0),
            ).alias(n)
            for n in TOTALS
        ]
    )
    bases = totals.hold(bases.df.select(order, CHUNK, percents.alias("_own")))
    marked = totals.like(totals.drop("_top").df.join(bases, [order, CHUNK], "left"))
    marked = marked.last_before(upto=True, within=bases, _kept=F.col("_own"))
    change = F.col("_kept")
    return marked.rows().select(
        order, "taxi_id", "event_s", "processed_at_utc_ms",
        F.col("active").alias("active_taxis_count"),
        change["active"].alias("active_taxis_change"),
        F.col("ended").alias("trip_ended_taxis_count"),
        change["ended"].alias("trip_ended_taxis_change"),
        (half_up_ratio(F.col("metres"), F.lit(10)) / 100.0).alias("total_distance_km"),
        change["metres"].alias("total_distance_change"),
        F.col("transit").alias("in_transit_taxis_count"),
        change["transit"].alias("in_transit_taxis_change"),
        *([F.col("_own").isNotNull().alias("_base"), *TOTALS] if with_state else []),
    )


def _shown(name: str, value: Column) -> Column:
    return value / F.lit(1000.0) if name == "metres" else value.cast("double")


def closing_rows(rows: DataFrame) -> DataFrame:
    """The rows that decide how totals and changes go on: the last three bases and the last row.

    Put before later differences, as differences between themselves, they give those rows the same
    totals and changes as one run over everything would.
    """
    state = ["seq", "taxi_id", "event_s", "processed_at_utc_ms", *TOTALS]
    bases = rows.where("_base").orderBy(F.col("seq").desc()).limit(3).select(*state)
    last = rows.orderBy(F.col("seq").desc()).limit(1).select(*state)
    return bases.unionByName(last).distinct()


def as_differences(closing: DataFrame) -> DataFrame:
    """At most four closing rows, as differences each against the one before it."""
    in_order = Window.partitionBy(F.lit(0)).orderBy("seq")
    return closing.withColumns(
        {f"_d_{n}": F.col(n) - F.coalesce(F.lag(n).over(in_order), F.lit(0)) for n in TOTALS}
    ).drop(*TOTALS)


def fleet_seconds(rows: DataFrame) -> DataFrame:
    """The last fleet row of each event second."""
    names = [c for c in rows.columns if c not in ("event_s", "seq", "taxi_id")]
    last = rows.groupBy("event_s").agg(F.max_by(F.struct(*names), "seq").alias("_last"))
    return last.select("event_s", "_last.*")


def fleet_latest(rows: DataFrame) -> DataFrame:
    """The one current fleet row."""
    return rows.orderBy(F.col("seq").desc()).limit(1)


def as_message(rows: DataFrame) -> DataFrame:
    """The nested message; inactive taxis are not computed and stay 0."""

    def metric(value: Column, name: str, change: Column) -> Column:
        return F.struct(value.alias(name), change.alias("change_from_last_hour"))

    return rows.select(
        "seq",
        metric(F.col("active_taxis_count"), "count", F.col("active_taxis_change")).alias("active_taxis"),
        metric(F.lit(0).cast("bigint"), "count", F.lit(0.0)).alias("inactive_taxis"),
        metric(F.col("trip_ended_taxis_count"), "count", F.col("trip_ended_taxis_change")).alias(
            "trip_ended_taxis"
        ),
        metric(F.col("total_distance_km"), "distance", F.col("total_distance_change")).alias(
            "total_distance"
        ),
        metric(F.col("in_transit_taxis_count"), "count", F.col("in_transit_taxis_change")).alias(
            "in_transit_taxis"
        ),
    )
