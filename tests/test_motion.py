"""Edge rules of the keyed operators on hand-written sequences."""

import pytest
from helpers import make

from trackflow.config import Settings
from trackflow.operators import alerts, motion
from trackflow.plans.chain import averaged, moving, ordered_pings, process

A, E, I = "active", "end", "inactive"


def run(spark, steps, op, *names, cfg=None):
    ordered = ordered_pings(make(spark, steps), cfg or Settings())
    rows = op(ordered).rows().orderBy("seq")
    return [tuple(r) if len(names) > 1 else r[0] for r in rows.select(*names).collect()]


def test_dedup_only_consecutive_active_repeats(spark):
    steps = [(1, 0, A), (1, 0, A), (2, 0, A), (1, 0, A), (1, 0, I), (1, 0, A), (1, 0, E), (1, 0, A), (None, 0, A)]
    assert run(spark, steps, motion.dedup_same_timestamp, "seq") == [0, 2, 3, 4, 6, 7]


def test_downsample_is_greedy_and_drops_late_rows(spark):
    steps = [(0, 0, A), (3, 0, A), (6, 0, A), (10, 0, A), (11, 0, A), (2, 0, A), (12, 0, E), (13, 0, A)]
    assert run(spark, steps, motion.downsample, "seq") == [0, 2, 4, 6, 7]


def test_speed_rules(spark):
    steps = [
        (0, 0, A),      # first: 0, valid
        (3600, 10, A),  # 10 km in an hour
        (7200, 10.05, A),  # below the floor: 0
        (7260, 16, A),  # 357 km/h: invalid
        (10860, 26, A),  # against the invalid position: 10 km/h
        (10860, 26, I),  # no time passed, inactive: last valid speed
        (10860, 26, A),  # no time passed, active: invalid
        (10800, 26, A),  # late: invalid
        (14400, None, E),  # no position: ignored, the trip goes on
        (14460, 26, E),
        (14470, 90, A),  # new trip
    ]
    got = run(spark, steps, motion.speed, "seq", "speed", "is_valid_speed")
    assert got == [
        (0, 0.0, True), (1, 10.0, True), (2, 0.0, True), (3, 0.0, False), (4, 10.0, True),
        (5, 10.0, True), (6, 0.0, False), (7, 0.0, False), (9, 0.0, True), (10, 0.0, True),
    ]


def test_average_drops_invalid_rows_unless_they_end_the_trip(spark):
    steps = [(0, 0, A), (3600, 10, A), (3660, 20, A), (7260, 40, I), (7320, 60, E), (9000, 0, A)]
    got = run(spark, steps, averaged, "seq", "speed", "is_valid_speed", "avg_speed")
    # 10 km a minute is invalid; the inactive row repeats the mean; the invalid end keeps it.
    assert got == [(0, 0.0, True, 0.0), (1, 10.0, True, 5.0), (3, 20.0, True, 5.0),
                   (4, 0.0, False, 5.0), (5, 0.0, True, 0.0)]


def test_null_validity_counts_as_valid(spark):
    from pyspark.sql import functions as F

    pings = make(spark, [(0, 0, A), (60, 1, A)])
    for flag, rows in ((None, 2), (False, 0)):
        df = pings.withColumns({"speed": F.lit(60.0), "is_valid_speed": F.lit(flag).cast("boolean")})
        assert motion.average_speed(ordered_pings(df)).rows().count() == rows
        out = alerts.speeding(ordered_pings(df)).rows()
        assert out.where("speed_alert").count() == (1 if rows else 0)


def test_invalid_end_does_not_clear_the_distance(spark):
    steps = [(0, 0, A), (3600, 10, A), (3660, 40, E), (7260, 30, A), (10860, 20, E), (14460, 20, A), (18060, 25, A)]
    got = run(spark, steps, moving, "seq", "total_distance_km")
    # The end at 1800 km/h is swallowed here, although it ends the trip for the speed.
    assert got == [(0, 0.0), (1, 10.0), (3, 30.0), (4, 40.0), (5, 0.0), (6, 5.0)]


def ring(spark, steps):
    rows = process(make(spark, steps)).orderBy("seq").collect()
    return [r.seq for r in rows if r.geofence_alert]


def test_geofence_alert_on_entering_the_ring(spark):
    hour = 3600
    enter_twice = [(0, 5, A), (hour, 12, A), (2 * hour, 13, A), (3 * hour, 9, A), (4 * hour, 11, A)]
    assert ring(spark, enter_twice) == [1, 4]
    over_and_back = [(0, 12, A), (hour, 16, A), (2 * hour, 12, A)]
    assert ring(spark, over_and_back) == [0]
    new_trip = [(0, 12, A), (hour, 12, E), (2 * hour, 12, A)]
    assert ring(spark, new_trip) == [0, 2]
    glitch = [(0, 5, A), (10, 12, A), (hour, 12, A)]
    assert ring(spark, glitch) == [2]


def test_invalid_row_in_the_ring_does_not_warn(spark):
    from pyspark.sql import functions as F

    df = make(spark, [(0, 12, A), (60, 12, A)]).withColumn("is_valid_speed", F.col("seq") > 0)
    rows = alerts.geofence(ordered_pings(df)).rows().orderBy("seq").collect()
    assert [r.geofence_alert for r in rows] == [False, True]
    assert [r.is_in_range for r in rows] == [True, True]


def test_speed_alert_is_edge_triggered(spark):
    from pyspark.sql import functions as F

    speeds = [51.0, 52.0, 49.0, 53.0, None, 54.0, 50.0, 50.01]
    df = make(spark, [(i * 60, 0, A) for i in range(len(speeds))])
    speed = F.element_at(F.array(*[F.lit(s).cast("double") for s in speeds]), F.col("seq").cast("int") + 1)
    df = df.withColumns({"speed": speed, "is_valid_speed": F.lit(True)})
    rows = alerts.speeding(ordered_pings(df)).rows().orderBy("seq").collect()
    assert [r.seq for r in rows if r.speed_alert] == [0, 3, 7]


def test_segments(spark):
    steps = [(0, 0, A), (1, 0, E), (2, 0, A), (3, 0, E), (4, 0, E), (5, 0, A)]
    assert run(spark, steps, motion.trip_segments, "seg") == [0, 0, 1, 1, 2, 3]


@pytest.mark.parametrize("interval", [1, 5, 300])
def test_interval_is_a_setting(spark, interval):
    steps = [(s, 0, A) for s in range(0, 900, 2)]
    got = run(spark, steps, lambda o: motion.downsample(o, interval), "event_s")
    want, last = [], None
    for s in range(0, 900, 2):
        if last is None or s - last >= interval:
            want, last = [*want, s], s
    assert got == want
