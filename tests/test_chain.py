"""The whole batch chain: same rows as the row-at-a-time chain, two exchanges, any chunking."""

import math
from types import SimpleNamespace

import pytest
from helpers import PING, random_pings
from rowwise import Memory, advance

from trackflow.config import Settings
from trackflow.operators import alerts, fleet
from trackflow.plans.chain import moving, ordered_pings, process

NAMES = ["speed", "is_valid_speed", "avg_speed", "total_distance_km",
         "distance_from_forbidden_city_km", "is_in_range", "geofence_alert", "speed_alert"]


def one_by_one(rows, cfg=Settings()):
    memory, out = {}, {}
    for r in rows:
        ping = SimpleNamespace(**{f.name: math.nan if v is None else v for f, v in zip(PING.fields, r)})
        result = advance(memory.setdefault(ping.taxi_id, Memory()), ping, cfg)
        if result is not None:
            out[ping.seq] = result
    return out


@pytest.mark.parametrize("seed,limit", [(1, 10_000), (2, 10_000), (3, 40)])
def test_batch_equals_one_by_one(spark, seed, limit):
    rows = random_pings(800, seed)
    want = one_by_one(rows)
    got = process(spark.createDataFrame(rows, PING), Settings(max_group_rows=limit)).collect()
    assert {r.seq for r in got} == set(want)
    for r in got:
        assert [r[n] for n in NAMES] == want[r.seq][: len(NAMES)], r


def expected_fleet(rows, results, interval=5):
    """Fleet rows by definition: every taxi's latest state, counted anew for each row.

    The bases of the changes are found from the list of event times first: the first row, then each
    row at least the interval later than the base before it."""
    order = sorted(results)
    second = {r[0]: r[2] for r in rows}
    bases = [order[0]]
    for seq in order:
        if second[seq] - second[bases[-1]] >= interval:
            bases.append(seq)
    label = {r[0]: (r[1], r[5]) for r in rows}
    latest, kilometres, totals = {}, {}, {}
    for seq in order:
        taxi, status = label[seq]
        kilometres[taxi] = results[seq][3]
        if status in ("active", "end"):
            latest[taxi] = (status, results[seq][0])
        moving = [v for s, v in latest.values() if s == "active"]
        totals[seq] = (len(moving), len(latest) - len(moving), sum(v > 0.1 for v in moving), sum(kilometres.values()))
    changes = {}
    for i, base in enumerate(bases[1:], 1):
        was = totals[bases[i - 1]] if i > 1 else (0, 0, 0, 0.0)
        changes[base] = tuple(100 * (n - w) / w if w else 0.0 for n, w in zip(totals[base], was))
    shown, now = {}, (0.0, 0.0, 0.0, 0.0)
    for seq in order:
        now = changes.get(seq, now)
        shown[seq] = (totals[seq], now)
    return shown


@pytest.mark.parametrize("limit", [10_000, 50])
def test_fleet_equals_definition(spark, limit):
    rows = random_pings(700, 7)
    cfg = Settings(max_group_rows=limit)
    df = spark.createDataFrame(rows, PING)
    got = {r.seq: r for r in fleet.fleet_rows(moving(ordered_pings(df, cfg), cfg), cfg).collect()}
    want = expected_fleet(rows, one_by_one(rows))
    assert set(got) == set(want)
    for seq, (totals, changes) in want.items():
        r = got[seq]
        assert (r.active_taxis_count, r.trip_ended_taxis_count, r.in_transit_taxis_count) == totals[:3]
        assert r.total_distance_km == pytest.approx(totals[3], abs=0.0051)
        shown = (r.active_taxis_change, r.trip_ended_taxis_change, r.in_transit_taxis_change, r.total_distance_change)
        assert shown == pytest.approx(changes, abs=0.011), seq


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.strip(" :+-") for line in plan.splitlines() if " Exchange " in f" {line.strip(' :+-')} "]


def test_exchanges_and_no_single_partition(spark):
    rows = spark.createDataFrame(random_pings(50, 1), PING)
    plain = exchanges(process(rows))
    # One for the arriving rows, one for the fewer rows that the down-sampling leaves.
    assert len(plain) == 2 and all("hashpartitioning(taxi_id" in p for p in plain), plain
    plan = process(rows)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "ArrowEvalPython" not in plan
    cut = exchanges(process(rows, Settings(max_group_rows=10)))
    assert any("_chunk" in e for e in cut), cut
    assert not any("SinglePartition" in e for e in cut)


def test_alerts_union_and_log(spark, pings):
    processed = process(pings).cache()
    both = alerts.all_alerts(processed)
    kinds = {r.alert_type: r["count"] for r in both.groupBy("alert_type").count().collect()}
    assert kinds["GEOFENCE_VIOLATION"] == alerts.geofence_alerts(processed).count()
    assert kinds["SPEED_VIOLATION"] == alerts.speed_alerts(processed).count()
    log = alerts.incident_log(both)
    assert log.select("incident_id").distinct().count() == log.count()
    last = [r.seq for r in alerts.last_incidents(log, 10).collect()]
    assert last == sorted(last) and len(last) == 10
    assert last[-1] == both.agg({"seq": "max"}).first()[0]


def test_properties(spark, pings):
    rows = process(pings).orderBy("taxi_id", "seq").collect()
    for before, after in zip(rows, rows[1:]):
        if before.taxi_id == after.taxi_id and before.trip_status != "end":
            assert after.total_distance_km >= before.total_distance_km
    fleet_rows = fleet.fleet_rows(moving(ordered_pings(pings))).collect()
    taxis = len({r.taxi_id for r in rows})
    assert all(r.active_taxis_count + r.trip_ended_taxis_count <= taxis for r in fleet_rows)
    assert all(r.in_transit_taxis_count <= r.active_taxis_count for r in fleet_rows)
