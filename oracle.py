"""DuckDB SQL that each named query must agree with, built from shared named steps."""

from __future__ import annotations

import re

STEPS: dict[str, str] = {}
ORACLE: dict[str, str] = {}

STEPS["base"] = """
SELECT event_id AS seq, CAST(user_id + 1 AS INTEGER) AS taxi_id,
  CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k, event_type,
  1201910400 + (epoch_us(ts) // 1000 - 1704067200000) // 60000 AS event_s,
  CAST(round(value * 100) AS BIGINT) AS cents, CAST(round(value * 20) AS BIGINT) AS lag_ms,
  epoch_us(ts) // 1000 AS sent_at_utc_ms
FROM events"""
STEPS["pings"] = """
SELECT seq, taxi_id, k, event_type, event_s,
  CASE WHEN event_type = 'view' AND k = 0 THEN NULL
       ELSE 39.9163::DOUBLE + (k - 50) / 50.0::DOUBLE * 0.12::DOUBLE END AS latitude,
  116.3972::DOUBLE + (cents % 100 - 50) / 50.0::DOUBLE * 0.15::DOUBLE AS longitude,
  CASE WHEN seq = max(seq) OVER (PARTITION BY taxi_id) OR (event_type = 'error' AND k < 5) THEN 'end'
       WHEN event_type = 'signup' AND k >= 95 THEN 'inactive' ELSE 'active' END AS trip_status,
  sent_at_utc_ms,
  sent_at_utc_ms + lag_ms
    - CASE WHEN event_type = 'error' AND k = 2 THEN 20000 ELSE 0 END AS processed_at_utc_ms
FROM base"""


def km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    )
    return f"(2 * 6371 * atan2(sqrt({a}), sqrt(1 - {a})))"


CENTRE = km("latitude", "longitude", "39.9163::DOUBLE", "116.3972::DOUBLE")


def half_up(n: str, d: str) -> str:
    return f"(sign({n}) * ((2 * abs({n}) + {d}) // (2 * {d})))"


def seconds_text(s: str) -> str:
    return f"strftime(make_timestamp(({s}) * 1000000), '%Y-%m-%d %H:%M:%S')"


def ms_text(ms: str, form: str = "%Y-%m-%dT%H:%M:%S.%g") -> str:
    return f"strftime(make_timestamp(CAST(({ms}) * 1000 AS BIGINT)), '{form}')"


PING = "seq, taxi_id, event_s, latitude, longitude, trip_status"
TRIP = "(PARTITION BY taxi_id, seg ORDER BY seq)"


def segmented(source: str, where: str = "TRUE") -> str:
    return f"""
SELECT *, coalesce(sum(CASE WHEN trip_status = 'end' THEN 1 ELSE 0 END) OVER (
  PARTITION BY taxi_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS seg
FROM {source} WHERE {where}"""


# -- keyed chain
STEPS["dedup"] = """
SELECT * EXCLUDE (was_s, was_status) FROM (
  SELECT *, lag(event_s) OVER w AS was_s, lag(trip_status) OVER w AS was_status
  FROM pings WHERE event_s IS NOT NULL WINDOW w AS (PARTITION BY taxi_id ORDER BY seq))
WHERE trip_status <> 'active' OR was_status IS NULL OR was_status = 'end' OR was_s <> event_s"""
STEPS["numbered"] = "SELECT *, row_number() OVER (PARTITION BY taxi_id ORDER BY seq) AS rn FROM dedup"
for interval in (5, 300):
    STEPS[f"walk{interval}"] = f"""
SELECT taxi_id, rn, seq, CASE WHEN trip_status = 'end' THEN NULL ELSE event_s END AS last, TRUE AS keep
FROM numbered WHERE rn = 1
UNION ALL
SELECT n.taxi_id, n.rn, n.seq,
  CASE WHEN n.trip_status = 'end' THEN NULL
       WHEN w.last IS NULL OR n.event_s - w.last >= {interval} THEN n.event_s ELSE w.last END,
  n.trip_status = 'end' OR w.last IS NULL OR n.event_s - w.last >= {interval}
FROM walk{interval} w JOIN numbered n ON n.taxi_id = w.taxi_id AND n.rn = w.rn + 1"""
    STEPS[f"sampled{interval}"] = f"""
SELECT d.* FROM dedup d JOIN walk{interval} w ON d.seq = w.seq WHERE w.keep"""
STEPS["located"] = segmented("sampled5", "latitude IS NOT NULL AND longitude IS NOT NULL")
STEPS["raw_speed"] = f"""
SELECT *, CASE WHEN dt > 0 THEN
    {km("latitude", "longitude", "was_lat", "was_lon")} / (dt / 3600.0::DOUBLE) END AS kmph
FROM (SELECT *, event_s - lag(event_s) OVER w AS dt, lag(latitude) OVER w AS was_lat,
        lag(longitude) OVER w AS was_lon FROM located WINDOW w AS {TRIP})"""
STEPS["known_speed"] = """
SELECT *, CASE WHEN dt IS NULL THEN 0.0::DOUBLE WHEN kmph < 0.1 THEN 0.0::DOUBLE
               WHEN kmph <= 300 THEN kmph END AS known FROM raw_speed"""
STEPS["speeds"] = """
SELECT * EXCLUDE (seg, dt, was_lat, was_lon, kmph, known, memory, v),
  round(coalesce(v, 0.0::DOUBLE), 2) AS speed, v IS NOT NULL AS is_valid_speed
FROM (SELECT *, CASE WHEN dt <= 0 AND trip_status = 'inactive' THEN memory ELSE known END AS v
  FROM (SELECT *, last_value(known IGNORE NULLS) OVER (
          PARTITION BY taxi_id, seg ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS memory
        FROM known_speed))"""
STEPS["speeds_seg"] = segmented("speeds")
STEPS["averages"] = f"""
SELECT * EXCLUDE (seg, total, n), CASE WHEN n > 0 THEN {half_up("total", "n")} / 100.0::DOUBLE
  ELSE 0.0::DOUBLE END AS avg_speed
FROM (SELECT *,
    sum(CASE WHEN is_valid_speed AND trip_status IN ('active', 'end')
        THEN CAST(round(speed * 100) AS BIGINT) ELSE 0 END) OVER {TRIP}::BIGINT AS total,
    sum(CASE WHEN is_valid_speed AND trip_status IN ('active', 'end') THEN 1 ELSE 0 END)
        OVER {TRIP}::BIGINT AS n FROM speeds_seg)
WHERE is_valid_speed OR trip_status = 'end'""".replace(
    f"OVER {TRIP}::BIGINT", f"OVER {TRIP}"
).replace(half_up("total", "n"), half_up("total::BIGINT", "n::BIGINT"))
STEPS["valid_seg"] = segmented(
    "averages", "is_valid_speed AND latitude IS NOT NULL AND longitude IS NOT NULL"
)
STEPS["legs"] = f"""
SELECT *, CAST(round(coalesce({km("latitude", "longitude", "was_lat", "was_lon")}, 0.0::DOUBLE) * 1e9) AS BIGINT) AS leg
FROM (SELECT *, lag(latitude) OVER w AS was_lat, lag(longitude) OVER w AS was_lon
      FROM valid_seg WINDOW w AS {TRIP})"""
STEPS["moving"] = f"""
SELECT * EXCLUDE (was_lat, was_lon, leg, um), CAST({half_up("um", "1000000")} AS BIGINT) / 1000.0::DOUBLE AS total_distance_km
FROM (SELECT *, CAST(sum(leg) OVER {TRIP} AS BIGINT) AS um FROM legs)"""
STEPS["ringed"] = f"""
SELECT *, CASE WHEN d > 10 AND d <= 15 THEN 1 WHEN d <= 10 THEN 0 END AS marker,
  CASE WHEN speed > 50 THEN 1 ELSE 0 END AS above
FROM (SELECT *, {CENTRE} AS d FROM moving)"""
STEPS["processed"] = """
SELECT * EXCLUDE (seg, d, marker, above, warned, alerted),
  round(d, 2) AS distance_from_forbidden_city_km, d <= 15 AS is_in_range,
  coalesce(marker, 0) = 1 AND coalesce(warned, 0) = 0 AS geofence_alert,
  above = 1 AND coalesce(alerted, 0) = 0 AS speed_alert
FROM (SELECT *, last_value(marker IGNORE NULLS) OVER (
        PARTITION BY taxi_id, seg ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS warned,
      lag(above) OVER (PARTITION BY taxi_id, seg ORDER BY seq) AS alerted FROM ringed)"""
ALERT = "taxi_id, seq, event_s, latitude, longitude, trip_status, processed_at_utc_ms"
STEPS["geo_alerts"] = f"""
SELECT {ALERT}, distance_from_forbidden_city_km AS distance_km, 'GEOFENCE_VIOLATION' AS alert_type
FROM processed WHERE geofence_alert"""
STEPS["fast_alerts"] = f"""
SELECT {ALERT}, speed, 'SPEED_VIOLATION' AS alert_type FROM processed WHERE speed_alert"""
STEPS["alerts"] = f"""
SELECT {ALERT}, alert_type, distance_km, NULL::DOUBLE AS speed FROM geo_alerts
UNION ALL SELECT {ALERT}, alert_type, NULL::DOUBLE AS distance_km, speed FROM fast_alerts"""
STEPS["log"] = f"""
SELECT substr(sha256(concat_ws('|', taxi_id, alert_type, seq)), 1, 16) AS incident_id, taxi_id, alert_type,
  {seconds_text("event_s")} AS timestamp, latitude, longitude, trip_status, distance_km, speed,
  {ms_text("processed_at_utc_ms", "%Y-%m-%d %H:%M:%S")} AS updated_at, seq FROM alerts"""
STEPS["latest"] = """
SELECT * EXCLUDE (last_seq) FROM (SELECT *, max(seq) OVER (PARTITION BY taxi_id) AS last_seq FROM processed)
WHERE seq = last_seq"""

# -- fleet
BEFORE = "(PARTITION BY taxi_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
STEPS["fleet_state"] = """
SELECT seq, taxi_id, event_s, processed_at_utc_ms,
  CASE WHEN trip_status IN ('active', 'end') THEN (trip_status = 'active')::INTEGER END AS a,
  CASE WHEN trip_status IN ('active', 'end') THEN (trip_status = 'end')::INTEGER END AS e,
  CASE WHEN trip_status IN ('active', 'end')
       THEN (trip_status = 'active' AND speed > 0.1)::INTEGER END AS t,
  CAST(round(total_distance_km * 1000) AS BIGINT) AS m
FROM moving"""
STEPS["fleet_delta"] = f"""
SELECT seq, taxi_id, event_s, processed_at_utc_ms,
  coalesce(a - coalesce(last_value(a IGNORE NULLS) OVER {BEFORE}, 0), 0) AS da,
  coalesce(e - coalesce(last_value(e IGNORE NULLS) OVER {BEFORE}, 0), 0) AS de,
  coalesce(t - coalesce(last_value(t IGNORE NULLS) OVER {BEFORE}, 0), 0) AS dt,
  m - coalesce(last_value(m IGNORE NULLS) OVER {BEFORE}, 0) AS dm
FROM fleet_state"""
STEPS["fleet_total"] = """
SELECT seq, taxi_id, event_s, processed_at_utc_ms,
  CAST(sum(da) OVER w AS BIGINT) AS a, CAST(sum(de) OVER w AS BIGINT) AS e,
  CAST(sum(dt) OVER w AS BIGINT) AS t, CAST(sum(dm) OVER w AS BIGINT) AS m
FROM fleet_delta WINDOW w AS (ORDER BY seq ROWS UNBOUNDED PRECEDING)"""
STEPS["first_of_second"] = """
SELECT *, row_number() OVER (PARTITION BY run ORDER BY seq) AS rn FROM (
  SELECT *, sum(CASE WHEN gap IS NULL OR gap >= 5 THEN 1 ELSE 0 END) OVER (ORDER BY seq) AS run FROM (
    SELECT *, event_s - max(event_s) OVER (
        ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gap
    FROM (SELECT event_s, min(seq) AS seq FROM moving GROUP BY event_s)))"""
STEPS["base_walk"] = """
SELECT run, rn, seq, event_s AS last, TRUE AS keep FROM first_of_second WHERE rn = 1
UNION ALL
SELECT n.run, n.rn, n.seq, CASE WHEN n.event_s - w.last >= 5 THEN n.event_s ELSE w.last END,
  n.event_s - w.last >= 5
FROM base_walk w JOIN first_of_second n ON n.run = w.run AND n.rn = w.rn + 1"""
STEPS["bases"] = """
SELECT *, row_number() OVER (ORDER BY seq) AS b, lag(a) OVER (ORDER BY seq) AS pa,
  lag(e) OVER (ORDER BY seq) AS pe, lag(t) OVER (ORDER BY seq) AS pt, lag(m) OVER (ORDER BY seq) AS pm
FROM fleet_total JOIN (SELECT seq FROM base_walk WHERE keep) USING (seq)"""


def change(now: str, was: str, scale: str = "") -> str:
    n, w = f"({now}{scale})", f"({was}{scale})"
    return (
        f"CASE WHEN b <= 2 OR {was} = 0 THEN 0.0::DOUBLE"
        f" ELSE round(({n} - {w}) / {w} * 100, 2) END"
    )


STEPS["base_change"] = f"""
SELECT seq, {change("a", "pa", "::DOUBLE")} AS ca, {change("e", "pe", "::DOUBLE")} AS ce,
  {change("t", "pt", "::DOUBLE")} AS ct, {change("m", "pm", " / 1000.0::DOUBLE")} AS cm FROM bases"""
STEPS["fleet"] = f"""
SELECT seq, taxi_id, event_s, processed_at_utc_ms, a AS active_taxis_count,
  last_value(ca IGNORE NULLS) OVER w AS active_taxis_change, e AS trip_ended_taxis_count,
  last_value(ce IGNORE NULLS) OVER w AS trip_ended_taxis_change,
  {half_up("m", "10")} / 100.0::DOUBLE AS total_distance_km,
  last_value(cm IGNORE NULLS) OVER w AS total_distance_change, t AS in_transit_taxis_count,
  last_value(ct IGNORE NULLS) OVER w AS in_transit_taxis_change
FROM fleet_total LEFT JOIN base_change USING (seq)
WINDOW w AS (ORDER BY seq ROWS UNBOUNDED PRECEDING)"""
FLEET = (
    "active_taxis_count, active_taxis_change, trip_ended_taxis_count, trip_ended_taxis_change,"
    " total_distance_km, total_distance_change, in_transit_taxis_count, in_transit_taxis_change"
)

# -- dirty rows and cleaning
STEPS["raw"] = f"""
SELECT CASE WHEN k <> 4 THEN taxi_id END AS taxi_id,
  CASE WHEN k = 5 AND event_type = 'click' THEN 'bad' ELSE {seconds_text("event_s")} END AS timestamp,
  CASE WHEN k = 1 THEN 500.0::DOUBLE WHEN k = 2 THEN NULL ELSE longitude END AS longitude,
  CASE WHEN k = 3 THEN -95.0::DOUBLE ELSE latitude END AS latitude,
  concat(taxi_id, '.txt') AS file, seq * 2 + copy AS line, trip_status
FROM pings JOIN (SELECT 0 AS copy UNION ALL SELECT 1) ON copy = 0 OR k = 6"""
COORDS = """
  CASE WHEN longitude BETWEEN -180 AND 180 THEN longitude ELSE -1.0::DOUBLE END AS longitude,
  CASE WHEN latitude BETWEEN -90 AND 90 THEN latitude ELSE -1.0::DOUBLE END AS latitude"""
STEPS["parsed"] = f"""
SELECT coalesce(taxi_id, CAST(regexp_extract(file, '([0-9]+)[.]txt', 1) AS INTEGER)) AS taxi_id,
  timestamp, {COORDS}, file, line
FROM raw WHERE try_cast(timestamp AS TIMESTAMP) IS NOT NULL"""
STEPS["marked"] = """
SELECT taxi_id, timestamp, longitude, latitude, file, line,
  CASE WHEN line = max(line) OVER (PARTITION BY file) THEN 'end' ELSE 'active' END AS trip_status
FROM parsed"""
STEPS["cleaned"] = """
SELECT DISTINCT taxi_id, timestamp, longitude, latitude, trip_status FROM marked"""
STEPS["batches"] = """
SELECT epoch_us(CAST(timestamp AS TIMESTAMP)) // 1000000 AS batch_s, count(*) AS messages
FROM cleaned GROUP BY 1"""
STEPS["conflict_input"] = """
SELECT seq, taxi_id, event_s AS timestamp, latitude, longitude FROM pings
UNION ALL SELECT seq + 1000000, taxi_id, event_s, latitude + 0.01::DOUBLE, longitude FROM pings WHERE k = 7"""
STEPS["conflicts"] = """
SELECT i.* FROM conflict_input i JOIN (
  SELECT taxi_id, timestamp FROM conflict_input GROUP BY ALL
  HAVING count(DISTINCT latitude) > 1 OR count(DISTINCT longitude) > 1) USING (taxi_id, timestamp)"""
STEPS["diffs"] = """
SELECT taxi_id, timestamp, abs(max(latitude) FILTER (rn = 1) - max(latitude) FILTER (rn = 2)) AS lat_diff,
  abs(max(longitude) FILTER (rn = 1) - max(longitude) FILTER (rn = 2)) AS lon_diff
FROM (SELECT *, row_number() OVER (PARTITION BY taxi_id, timestamp ORDER BY seq) AS rn FROM conflicts)
GROUP BY ALL HAVING lat_diff IS NOT NULL AND lon_diff IS NOT NULL"""

# -- points and benchmark input
STEPS["points"] = f"""
SELECT seq, CAST(taxi_id AS VARCHAR) AS taxi_id, trip_status, speed, avg_speed, latitude, longitude,
  is_valid_speed, distance_from_forbidden_city_km, is_in_range, total_distance_km,
  {seconds_text("event_s")} AS timestamp, CAST(sent_at_utc_ms AS DOUBLE) AS sent_at_utc_ms,
  processed_at_utc_ms AS time_ms FROM processed"""
STEPS["alert_points"] = """
SELECT seq, CAST(taxi_id AS VARCHAR) AS taxi_id, alert_type, coalesce(distance_km, 0.0::DOUBLE) AS distance_km,
  coalesce(speed, 0.0::DOUBLE) AS speed, processed_at_utc_ms AS time_ms FROM alerts"""
STEPS["messages"] = """
SELECT seq, taxi_id, sent_at_utc_ms, processed_at_utc_ms,
  CASE WHEN processed_at_utc_ms >= sent_at_utc_ms THEN processed_at_utc_ms - sent_at_utc_ms END AS ms
FROM processed"""


def windows(width: int) -> str:
    """Step with one row per window, empty ones included."""
    name = f"windows{width}"
    STEPS[f"{name}_own"] = f"""
SELECT processed_at_utc_ms // {width} AS w, count(*) AS n, count(ms) AS samples, sum(ms) AS total
FROM messages GROUP BY 1"""
    STEPS[f"{name}_new"] = f"""
SELECT w, count(*) AS new FROM (
  SELECT min(processed_at_utc_ms) // {width} AS w FROM messages GROUP BY taxi_id) GROUP BY w"""
    STEPS[name] = f"""
SELECT w * {width} AS window_start_utc_ms, (w + 1) * {width} AS window_end_utc_ms,
  CAST(sum(coalesce(new, 0)) OVER (ORDER BY w) AS BIGINT) AS cumulative_taxi_count,
  CAST(sum(coalesce(n, 0)) OVER (ORDER BY w) AS BIGINT) AS total_messages,
  CASE WHEN samples > 0 THEN {half_up("CAST(total AS BIGINT) * 100", "samples")} / 100.0::DOUBLE
       ELSE 0.0::DOUBLE END AS mean_latency_ms,
  coalesce(samples, 0) AS latency_samples,
  {ms_text(f"w * {width}", "%Y-%m-%dT%H:%M:%S")} || '+00:00' AS timestamp_utc
FROM (SELECT unnest(generate_series(min(w), max(w))) AS w FROM {name}_own)
LEFT JOIN {name}_own USING (w) LEFT JOIN {name}_new USING (w)"""
    return name


MINUTE, HOUR, DAY = windows(60_000), windows(3_600_000), windows(86_400_000)


def sql(final: str) -> str:
    """The query with the steps it needs, in order."""
    needed: list[str] = []

    def visit(text: str, me: str | None = None) -> None:
        for name in STEPS:
            if name != me and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) and name not in needed:
                visit(STEPS[name], name)
                needed.append(name)

    visit(final)
    ctes = ",\n".join(f"{name} AS ({STEPS[name]})" for name in needed)
    return f"WITH RECURSIVE {ctes}\n{final}" if needed else final


def define(name: str, final: str) -> None:
    ORACLE[name] = sql(final)


STEPS["schedule"] = """
SELECT batch_s, coalesce(sum(messages) OVER (ORDER BY batch_s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier,
  1704067200000 + (batch_s - min(batch_s) OVER ()) * 1000 AS sent_at_utc_ms
FROM batches"""
STEPS["sent"] = """
SELECT CAST(earlier + row_number() OVER (PARTITION BY batch_s ORDER BY taxi_id NULLS FIRST, trip_status, longitude, latitude) AS BIGINT) AS seq,
  taxi_id, timestamp, longitude, latitude, batch_s AS event_s, trip_status, sent_at_utc_ms
FROM cleaned JOIN schedule ON epoch_us(CAST(timestamp AS TIMESTAMP)) // 1000000 = batch_s"""


def over_sent(final: str) -> str:
    """A query of the chain with the sent pings in place of the stand-in's."""
    kept = dict(STEPS)
    for name, text in kept.items():
        if name not in ("raw", "marked", "cleaned", "batches", "schedule", "sent"):
            STEPS[name] = re.sub(r"\b(FROM|JOIN)(\s+)pings\b", r"\1\2sent", text)
    query = sql(final)
    STEPS.update(kept)
    return query


define("cleaned_pings", "SELECT * FROM sent")
define("cleaned_messages", "SELECT CAST(taxi_id AS VARCHAR) AS key, seq, taxi_id, timestamp, longitude, latitude, trip_status, sent_at_utc_ms FROM sent")
LINES = """SELECT taxi_id, timestamp, longitude, latitude, file,
  row_number() OVER (PARTITION BY file ORDER BY line) - 1 AS line FROM raw"""
define("zip_scan", LINES.replace("SELECT taxi_id,", "SELECT CAST(taxi_id AS VARCHAR) AS taxi_id,", 1))
define("zip_member", f"SELECT * FROM ({LINES}) WHERE file = '1.txt'")
define("cleaned_table", "SELECT * FROM cleaned")
define("cleaned_in_time_order", "SELECT * FROM cleaned")
define("clean_pings", "SELECT * FROM cleaned")
define("clean_sentinel_coords", f"SELECT file, line, {COORDS} FROM raw")
define("trip_status_mark", "SELECT taxi_id, file, line, trip_status FROM marked")
define("distinct_rows", "SELECT DISTINCT CAST(taxi_id AS VARCHAR) AS taxi_id, timestamp, longitude, latitude, trip_status FROM raw")
define("file_limit", """SELECT file, line, timestamp FROM raw
WHERE file IN (SELECT DISTINCT file FROM raw ORDER BY file LIMIT 100)""")
define("replay_batches", "SELECT * FROM batches")
for mode, gap, rate in (("actual", "batch_s - lag(batch_s) OVER w", 2.0), ("simulated", "CASE WHEN lag(batch_s) OVER w IS NOT NULL THEN 1 END", 2.5)):
    define(f"replay_schedule_{mode}", f"""
SELECT batch_s, messages, gap / {rate}::DOUBLE AS delay_s,
  CAST(sum(gap) OVER (ORDER BY batch_s) AS BIGINT) / {rate}::DOUBLE AS offset_s
FROM (SELECT *, coalesce({gap}, 0) AS gap FROM batches WINDOW w AS (ORDER BY batch_s))""")
define("parse_messages", f"""
SELECT seq, taxi_id, {seconds_text("event_s")} AS timestamp, longitude, latitude, trip_status,
  sent_at_utc_ms, 1704067200000 AS received_at_utc_ms FROM pings WHERE k <> 9""")
define("rejected_messages", """
SELECT seq, substr('{"taxi_id":' || taxi_id || ',"timestamp"', 1, 12) AS value FROM pings WHERE k = 9""")
define("emit_messages", f"""
SELECT CAST(taxi_id AS VARCHAR) AS key, taxi_id, longitude, latitude, {seconds_text("event_s")} AS timestamp,
  sent_at_utc_ms, trip_status, speed, is_valid_speed, avg_speed,
  {half_up("CAST(round(total_distance_km * 1000) AS BIGINT)", "10")} / 100.0::DOUBLE AS total_distance_km,
  distance_from_forbidden_city_km, is_in_range, processed_at_utc_ms, sent_at_utc_ms + 3 AS received_at_utc_ms FROM processed""")
define("haversine_to_centre", f"SELECT seq, taxi_id, round({CENTRE}, 6) AS km FROM pings")
LATENCY = "(processed_at_utc_ms - sent_at_utc_ms) / 1000.0::DOUBLE"
ZONE = """CASE WHEN latency_s < 1 THEN 'excellent' WHEN latency_s < 5 THEN 'good'
  WHEN latency_s < 10 THEN 'acceptable' ELSE 'poor' END"""
define("event_latency", f"SELECT seq, {LATENCY} AS latency_s FROM pings")
define("perf_zone", f"SELECT *, {ZONE} AS zone FROM (SELECT seq, {LATENCY} AS latency_s FROM pings)")
define("status_class", """
SELECT seq, trip_status, speed, CASE
  WHEN trip_status = 'active' AND speed = 0 THEN 'Connected'
  WHEN trip_status = 'active' AND speed > 0 THEN 'In Transit'
  WHEN trip_status IN ('active', 'inactive') THEN 'Reconnecting...'
  WHEN trip_status = 'end' THEN 'Trip Complete' ELSE 'Status Unknown' END AS label FROM processed""")
define("speed_band", """
SELECT seq, trip_status, speed, CASE WHEN trip_status IN ('inactive', 'end', 'N/A') THEN 'neutral'
  WHEN speed > 0 AND speed <= 50 THEN 'safe' WHEN speed > 50 THEN 'high' ELSE 'idle' END AS band
FROM processed""")
define("distance_band", """
SELECT seq, distance_from_forbidden_city_km, CASE
  WHEN distance_from_forbidden_city_km > 10 AND distance_from_forbidden_city_km <= 15 THEN 'warn'
  WHEN distance_from_forbidden_city_km > 15 THEN 'out' ELSE 'safe' END AS band FROM processed""")
define("marker_class", """
SELECT seq, taxi_id, CASE
  WHEN is_in_range AND trip_status = 'active' AND speed = 0 AND is_valid_speed THEN 'connected'
  WHEN is_in_range AND trip_status = 'active' AND speed > 0 AND is_valid_speed THEN 'in_transit'
  WHEN is_in_range AND trip_status = 'end' THEN 'trip_ended' ELSE 'default' END AS marker FROM processed""")
define("trip_segments", f"SELECT {PING}, seg FROM ({segmented('pings')})")
define("dedup_same_ts", f"SELECT {PING} FROM dedup")
define("propagate_5s", f"SELECT {PING} FROM sampled5")
define("propagate_300s", f"SELECT {PING} FROM sampled300")
define("latest_per_tumbling_5s", f"""
SELECT event_s - event_s % 5 AS window_start, {PING} FROM pings
QUALIFY row_number() OVER (PARTITION BY taxi_id, event_s - event_s % 5 ORDER BY seq DESC) = 1""")
define("speed", f"SELECT {PING}, speed, is_valid_speed FROM speeds")
define("avg_speed", f"SELECT {PING}, speed, is_valid_speed, avg_speed FROM averages")
define("total_distance", f"SELECT {PING}, total_distance_km FROM moving")
define("geofence", f"""
SELECT {PING}, distance_from_forbidden_city_km, is_in_range, geofence_alert FROM processed""")
define("geofence_alerts", "SELECT * FROM geo_alerts")
define("speed_alerts", "SELECT * FROM fast_alerts")
define("all_alerts", "SELECT * FROM alerts")
METRICS = (
    "speed, is_valid_speed, avg_speed, total_distance_km, distance_from_forbidden_city_km, is_in_range"
)
ORACLE["cleaned_chain"] = over_sent(f"SELECT {PING}, sent_at_utc_ms, {METRICS} FROM processed")
define("processed_stream", f"SELECT {PING}, sent_at_utc_ms, processed_at_utc_ms, {METRICS} FROM processed")
define("inactive_trips", f"""
SELECT seq, taxi_id, event_s, latitude, longitude, 'inactive' AS trip_status FROM (
  SELECT *, coalesce(lead(event_s) OVER (PARTITION BY taxi_id ORDER BY seq),
                     max(event_s) OVER ()) - event_s AS silence FROM pings)
WHERE trip_status <> 'end' AND silence > 180""")
define("trip_sessions", """
SELECT taxi_id, min(event_s) AS session_start, max(event_s) + 180 AS session_end, count(*) AS pings FROM (
  SELECT *, sum(CASE WHEN gap < 180 THEN 0 ELSE 1 END) OVER (PARTITION BY taxi_id ORDER BY event_s, seq) AS s
  FROM (SELECT *, event_s - lag(event_s) OVER (PARTITION BY taxi_id ORDER BY event_s, seq) AS gap FROM pings))
GROUP BY taxi_id, s""")
define("fleet_metrics_rows", f"SELECT seq, taxi_id, event_s, processed_at_utc_ms, {FLEET} FROM fleet")
for cut_name, whole_name in (("propagate_cut", "propagate_5s"), ("processed_cut", "processed_stream"), ("fleet_cut", "fleet_metrics_rows")):
    ORACLE[cut_name] = ORACLE[whole_name]
define("fleet_metrics_seconds", f"""
SELECT event_s, processed_at_utc_ms, {FLEET} FROM fleet
QUALIFY row_number() OVER (PARTITION BY event_s ORDER BY seq DESC) = 1""")
define("fleet_latest", f"""
SELECT seq, taxi_id, event_s, processed_at_utc_ms, {FLEET} FROM fleet ORDER BY seq DESC LIMIT 1""")
define("latest_taxis", f"SELECT {PING}, {METRICS}, processed_at_utc_ms FROM latest")
define("fleet_size", f"""
SELECT {FLEET}, (SELECT count(DISTINCT taxi_id) FROM processed) AS current_taxi_fleet_size
FROM fleet ORDER BY seq DESC LIMIT 1""")
define("taxi_ids", "SELECT DISTINCT taxi_id FROM processed")
define("fleet_snapshot", """
SELECT taxi_id, trip_status, speed, 10357 AS total_taxi_fleet_size, 'actual' AS data_replay_mode,
  1.0::DOUBLE AS data_replay_speed FROM latest""")
define("merge_latest", """
SELECT coalesce(n.taxi_id, o.taxi_id) AS taxi_id, o.seq, o.event_s,
  coalesce(n.latitude, o.latitude) AS latitude, o.longitude,
  coalesce(n.trip_status, o.trip_status) AS trip_status, n.speed
FROM (SELECT * FROM pings QUALIFY row_number() OVER (PARTITION BY taxi_id ORDER BY seq DESC) = 1) o
FULL JOIN latest n ON n.taxi_id = o.taxi_id""")
SHOWN = "SELECT taxi_id, trip_status, speed, distance_from_forbidden_city_km FROM latest WHERE is_valid_speed"
define("display_filter", f"{SHOWN} AND distance_from_forbidden_city_km <= 15")
define("display_filter_strict", f"{SHOWN} AND trip_status <> 'end' AND NOT (trip_status = 'active' AND speed <= 0)")
define("incident_log", "SELECT * FROM log")
define("incident_counts", """
SELECT count(*) AS total_incidents, count(*) FILTER (alert_type = 'GEOFENCE_VIOLATION') AS geofence_violations,
  count(*) FILTER (alert_type = 'SPEED_VIOLATION') AS speed_violations FROM log""")
define("last_50_incidents", "SELECT * FROM log ORDER BY seq DESC, alert_type DESC LIMIT 50")
define("incidents_newest_first", "SELECT seq, taxi_id, alert_type FROM log ORDER BY seq DESC, alert_type DESC")
define("incidents_by_update", "SELECT incident_id, updated_at FROM log ORDER BY updated_at DESC")
define("incident_taxi_lookup", """
SELECT incident_id, log.taxi_id, t.trip_status AS latest_status, t.latitude AS latest_latitude,
  t.longitude AS latest_longitude, t.speed AS latest_speed FROM log LEFT JOIN latest t ON t.taxi_id = log.taxi_id""")
define("points_taxi", "SELECT * FROM points")
define("points_fleet", f"SELECT seq, {FLEET}, processed_at_utc_ms AS time_ms FROM fleet")
define("points_alerts", "SELECT * FROM alert_points")
FIELDS = (
    "speed, avg_speed, latitude, longitude, distance_from_forbidden_city_km, total_distance_km, sent_at_utc_ms"
)
define("points_unpivot", f"""
UNPIVOT (SELECT seq, taxi_id, trip_status, time_ms, {FIELDS} FROM points)
ON {FIELDS} INTO NAME field VALUE value""")
define("points_pivot", f"SELECT seq, taxi_id, trip_status, time_ms, {FIELDS} FROM points")
STOP = "(time_ms - time_ms % 300000 + 300000)"
define("fleet_metrics_trend", f"""
SELECT {ms_text("stop")} AS time, {", ".join(f"CAST(sum({c}) // count({c}) AS BIGINT) AS {c}" for c in
  ("active_taxis_count", "in_transit_taxis_count", "trip_ended_taxis_count"))}
FROM (SELECT *, processed_at_utc_ms - processed_at_utc_ms % 300000 + 300000 AS stop FROM fleet)
GROUP BY stop""")
for name, long_ms, short_ms in (("", 300_000, 5_000), ("_day", 604_800_000, 86_400_000)):
    define(f"fleet_latency_summary{name}", f"""
SELECT stat, latency_in_seconds, CASE WHEN recent <> 0
  THEN round((latency_in_seconds - recent) / recent * 100, 2) END AS change_from_last_5s_percent
FROM (SELECT unnest(['max', 'min', 'mean']) AS stat,
    unnest([max(ms) / 1000.0::DOUBLE, min(ms) / 1000.0::DOUBLE,
      {half_up("CAST(sum(ms) AS BIGINT)", "nullif(count(ms), 0)")} / 1000.0::DOUBLE]) AS latency_in_seconds,
    unnest([max(late) / 1000.0::DOUBLE, min(late) / 1000.0::DOUBLE,
      {half_up("CAST(sum(late) AS BIGINT)", "nullif(count(late), 0)")} / 1000.0::DOUBLE]) AS recent
  FROM (SELECT processed_at_utc_ms - sent_at_utc_ms AS ms, CASE WHEN processed_at_utc_ms >= top - {short_ms}
          THEN processed_at_utc_ms - sent_at_utc_ms END AS late
        FROM processed, (SELECT max(processed_at_utc_ms) + 1 AS top FROM pings)
        WHERE processed_at_utc_ms >= top - {long_ms} AND processed_at_utc_ms < top))""")
for name, key in (("fleet_incident_trend", ""), ("taxi_incident_trend", "taxi_id, ")):
    define(name, f"""
SELECT {key}{ms_text(STOP)} AS time, count(*) FILTER (alert_type = 'GEOFENCE_VIOLATION') AS geofence_violation_count,
  count(*) FILTER (alert_type = 'SPEED_VIOLATION') AS speed_violation_count, count(*) AS total_violation_count
FROM alert_points GROUP BY {key}{STOP}""")
TREND = f"SELECT taxi_id, {ms_text('time_ms')} AS time"
define("taxi_speed_trend", f"{TREND}, speed AS speed_in_km_per_hour FROM points")
define("taxi_avg_speed_trend", f"{TREND}, avg_speed AS average_speed_in_km_per_hour FROM points")
define("taxi_latency_trend", f"""{TREND},
  (time_ms - CAST(sent_at_utc_ms AS BIGINT)) / 1000.0::DOUBLE AS event_latency_in_seconds FROM points""")
define("processed_rescan", "SELECT * EXCLUDE (ms) FROM messages")
define("latency_per_message", f"""
SELECT record_number, latency_s, {ZONE} AS zone, processed_at FROM (
  SELECT row_number() OVER (ORDER BY processed_at_utc_ms, seq) AS record_number, ms,
    ms / 1000.0::DOUBLE AS latency_s, {ms_text("processed_at_utc_ms")} AS processed_at FROM messages)
WHERE ms IS NOT NULL""")
define("latency_windows", f"SELECT * FROM {MINUTE}")
define("latency_windows_day", f"SELECT * FROM {DAY}")
SECONDS = "ms / 1000.0::DOUBLE"
MEAN = f"{half_up('CAST(sum(ms) AS BIGINT) * 1000', 'count(ms)')} / 1000000.0::DOUBLE"
define("latency_percentiles_by_load", f"""
SELECT cumulative_taxi_count AS cumulative_taxis, {MEAN} AS mean_latency_s,
  {", ".join(f"round(quantile_cont({SECONDS}, {p}), 6) AS {n}_latency_s"
             for n, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)))}
FROM messages JOIN {HOUR} ON window_start_utc_ms = processed_at_utc_ms // 3600000 * 3600000
WHERE ms IS NOT NULL AND latency_samples > 0 GROUP BY 1""")
define("throughput_vs_latency", f"""
SELECT window_start_utc_ms, round(count(*) / 3600.0::DOUBLE, 6) AS throughput_per_s, {MEAN} AS mean_latency_s,
  round(quantile_cont({SECONDS}, 0.95), 6) AS p95_latency_s, any_value(cumulative_taxi_count) AS cumulative_taxis
FROM messages JOIN {HOUR} ON window_start_utc_ms = processed_at_utc_ms // 3600000 * 3600000
WHERE latency_samples > 0 GROUP BY 1""")
EDGE = [ms_text(f"{f}(processed_at_utc_ms) // 60000 * 60000", "%Y-%m-%dT%H:%M:%S") for f in ("min", "max")]
define("run_summary", f"""
SELECT count(*) AS total_messages, count(DISTINCT taxi_id) AS total_unique_taxis, 60000::BIGINT AS window_size_ms,
  max(processed_at_utc_ms) // 60000 - min(processed_at_utc_ms) // 60000 + 1 AS total_windows,
  {EDGE[0]} || '+00:00' AS first_window_utc, {EDGE[1]} || '+00:00' AS last_window_utc FROM messages""")
define("conflict_rows", "SELECT * FROM conflicts")
define("conflict_counts_taxi", "SELECT taxi_id, count(*) AS conflict_row_count FROM conflicts GROUP BY 1")
define("conflict_counts_time", "SELECT taxi_id, timestamp, count(*) AS conflict_row_count FROM conflicts GROUP BY 1, 2")
define("conflict_summary", """
SELECT count(DISTINCT taxi_id) AS conflicted_taxis,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM conflicts GROUP BY taxi_id)) AS max_rows_per_taxi,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM conflicts GROUP BY taxi_id, timestamp)) AS max_rows_per_time
FROM conflicts""")
define("conflict_taxis_at_count", "SELECT taxi_id FROM conflicts GROUP BY 1 HAVING count(*) = 2")
define("conflict_diffs", """
SELECT taxi_id, timestamp, round(lat_diff, 9) AS lat_diff, round(lon_diff, 9) AS lon_diff FROM diffs""")
define("conflict_describe", """
SELECT field, count(v) AS count, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min,
  round(quantile_cont(v, 0.25), 6) AS q25, round(quantile_cont(v, 0.5), 6) AS q50,
  round(quantile_cont(v, 0.75), 6) AS q75, round(max(v), 6) AS max
FROM (SELECT 'lat_diff' AS field, lat_diff AS v FROM diffs UNION ALL SELECT 'lon_diff', lon_diff FROM diffs)
GROUP BY field""")
define("null_ratio", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS null_ratio FROM raw"
    for c in ("taxi_id", "timestamp", "longitude", "latitude")))
define("coord_range", """
SELECT max(longitude) AS max_longitude, min(longitude) AS min_longitude, max(latitude) AS max_latitude,
  min(latitude) AS min_latitude FROM pings""")
define("point_struct", "SELECT seq, latitude AS y, longitude AS x FROM pings")

# -- streams give the rows of their batch forms
define("stream_chain", f"""
SELECT {PING}, sent_at_utc_ms, processed_at_utc_ms, {METRICS}, geofence_alert, speed_alert FROM processed""")
define("stream_incidents", "SELECT * FROM log")
define("stream_latest", "SELECT taxi_id, seq, trip_status, speed, avg_speed, total_distance_km FROM latest")
define("stream_fleet", f"SELECT seq, taxi_id, event_s, processed_at_utc_ms, {FLEET} FROM fleet")
define("stream_window_counts", """
SELECT event_s // 300 * 300 AS window_start, event_s // 300 * 300 + 300 AS window_end, count(*) AS pings,
  CAST(sum(processed_at_utc_ms - sent_at_utc_ms) AS BIGINT) AS latency_sum_ms,
  max(processed_at_utc_ms - sent_at_utc_ms) AS latency_max_ms,
  min(processed_at_utc_ms - sent_at_utc_ms) AS latency_min_ms
FROM pings GROUP BY 1""")
ORACLE["stream_window_latest"] = ORACLE["latest_per_tumbling_5s"]
STEPS["due"] = "SELECT *, seq + CASE WHEN taxi_id % 10 = 0 THEN 2000 ELSE 0 END AS due FROM pings"
STEPS["sliced"] = "SELECT *, greatest(CAST(ceil(4.0 * due / (SELECT max(due) FROM due)) AS BIGINT), 1) AS slice FROM due"
STEPS["marks"] = """
SELECT slice, max(max(event_s)) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mark FROM sliced GROUP BY slice"""
define("late_rows", """
SELECT seq, taxi_id, event_s, event_s // 300 * 300 AS window_start
FROM sliced JOIN marks USING (slice) WHERE event_s // 300 * 300 + 300 <= mark""")
define("arrival_order", """
SELECT ping, topic, partition, ms * 2097152 + row_number() OVER (PARTITION BY ms ORDER BY topic, partition, ping) - 1 AS seq
FROM (SELECT seq AS ping, topic, partition, max(sent_at_utc_ms) OVER (PARTITION BY topic, partition ORDER BY seq) AS ms
      FROM (SELECT *, CASE WHEN taxi_id % 3 = 2 THEN 'b' ELSE 'a' END AS topic, CAST(taxi_id % 3 % 2 AS INT) AS partition FROM pings))""")
ORACLE["stream_arrival_order"] = ORACLE["arrival_order"]
ORACLE["latest_versions"] = ORACLE["stream_latest"]
ORACLE["stored_fleet_trend"] = ORACLE["fleet_metrics_trend"]
ORACLE["stored_incident_trend"] = ORACLE["fleet_incident_trend"]
ORACLE["stored_last_50"] = ORACLE["last_50_incidents"]
ORACLE["stored_points"] = f"SELECT * FROM ({ORACLE['points_taxi']}) WHERE time_ms >= 1704672000000 AND time_ms < 1705276800000"
ORACLE["topic_messages"] = ORACLE["emit_messages"]
ORACLE["benchmark_report"] = ORACLE["latency_windows_day"]
ORACLE["stream_inactive_trips"] = ORACLE["inactive_trips"]
