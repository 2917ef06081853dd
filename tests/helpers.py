"""Small inputs for the keyed operators."""

from __future__ import annotations

import random

from trackflow.schema import DOUBLE, INT, LONG, TEXT, row

PING = row(
    seq=LONG, taxi_id=INT, event_s=LONG, latitude=DOUBLE, longitude=DOUBLE, trip_status=TEXT,
    sent_at_utc_ms=LONG, processed_at_utc_ms=LONG,
)
CENTRE = (39.9163, 116.3972)
# One degree of latitude is about 111.19 km on the sphere used.
KM = 1 / 111.19492664455873


def north(km: float) -> tuple[float, float]:
    return CENTRE[0] + km * KM, CENTRE[1]


def ping_rows(steps, taxi: int = 1):
    """(second, km north of the centre or None, status) -> ping rows."""
    out = []
    for i, (s, km, status) in enumerate(steps):
        lat, lon = (None, None) if km is None else north(km)
        out.append((i, taxi, s, lat, lon, status, i * 1000, i * 1000 + 500))
    return out


def make(spark, steps, taxi: int = 1):
    return spark.createDataFrame(ping_rows(steps, taxi), PING)


def random_pings(n: int, seed: int, hot_share: float = 0.5):
    """Arrival-ordered pings with a hot taxi, late rows, repeats, gaps, jumps and null positions."""
    rnd = random.Random(seed)
    clock: dict[int, int] = {}
    rows = []
    for seq in range(n):
        taxi = 1 if rnd.random() < hot_share else rnd.randint(2, 6)
        step = rnd.choice([0, 0, 1, 1, 2, 3, 4, 5, 7, 60, 900, -2])
        clock[taxi] = clock.get(taxi, 1_201_910_400) + step
        status = rnd.choices(["active", "end", "inactive", "paused"], [80, 6, 10, 4])[0]
        lat, lon = north(rnd.uniform(0, 17))
        if rnd.random() < 0.05:
            lat = None
        second = None if rnd.random() < 0.02 else clock[taxi]
        rows.append((seq * 3, taxi, second, lat, lon, status, seq * 1000, seq * 1000 + 700))
    return rows


def as_set(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
