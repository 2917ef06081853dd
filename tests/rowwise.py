"""The keyed chain one ping at a time, in plain Python: what the windows must agree with."""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd

from trackflow.config import ACTIVE, END, INACTIVE, Settings
from trackflow.functions.geo import EARTH_RADIUS_KM


def half_up(value: float, digits: int) -> float:
    """Decimal rounding as the batch operators do it."""
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-digits), ROUND_HALF_UP))


def haversine(lat1: float, lon1: float, lat2: float, lon2: float) -> float:
    half_lat = math.sin(math.radians(lat2 - lat1) / 2)
    half_lon = math.sin(math.radians(lon2 - lon1) / 2)
    cosines = math.cos(math.radians(lat1)) * math.cos(math.radians(lat2))
    chord = half_lat * half_lat + cosines * half_lon * half_lon
    return math.atan2(math.sqrt(chord), math.sqrt(1 - chord)) * (2 * EARTH_RADIUS_KM)


@dataclass
class Memory:
    """What the chain remembers of a taxi; each group is cleared by its own rule."""

    seen_s: int | None = None
    kept_s: int | None = None
    lat: float | None = None
    lon: float | None = None
    at_s: int | None = None
    valid_kmph: float | None = None
    speed_cents: int = 0
    speed_count: int = 0
    leg_lat: float | None = None
    leg_lon: float | None = None
    total_um: int = 0
    warned: bool = False
    alerted: bool = False
    fleet_active: int = 0
    fleet_ended: int = 0
    fleet_transit: int = 0
    fleet_metres: int = 0


def arrives(m: Memory, s: int, status: str, cfg: Settings) -> bool:
    """Whether the ping passes de-duplication and down-sampling."""
    if status == END:
        m.seen_s = m.kept_s = None
        return True
    if m.seen_s == s and status == ACTIVE:
        return False
    m.seen_s = s
    if m.kept_s is not None and s - m.kept_s < cfg.emit_interval_s:
        return False
    m.kept_s = s
    return True


def measure(m: Memory, s: int, lat: float, lon: float, status: str, cfg: Settings) -> float | None:
    """Unrounded speed against the last position, or None where it is not valid."""
    if m.at_s is None:
        kmph = 0.0
    elif s > m.at_s:
        kmph = haversine(lat, lon, m.lat, m.lon) / ((s - m.at_s) / 3600.0)
        kmph = 0.0 if kmph < cfg.stationary_kmph else kmph
        kmph = kmph if kmph <= cfg.max_valid_kmph else None
    else:
        kmph = m.valid_kmph if status == INACTIVE else None
    m.lat, m.lon, m.at_s = lat, lon, s
    m.valid_kmph = m.valid_kmph if kmph is None else kmph
    if status == END:
        m.lat = m.lon = m.at_s = m.valid_kmph = None
    return kmph


def average(m: Memory, speed: float | None, status: str) -> float:
    """Mean of the counted speeds of the trip."""
    if speed is not None and status in (ACTIVE, END):
        m.speed_cents += round(speed * 100)
        m.speed_count += 1
    mean = 0.0
    if m.speed_count:
        mean = ((2 * m.speed_cents + m.speed_count) // (2 * m.speed_count)) / 100.0
    if status == END:
        m.speed_cents = m.speed_count = 0
    return mean


def travel(m: Memory, lat: float, lon: float, status: str) -> float:
    """Kilometres of the trip so far."""
    if m.leg_lat is not None:
        m.total_um += math.floor(haversine(lat, lon, m.leg_lat, m.leg_lon) * 1e9 + 0.5)
    total, m.leg_lat, m.leg_lon = m.total_um, lat, lon
    if status == END:
        m.leg_lat, m.leg_lon, m.total_um = None, None, 0
    return (2 * total + 1_000_000) // 2_000_000 / 1000.0


def raise_alerts(m: Memory, km: float, speed: float, status: str, cfg: Settings) -> tuple[bool, bool]:
    """(geofence alert, speed alert) of a valid ping."""
    ring = cfg.warning_km < km <= cfg.range_km
    fast = speed > cfg.speed_limit_kmph
    raised = (ring and not m.warned, fast and not m.alerted)
    m.warned = status != END and (ring or (m.warned and km > cfg.warning_km))
    m.alerted = status != END and fast
    return raised


def fleet_changes(m: Memory, speed: float, km: float, status: str, cfg: Settings) -> list[int]:
    """Differences that the ping makes to the fleet totals."""
    before = (m.fleet_active, m.fleet_ended, m.fleet_transit, m.fleet_metres)
    if status in (ACTIVE, END):
        m.fleet_active, m.fleet_ended = int(status == ACTIVE), int(status == END)
        m.fleet_transit = int(status == ACTIVE and speed > cfg.in_transit_kmph)
    m.fleet_metres = round(km * 1000)
    after = (m.fleet_active, m.fleet_ended, m.fleet_transit, m.fleet_metres)
    return [a - b for a, b in zip(after, before)]


def advance(m: Memory, ping, cfg: Settings) -> list | None:
    """One ping through the whole chain; the processed columns, or None if it does not come out."""
    s, lat, lon, status = ping.event_s, ping.latitude, ping.longitude, ping.trip_status
    if pd.isna(s) or not arrives(m, int(s), status, cfg) or pd.isna(lat) or pd.isna(lon):
        return None
    kmph = measure(m, int(s), lat, lon, status, cfg)
    speed = None if kmph is None else half_up(kmph, 2)
    mean = average(m, speed, status)
    if speed is None:
        return None
    total = travel(m, lat, lon, status)
    km = haversine(lat, lon, cfg.centre_lat, cfg.centre_lon)
    alerts = raise_alerts(m, km, speed, status, cfg)
    changes = fleet_changes(m, speed, total, status, cfg)
    return [
        speed, True, mean, total, half_up(km, 2), km <= cfg.range_km, *alerts, *changes
    ]
