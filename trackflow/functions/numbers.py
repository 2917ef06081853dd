"""Percent changes, latency, validity and exact decimal rounding of integer ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(current: Column, previous: Column) -> Column:
    return F.round((current - previous) / previous * 100, 2)


def safe_percent_change(current: Column, previous: Column) -> Column:
    """0.0 against an empty previous value."""
    return F.when(previous == 0, F.lit(0.0)).otherwise(percent(current, previous))


def nullable_percent_change(current: Column, previous: Column) -> Column:
    """Null where there is nothing to compare with."""
    return F.when(previous != 0, percent(current, previous))


def latency_seconds(processed_ms: Column, sent_ms: Column) -> Column:
    return (processed_ms - sent_ms) / F.lit(1000.0)


def is_valid(flag: Column) -> Column:
    """A missing validity flag means valid."""
    return F.coalesce(flag, F.lit(True))


def int_div(a: Column, b) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("bigint"))


def half_up_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half away from zero, for integers, without floats."""
    whole = int_div(F.abs(numerator) * 2 + denominator, denominator * 2)
    return F.when(numerator < 0, -whole).otherwise(whole)


def three_to_two_decimals(value: Column) -> Column:
    """Round a number that already has at most three decimals to two, half away from zero."""
    thousandths = F.round(value * 1000).cast("bigint")
    return half_up_ratio(thousandths, F.lit(10).cast("bigint")) / 100.0
