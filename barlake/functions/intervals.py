"""Interval codes: bar length and periods per year as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MINUTE_US = 60_000_000
DAY_US = 1440 * MINUTE_US

# The supported interval codes and their length in minutes.
INTERVAL_MINUTES = {
    "1m": 1, "3m": 3, "5m": 5, "15m": 15, "30m": 30, "1h": 60,
    "2h": 120, "4h": 240, "6h": 360, "8h": 480, "12h": 720, "1d": 1440,
}


def by_interval(values: dict[str, int], interval: str = "interval") -> Column:
    """The value of each row's interval code; an unsupported code fails the job."""
    branches = " ".join(f"WHEN '{code}' THEN {value}L" for code, value in values.items())
    failure = f"CAST(raise_error(concat('Unsupported interval: ', coalesce(`{interval}`, 'NULL'))) AS BIGINT)"
    return F.expr(f"CASE `{interval}` {branches} ELSE {failure} END")


def step_us(interval: str = "interval") -> Column:
    """Bar length in microseconds."""
    return by_interval({code: minutes * MINUTE_US for code, minutes in INTERVAL_MINUTES.items()}, interval)


def periods_per_year(interval: str = "interval") -> Column:
    """Bars in a 365-day year."""
    return F.lit(float(365 * DAY_US)) / step_us(interval)
