"""Small column helpers: coercion, time, keys and event text."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

# Fixed pattern: text accepted as a number. Spark's cast alone would also take '1d' or '2f'.
NUMBER_PATTERN = r"(?i)^[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)$"


def null_if_nan(value: Column) -> Column:
    """NaN sorts above every number in Spark, so it must never stay in a frame."""
    return F.when(~F.isnan(value), value)


def to_number(column: str) -> Column:
    """Double from number or text; anything unreadable becomes NULL."""
    text = f"trim(CAST({column} AS STRING))"
    return F.expr(f"CASE WHEN {text} RLIKE r'{NUMBER_PATTERN}' THEN try_cast({text} AS DOUBLE) END")


def to_count(column: str) -> Column:
    """Whole number; missing or unreadable becomes 0, fractions are cut off."""
    return F.coalesce(to_number(column).try_cast("bigint"), F.lit(0).cast("bigint"))


def millis_to_time(value: Column) -> Column:
    return F.timestamp_millis(value.try_cast("bigint"))


def to_utc(value: Column) -> Column:
    """ISO-8601 text or any timestamp to a UTC instant (zone-less input is taken as UTC)."""
    return value.try_cast("timestamp")


def utc_literal(value: datetime | str) -> Column:
    """A Python datetime or ISO-8601 text as a timestamp literal; naive values are UTC."""
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return F.lit(moment.astimezone(timezone.utc).isoformat()).cast("timestamp")


def iso_text(moment: Column) -> Column:
    """UTC ISO-8601 text with microseconds."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def mark_key(job_name: Column, exchange: Column, symbol: Column, interval: Column) -> Column:
    """Composite text key ``job:exchange:symbol:interval``."""
    return F.concat_ws(":", job_name, exchange, symbol, interval)


def ratio_change(now: Column, before: Column) -> Column:
    """``now / before - 1``; NULL when the base is missing or zero."""
    return F.try_divide(now, before) - F.lit(1.0)
