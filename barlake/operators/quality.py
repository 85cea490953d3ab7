"""Completeness and integrity of bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from barlake.functions.intervals import step_us
from barlake.operators.chunks import floor_div
from barlake.schema import PRIMARY_KEY, SERIES, SILVER_COLUMNS


def daily_completeness(bars: DataFrame) -> DataFrame:
    """Bars, synthetic bars and first/last bar per symbol, interval and UTC day, newest day first."""
    return (
        bars.groupBy("symbol", "interval", F.date_trunc("day", "open_time").alias("trading_day"))
        .agg(
            F.count("*").alias("bar_count"),
            F.sum(F.when(F.col("is_synthetic"), 1).otherwise(0)).alias("synthetic_bar_count"),
            F.min("open_time").alias("first_bar"),
            F.max("open_time").alias("last_bar"),
        )
        .orderBy(F.col("trading_day").desc(), "symbol", "interval")
    )


def key_counts(bars: DataFrame) -> DataFrame:
    """row_count, distinct_pk and the first and last open_time of each series.

    64 neighbouring grid times are one word with a bit for each, so tasks combine their bars into words before the shuffle
    and what is shuffled is a row per 64 bars. Times off the grid are kept one by one.
    """
    at, step = F.unix_micros("open_time"), step_us()
    slot = floor_div(at, step)
    on_grid = F.pmod(at, step) == 0
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(slot, F.lit(64)).cast("int"))
    marked = bars.select(
        *SERIES, "open_time", floor_div(slot, F.lit(64)).alias("_word"), F.when(on_grid, bit).alias("_bit"),
        F.when(~on_grid, F.col("open_time")).alias("_off"),
    )
    words = marked.groupBy(*SERIES, "_word", "_off").agg(
        F.count("*").alias("_rows"), F.bit_or("_bit").alias("_bits"), F.min("open_time").alias("_first"), F.max("open_time").alias("_last")
    )
    times = F.when(F.col("_off").isNotNull(), 1).otherwise(F.coalesce(F.bit_count("_bits"), F.lit(0)))
    return words.groupBy(*SERIES).agg(
        F.sum("_rows").alias("row_count"), F.sum(times).alias("distinct_pk"),
        F.min("_first").alias("min_open_time"), F.max("_last").alias("max_open_time"),
    )


def window_report(bars: DataFrame, series: DataFrame | None = None, allow_empty: bool = False) -> DataFrame:
    """One row per series: row and key counts, time range, missing bars, and a pass/fail status.

    ``series`` lists the series expected in the window, so that an empty one is reported as well.
    """
    counts = key_counts(bars)
    if series is not None:
        wanted = series.select(*SERIES).distinct()
        counts = wanted.join(counts, SERIES, "left").fillna(0, ["row_count", "distinct_pk"])
    span = F.unix_millis("max_open_time") - F.unix_millis("min_open_time")
    step = F.call_function("div", step_us(), F.lit(1000))
    expected = F.call_function("div", span, step) + 1
    gaps = F.greatest(F.coalesce(expected - F.col("row_count"), F.lit(0)), F.lit(0))
    counted = counts.withColumn("gap_violations", gaps)
    reason = (
        F.when((F.col("row_count") == 0) & F.lit(not allow_empty), "empty window")
        .when(F.col("row_count") != F.col("distinct_pk"), "duplicate primary key")
        .when(F.col("gap_violations") > 0, "missing bars")
    )
    return counted.withColumn("reason", reason).withColumn(
        "status", F.when(F.col("reason").isNull(), "pass").otherwise("fail")
    )


def assert_quality(report: DataFrame) -> None:
    """Raise when a series of the report fails; names up to ten of them."""
    failed = report.where(F.col("status") == "fail")
    shown = failed.select(*SERIES, "reason", "row_count", "distinct_pk", "gap_violations").take(10)
    if shown:
        raise RuntimeError("Data quality failed: " + "; ".join(str(row.asDict()) for row in shown))


def missing_columns() -> Column:
    """Names of the required columns that are NULL in a row."""
    return F.filter(
        F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in SILVER_COLUMNS]), lambda name: name.isNotNull()
    )


def integrity_report(bars: DataFrame) -> DataFrame:
    """Per series: NULLs in each required column and rows beyond the first of a primary key."""
    counts = bars.groupBy(*SERIES).agg(
        F.count("*").alias("row_count"),
        (F.count("open_time") - F.countDistinct("open_time")).alias("duplicate_keys"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in SILVER_COLUMNS if c not in SERIES],
    )
    nulls = sum((F.col(f"null_{c}") for c in SILVER_COLUMNS if c not in SERIES), F.lit(0))
    keyless = F.greatest(*[F.col(c).isNull().cast("int") for c in SERIES])
    violated = (F.col("duplicate_keys") > 0) | (nulls > 0) | (keyless > 0)
    return counts.withColumn("status", F.when(violated, "fail").otherwise("pass"))


def rejected_bars(bars: DataFrame) -> DataFrame:
    """Rows that break NOT NULL on the required columns, with the columns at fault."""
    return bars.withColumn("missing", F.array_join(missing_columns(), ",")).where(F.col("missing") != "")


def duplicate_bars(bars: DataFrame) -> DataFrame:
    """Primary keys that occur more than once, with their number of rows."""
    return bars.groupBy(*PRIMARY_KEY).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)
