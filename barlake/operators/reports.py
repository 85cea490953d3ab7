"""Top-k reports over the serving table and the latest state of each series."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from barlake.schema import SERIES

# The columns of the report.
LATEST_COLUMNS = ["open_time", "open", "high", "low", "close", "volume", "return_1", "ma_5", "ma_20", "vol_5"]


def latest_bars(serving: DataFrame, symbol: str, interval: str, limit: int = 20) -> DataFrame:
    """The newest bars of one symbol with their features."""
    chosen = serving.where((F.col("symbol") == symbol) & (F.col("interval") == interval))
    return chosen.select(*LATEST_COLUMNS).orderBy(F.col("open_time").desc()).limit(limit)


def volatility_screen(serving: DataFrame, interval: str, limit: int = 50) -> DataFrame:
    """Bars of one interval with the highest 20-bar volatility."""
    known = serving.where((F.col("interval") == interval) & F.col("vol_20").isNotNull())
    return (
        known.select("symbol", "interval", "open_time", "close", "vol_20")
        .orderBy(F.col("vol_20").desc(), F.col("open_time").desc(), "symbol")
        .limit(limit)
    )


def recent_bars(bars: DataFrame, count: int = 5) -> DataFrame:
    """The newest ``count`` bars of every series. Expects one row per bar; ranks before the shuffle."""
    newest = Window.partitionBy(*SERIES).orderBy(F.col("open_time").desc())
    return bars.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= count).drop("_rank")


def latest_prices(ticks: DataFrame) -> DataFrame:
    """The last price of every instrument."""
    order = F.struct("event_time", "ingested_at", "price")
    return ticks.groupBy("exchange", "symbol").agg(
        F.max_by("price", order).alias("price"), F.max("event_time").alias("event_time")
    )
