"""Ticks, bars and raw klines derived from the ``events`` table.

Each event is a tick; bars aggregate ticks per symbol and interval. ``symbol`` is the event type (five busy symbols)
or the user (many sparse ones, growing with the table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.functions.intervals import INTERVAL_MINUTES, MINUTE_US
from barlake.functions.triggers import DIRECTIONS
from barlake.schema import BRONZE, KLINE_FIELDS, SILVER_COLUMNS
from barlake.session import pin_utc

BY_TYPE, BY_USER = "type", "user"
_NUMBERS = [f for f in KLINE_FIELDS if f not in ("open_time", "close_time", "ignore")]


def _symbol(by: str) -> Column:
    return F.col("event_type") if by == BY_TYPE else F.concat(F.lit("u"), F.col("user_id").cast("string"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf_dir}/events.parquet")


def ticks(spark: SparkSession, sf_dir: str, by: str = BY_TYPE) -> DataFrame:
    moment = F.col("ts").cast("timestamp")
    return events(spark, sf_dir).select(
        F.lit("synthetic").alias("exchange"),
        _symbol(by).alias("symbol"),
        moment.alias("event_time"),
        (F.lit(100.0) + F.col("value") / 10).alias("price"),
        F.lit("events").alias("source"),
        moment.alias("ingested_at"),
    )


def bars(spark: SparkSession, sf_dir: str, by: str = BY_TYPE, interval: str = "1h") -> DataFrame:
    """Bars of the ticks in the silver layout; hours without a tick are missing."""
    step = INTERVAL_MINUTES[interval] * MINUTE_US
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    source = events(spark, sf_dir).select(
        _symbol(by).alias("symbol"),
        (at - F.pmod(at, F.lit(step))).alias("_open"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        (F.lit(100.0) + F.col("value") / 10).alias("price"),
    )
    taker = F.col("event_id") % 2 == 0
    order = F.struct("ts", "event_id")
    grouped = source.groupBy("symbol", "_open").agg(
        F.min_by("price", order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", order).alias("close"),
        F.count("*").alias("trade_count"),
        F.sum("price").alias("quote_volume"),
        F.count_if(taker).cast("double").alias("taker_buy_base_volume"),
        F.sum(F.when(taker, F.col("price")).otherwise(0.0)).alias("taker_buy_quote_volume"),
        F.max("ts").alias("ingested_at"),
    )
    fixed = {
        "exchange": F.lit("synthetic"),
        "interval": F.lit(interval),
        "open_time": F.timestamp_micros("_open"),
        "close_time": F.timestamp_micros(F.col("_open") + step - 1000),
        "volume": F.col("trade_count").cast("double"),
        "is_synthetic": F.lit(False),
        "load_source": F.lit("events"),
    }
    return grouped.select(*[fixed.get(c, F.col(c)).alias(c) for c in SILVER_COLUMNS])


def raw_klines(spark: SparkSession, sf_dir: str, by: str = BY_TYPE, interval: str = "1h") -> DataFrame:
    """Bars as landed: text numbers and epoch-ms times, with dirt added to some of them.

    Bars whose trade count is a multiple of seven carry an unreadable volume; those with a multiple of three also
    have an older revision with another close.
    """
    base = bars(spark, sf_dir, by, interval)
    versions = F.when(F.col("trade_count") % 3 == 0, F.array(F.lit(False), F.lit(True))).otherwise(
        F.array(F.lit(False))
    )
    rows = base.withColumn("_stale", F.explode(versions))
    close = F.when(F.col("_stale"), F.col("close") + 1).otherwise(F.col("close"))
    rows = rows.withColumns(
        {
            "close": close,
            "ingested_at": F.when(F.col("_stale"), F.col("ingested_at") - F.expr("INTERVAL 1 MINUTE"))
            .otherwise(F.col("ingested_at")),
        }
    )
    text = {c: F.col(c).cast("string") for c in _NUMBERS}
    text["volume"] = F.when(F.col("trade_count") % 7 == 0, "bad").otherwise(F.col("volume").cast("string"))
    text |= {"open_time": F.unix_millis("open_time"), "close_time": F.unix_millis("close_time"), "ignore": F.lit("0")}
    return rows.select(*[text.get(c, F.col(c)).alias(c) for c in BRONZE.fieldNames()])


def kline_pages(spark: SparkSession, sf_dir: str, by: str = BY_TYPE, interval: str = "1h") -> DataFrame:
    """Raw klines as landed JSON pages: one page per symbol and day, fetched when its newest bar was."""
    raw = raw_klines(spark, sf_dir, by, interval)
    element = F.array(*[F.col(c).cast("string") for c in KLINE_FIELDS])
    day = F.to_date(F.timestamp_millis("open_time"))
    # A day of one symbol is at most 1440 bars and their revisions.
    rows = F.sort_array(F.collect_list(F.struct("open_time", element.alias("bar"))))
    return raw.groupBy("exchange", "symbol", "interval", "load_source", day.alias("_day")).agg(
        F.to_json(rows["bar"]).alias("payload"), F.max("ingested_at").alias("ingested_at")
    ).drop("_day")


def damaged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages with every seventh cut off and every eleventh without a payload, by the day they cover."""
    pages = kline_pages(spark, sf_dir)
    day = F.datediff(F.to_date("ingested_at"), F.lit("2024-01-01"))
    payload = F.when(day % 11 == 3, F.lit(None)).when(day % 7 == 2, F.left("payload", F.length("payload") - 1)).otherwise(F.col("payload"))
    return pages.withColumn("payload", payload)


def faulty_klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw klines, some without a symbol, some half an hour off the grid, some without an open time."""
    raw = raw_klines(spark, sf_dir)
    trades = F.col("trade_count").cast("bigint")
    return raw.withColumns(
        {
            "symbol": F.when(trades % 13 != 0, F.col("symbol")),
            "open_time": F.when(trades % 17 == 0, F.col("open_time") + 1_800_000).when(trades % 7 != 0, F.col("open_time")),
        }
    )


RULES = (("above", 110.0), ("below", 100.5), ("cross_above", 106.0), ("cross_below", 103.0))


def symbols(spark: SparkSession, sf_dir: str, by: str = BY_TYPE) -> DataFrame:
    return events(spark, sf_dir).select(_symbol(by).alias("symbol")).distinct()


def rule_lines(spark: SparkSession, sf_dir: str, by: str = BY_TYPE) -> DataFrame:
    """Rule text for every symbol of the table: short and long forms, and the ways a line can be wrong."""
    name = F.col("symbol")
    good = [F.concat(name, F.lit(f"|{d}|{t}|"), name, F.lit(f"_{d}")) for d, t in RULES]
    other = [
        F.concat(name, F.lit(" | spot | cross_above | 108 | "), name, F.lit("_spot")),
        F.concat(name, F.lit("|1h|cross_above|107|"), name, F.lit("_hourly")),
        F.concat(name, F.lit("|cross_above|106")),
        F.concat(name, F.lit("|sideways|106|"), name, F.lit("_sideways")),
        F.concat(name, F.lit("|above|abc|"), name, F.lit("_text")),
    ]
    return symbols(spark, sf_dir, by).select(F.explode(F.array(*good, *other)).alias("rule"))


def ladder_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve rules per event, of all directions, at levels that only the highest prices reach."""
    steps = [F.struct(F.lit(d).alias("direction"), F.lit(offset).alias("offset")) for d in DIRECTIONS for offset in (30.0, 35.0, 40.0)]
    rows = events(spark, sf_dir).select("event_type", "event_id", "value", F.explode(F.array(*steps)).alias("step"))
    name = F.concat_ws("_", "step.direction", F.col("step.offset").cast("int").cast("string"), F.col("event_id").cast("string"))
    return rows.select(
        F.col("event_type").alias("symbol"), F.lit(None).cast("string").alias("interval"), "step.direction",
        F.round(F.lit(100.0) + F.col("value") / 10 + F.col("step.offset"), 3).alias("threshold"), name.alias("signal_name"),
    )


def strategies(spark: SparkSession, sf_dir: str, by: str = BY_TYPE, interval: str = "1h") -> DataFrame:
    """Three parameter sets per symbol: crossing, level triggers, and one that may enter and leave on one bar."""
    variants = [
        ("cross", "cross_above", 106.0, "cross_below", 103.0, 100000.0, 5.0),
        ("level", "above", 104.0, "below", 101.5, 50000.0, 10.0),
        ("toggle", "above", 102.0, "above", 104.0, 100000.0, 200.0),
    ]
    fields = (
        "strategy_id", "entry_direction", "entry_threshold", "exit_direction", "exit_threshold",
        "initial_capital", "transaction_cost_bps",
    )
    rows = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, row)]) for row in variants])
    return symbols(spark, sf_dir, by).select("symbol", F.lit(interval).alias("interval"), F.inline(rows))
