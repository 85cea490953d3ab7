"""One query per operator, each over the whole of the tables it reads."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.functions.intervals import INTERVAL_MINUTES
from barlake.functions.scalars import iso_text, to_number
from barlake.operators.cleaning import clean_bars, fill_missing_bars, latest_revision, normalize_bars
from barlake.operators.features import add_moving_averages, add_returns, add_volatility, feature_frame
from barlake.operators.quality import (
    daily_completeness,
    duplicate_bars,
    integrity_report,
    rejected_bars,
    window_report,
)
from barlake.operators.reports import latest_bars, latest_prices, recent_bars, volatility_screen
from barlake.operators.rules import bars_as_ticks, rejected_rules, rule_table, threshold_alerts
from barlake.operators.strategy import crossing_strategies, evaluate_strategies, strategy_bars
from barlake.plans.loads import due_bars, run_backfill, run_incremental, run_realtime
from barlake.plans.steps import (
    Lake,
    Scope,
    extract_step,
    gold_step,
    quality_step,
    serving_step,
    silver_step,
)
from barlake.schema import FEATURE_COLUMNS, KLINE_FIELDS, PRIMARY_KEY, SERIES, SILVER_COLUMNS
from barlake.session import scratch_dir, stored
from barlake.sources.klines import extract_recent, extract_window, raw_bars_from_payloads, rejected_pages
from barlake.sources.layers import (
    DAY_LAYOUT,
    merge_layer,
    read_layer,
    read_window,
    serving_rows,
    upsert_rows,
    upsert_serving,
    write_layer,
    write_strategy_csv,
)
from barlake.sources.marks import high_water_marks, read_marks, with_key, write_marks
from barlake.streaming.alerts import cycle_counts, read_alerts, read_ticks, run_once, start_alerts, tick_stream
from registry import tables as t

Query = Callable[[SparkSession, str], DataFrame]

WINDOW_START, WINDOW_END = "2024-01-08T00:00:00+00:00", "2024-01-20T23:00:00+00:00"
AS_OF = "2024-01-25T12:00:00+00:00"
_DIGITS = {"equity_curve": 2, "quote_volume": 4, "taker_buy_quote_volume": 4}


def _rounded(value: Column, digits: int) -> Column:
    """``F.round``, which goes through decimal text, only for doubles that are not the nearest to so many digits already."""
    scale = 10.0**digits
    exact = (value != 0) & (F.rint(value * scale) / scale == value)
    return F.when(exact, value).otherwise(F.round(value, digits))


def shown(frame: DataFrame) -> DataFrame:
    """Comparable output: doubles rounded, UTC times without zone."""
    columns = []
    for name, kind in frame.dtypes:
        column = F.col(name)
        if kind == "double":
            column = _rounded(column, _DIGITS.get(name, 6))
        elif kind == "timestamp":
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(name))
    return frame.select(*columns)


_REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(function(spark, sf_dir))

    _REGISTRY[function.__name__] = run
    return function


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _bronze(spark: SparkSession, sf_dir: str, by: str = t.BY_TYPE) -> DataFrame:
    """Raw klines as a stored table, which is how cleaning meets them."""
    return stored(t.raw_klines(spark, sf_dir, by), "bronze")


def _silver(spark: SparkSession, sf_dir: str, by: str = t.BY_TYPE) -> DataFrame:
    """Clean bars as a stored table, the input of features, reports and strategies."""
    return stored(clean_bars(_bronze(spark, sf_dir, by)), "silver")


def _bars(spark: SparkSession, sf_dir: str, by: str = t.BY_TYPE) -> DataFrame:
    return stored(t.bars(spark, sf_dir, by), "bars")


def _gold(spark: SparkSession, sf_dir: str, by: str = t.BY_TYPE) -> DataFrame:
    return feature_frame(_silver(spark, sf_dir, by))


# Landed payloads and bars.


@query
def kline_payload_parse(spark, sf_dir):
    raw = raw_bars_from_payloads(t.kline_pages(spark, sf_dir))
    numbers = [f for f in KLINE_FIELDS if f not in ("open_time", "close_time", "ignore", "volume")]
    return raw.select(
        *SERIES, "open_time", "close_time", *[to_number(c).alias(c) for c in numbers],
        "volume", "ignore", "load_source", "ingested_at",
    )


@query
def pages_rejected(spark, sf_dir):
    bad = rejected_pages(t.damaged_pages(spark, sf_dir))
    return bad.select("exchange", "symbol", "interval", "ingested_at", "reject_reason")


@query
def pages_partly_read(spark, sf_dir):
    raw = raw_bars_from_payloads(t.damaged_pages(spark, sf_dir))
    return raw.groupBy(*SERIES).agg(F.count("*").alias("bars"), F.min("open_time").alias("first"), F.max("open_time").alias("last"))


@query
def extract_window_bars(spark, sf_dir):
    raw = extract_window(t.raw_klines(spark, sf_dir), WINDOW_START, WINDOW_END)
    return raw.select(*SERIES, "open_time", to_number("close").alias("close"), "ingested_at")


@query
def recent_bars_of_series(spark, sf_dir):
    return recent_bars(t.bars(spark, sf_dir, t.BY_USER), 5)


@query
def latest_price(spark, sf_dir):
    return latest_prices(t.ticks(spark, sf_dir, t.BY_USER))


@query
def normalize(spark, sf_dir):
    return normalize_bars(t.raw_klines(spark, sf_dir))


@query
def dedup_latest(spark, sf_dir):
    return latest_revision(normalize_bars(t.raw_klines(spark, sf_dir)))


@query
def fill_gaps(spark, sf_dir):
    return fill_missing_bars(_bars(spark, sf_dir))


@query
def clean(spark, sf_dir):
    return clean_bars(_bronze(spark, sf_dir))


@query
def clean_users(spark, sf_dir):
    return clean_bars(_bronze(spark, sf_dir, t.BY_USER))


@query
def clean_small_chunks(spark, sf_dir):
    return clean_bars(_bronze(spark, sf_dir, t.BY_USER), chunk_bars=24)


@query
def clean_without_fill(spark, sf_dir):
    return clean_bars(t.raw_klines(spark, sf_dir), fill=False)


# Features.


@query
def simple_returns(spark, sf_dir):
    columns = ["return_1", "return_5", "return_20"]
    return add_returns(_bars(spark, sf_dir, t.BY_USER)).select(*PRIMARY_KEY, *columns)


@query
def log_returns(spark, sf_dir):
    return add_returns(_bars(spark, sf_dir, t.BY_USER)).select(*PRIMARY_KEY, "log_return_1")


@query
def moving_averages(spark, sf_dir):
    return add_moving_averages(_bars(spark, sf_dir, t.BY_USER)).select(*PRIMARY_KEY, "ma_5", "ma_20", "ma_50")


@query
def rolling_volatility(spark, sf_dir):
    return add_volatility(_bars(spark, sf_dir, t.BY_USER)).select(*PRIMARY_KEY, "vol_5", "vol_20")


@query
def features(spark, sf_dir):
    return _gold(spark, sf_dir)


@query
def features_users(spark, sf_dir):
    return _gold(spark, sf_dir, t.BY_USER)


@query
def features_small_chunks(spark, sf_dir):
    return feature_frame(_bars(spark, sf_dir, t.BY_USER), chunk_bars=24).select(*PRIMARY_KEY, *FEATURE_COLUMNS)


@query
def features_five_minutes(spark, sf_dir):
    return feature_frame(fill_missing_bars(stored(t.bars(spark, sf_dir, interval="5m"), "bars")))


@query
def features_daily(spark, sf_dir):
    return feature_frame(fill_missing_bars(stored(t.bars(spark, sf_dir, t.BY_USER, "1d"), "bars")))


# Reports.


@query
def latest_bars_top20(spark, sf_dir):
    return latest_bars(_gold(spark, sf_dir), "click", "1h")


@query
def completeness_by_day(spark, sf_dir):
    return daily_completeness(_silver(spark, sf_dir))


@query
def completeness_by_day_users(spark, sf_dir):
    return daily_completeness(_silver(spark, sf_dir, t.BY_USER))


@query
def volatility_top50(spark, sf_dir):
    return volatility_screen(_gold(spark, sf_dir), "1h")


@query
def quality_report(spark, sf_dir):
    return window_report(t.bars(spark, sf_dir, t.BY_USER))


@query
def quality_report_intervals(spark, sf_dir):
    every = [t.bars(spark, sf_dir, interval=code) for code in INTERVAL_MINUTES]
    return window_report(reduce(DataFrame.unionByName, every))


@query
def quality_report_filled(spark, sf_dir):
    return window_report(_silver(spark, sf_dir, t.BY_USER))


@query
def quality_report_duplicates(spark, sf_dir):
    return window_report(normalize_bars(t.raw_klines(spark, sf_dir, t.BY_USER)))


@query
def integrity(spark, sf_dir):
    return integrity_report(normalize_bars(t.raw_klines(spark, sf_dir, t.BY_USER)))


@query
def integrity_rejects(spark, sf_dir):
    return rejected_bars(_silver(spark, sf_dir)).select(*PRIMARY_KEY, "close", "missing")


@query
def integrity_duplicates(spark, sf_dir):
    return duplicate_bars(normalize_bars(t.raw_klines(spark, sf_dir)))


# Rules and alerts.


@query
def rules_valid(spark, sf_dir):
    return rule_table(t.rule_lines(spark, sf_dir, t.BY_USER))


@query
def rules_rejected(spark, sf_dir):
    return rejected_rules(t.rule_lines(spark, sf_dir, t.BY_USER))


@query
def alerts(spark, sf_dir):
    events = threshold_alerts(t.ticks(spark, sf_dir), rule_table(t.rule_lines(spark, sf_dir)))
    return events.drop("metadata")


@query
def alerts_users(spark, sf_dir):
    rules = rule_table(t.rule_lines(spark, sf_dir, t.BY_USER))
    return threshold_alerts(t.ticks(spark, sf_dir, t.BY_USER), rules).drop("metadata")


@query
def alerts_many_rules(spark, sf_dir):
    return threshold_alerts(t.ticks(spark, sf_dir), t.ladder_rules(spark, sf_dir)).drop("metadata")


@query
def alerts_on_bars(spark, sf_dir):
    rules = rule_table(t.rule_lines(spark, sf_dir))
    closes = bars_as_ticks(t.bars(spark, sf_dir))
    return threshold_alerts(closes, rules, interval="1h", chunk_seconds=86400).drop("metadata")


@query
def signal_event_records(spark, sf_dir):
    events = threshold_alerts(t.ticks(spark, sf_dir), rule_table(t.rule_lines(spark, sf_dir)))
    return events.select(
        "signal_name", "symbol", iso_text(F.col("event_time")).alias("event_time"), "observed_value",
        F.col("metadata")["event_type"].alias("event_type"),
    )


# Strategies.


def _results(spark: SparkSession, sf_dir: str, by: str = t.BY_TYPE) -> DataFrame:
    return strategy_bars(_silver(spark, sf_dir, by), t.strategies(spark, sf_dir, by))


_BAR = [*PRIMARY_KEY, "strategy_id"]


@query
def positions(spark, sf_dir):
    return _results(spark, sf_dir).select(*_BAR, "target_position", "position")


@query
def strategy_returns(spark, sf_dir):
    return _results(spark, sf_dir).select(*_BAR, "asset_return", "turnover", "transaction_cost", "strategy_return")


@query
def equity_curve(spark, sf_dir):
    return _results(spark, sf_dir).select(*_BAR, "equity_curve")


@query
def drawdown(spark, sf_dir):
    return _results(spark, sf_dir).select(*_BAR, "drawdown")


@query
def performance(spark, sf_dir):
    return evaluate_strategies(_silver(spark, sf_dir), t.strategies(spark, sf_dir))


@query
def performance_users(spark, sf_dir):
    return evaluate_strategies(
        _silver(spark, sf_dir, t.BY_USER), t.strategies(spark, sf_dir, t.BY_USER)
    )


@query
def performance_small_chunks(spark, sf_dir):
    return evaluate_strategies(_silver(spark, sf_dir), t.strategies(spark, sf_dir), chunk_bars=24)


@query
def performance_crossing(spark, sf_dir):
    silver = _silver(spark, sf_dir)
    return evaluate_strategies(silver, crossing_strategies(t.bars(spark, sf_dir), 106.0, 103.0))


@query
def strategy_csv(spark, sf_dir):
    path = scratch_dir(spark, "csv") + "/result"
    results = _results(spark, sf_dir).select(*_BAR, "target_position", "strategy_return", "equity_curve")
    write_strategy_csv(results, path)
    return spark.read.schema(results.schema).option("header", True).csv(path)


# Layers, serving table, marks.


@query
def layer_roundtrip(spark, sf_dir):
    root = scratch_dir(spark, "layers")
    write_layer(t.bars(spark, sf_dir, t.BY_TYPE), root, "silver")
    return read_layer(spark, root, "silver").withColumn("date", F.col("date").cast("string"))


@query
def layer_window_scan(spark, sf_dir):
    root = scratch_dir(spark, "layers")
    write_layer(t.raw_klines(spark, sf_dir), root, "bronze")
    rows = read_window(spark, root, "bronze", WINDOW_START, WINDOW_END, symbol="click", interval="1h")
    return normalize_bars(rows)


@query
def layer_day_layout(spark, sf_dir):
    root = scratch_dir(spark, "layers")
    merge_layer(spark, t.bars(spark, sf_dir, t.BY_USER), root, "silver", DAY_LAYOUT)
    return read_window(spark, root, "silver", WINDOW_START, WINDOW_END, interval="1h").select(*SILVER_COLUMNS)


def _correction(bars: DataFrame) -> DataFrame:
    """A later delivery: bars of the window's second half with another close, one minute newer."""
    return bars.where(F.col("open_time") >= "2024-01-15").withColumns(
        {"close": F.col("close") + 2, "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 MINUTE")}
    )


@query
def serving_merge(spark, sf_dir):
    bars = _bars(spark, sf_dir)
    old = feature_frame(bars.where(F.col("open_time") < "2024-01-20"))
    return upsert_rows(serving_rows(old), feature_frame(_correction(bars))).drop("updated_at")


@query
def serving_upsert(spark, sf_dir):
    root = scratch_dir(spark, "serving")
    bars = _bars(spark, sf_dir)
    upsert_serving(spark, feature_frame(bars.where(F.col("open_time") < "2024-01-20")), root)
    correction = feature_frame(_correction(bars))
    for _ in range(2):
        upsert_serving(spark, correction, root)
    return read_layer(spark, root, "serving").drop("updated_at", "date")


@query
def high_water_mark(spark, sf_dir):
    path = scratch_dir(spark, "marks") + "/marks"
    silver = _silver(spark, sf_dir, t.BY_USER)
    write_marks(high_water_marks(silver, "historical_backfill"), path)
    return with_key(read_marks(spark, path)).select(
        "mark_key", *SERIES, "last_success_open_time", "last_row_count"
    )


# Loads.


def _summary(frame: DataFrame) -> DataFrame:
    return frame.select("job_name", *SERIES, "rows_extracted", "rows_cleaned", "rows_loaded", "status")


@query
def load_summary(spark, sf_dir):
    lake = Lake(scratch_dir(spark, "lake"))
    return _summary(run_backfill(spark, lake, _bronze(spark, sf_dir), WINDOW_START, WINDOW_END))


@query
def window_load(spark, sf_dir):
    lake = Lake(scratch_dir(spark, "lake"))
    run_backfill(spark, lake, _bronze(spark, sf_dir), WINDOW_START, WINDOW_END)
    return read_layer(spark, lake.root, "serving").drop("updated_at", "date")


@query
def staged_load(spark, sf_dir):
    lake = Lake(scratch_dir(spark, "lake"))
    scope = Scope.window(WINDOW_START, WINDOW_END)
    extract_step(spark, lake, t.raw_klines(spark, sf_dir), scope)
    silver_step(spark, lake, scope)
    gold_step(spark, lake, scope)
    serving_step(spark, lake, scope)
    return read_layer(spark, lake.root, "serving").drop("updated_at", "date")


@query
def staged_quality(spark, sf_dir):
    lake = Lake(scratch_dir(spark, "lake"))
    scope = Scope.window(WINDOW_START, WINDOW_END)
    extract_step(spark, lake, t.raw_klines(spark, sf_dir), scope)
    silver_step(spark, lake, scope)
    gold_step(spark, lake, scope)
    serving_step(spark, lake, scope)
    return quality_step(spark, lake, scope)


@query
def incremental_due(spark, sf_dir):
    raw = t.raw_klines(spark, sf_dir)
    loaded = normalize_bars(raw).where((F.col("open_time") < "2024-01-22") & (F.col("symbol") != "view"))
    due = due_bars(raw, high_water_marks(loaded, "incremental_batch"), AS_OF)
    return normalize_bars(due)


@query
def load_summary_rejects(spark, sf_dir):
    lake = Lake(scratch_dir(spark, "lake"))
    raw = stored(t.faulty_klines(spark, sf_dir), "faulty")
    summary = run_backfill(spark, lake, raw, "2024-01-01T00:00:00+00:00", "2024-02-01T00:00:00+00:00")
    return summary.select(*SERIES, "rows_extracted", "rows_rejected", "status")


@query
def incremental_batch(spark, sf_dir):
    lake = Lake(scratch_dir(spark, "lake"))
    raw = _bronze(spark, sf_dir)
    run_incremental(spark, lake, raw, as_of="2024-01-10T00:30:00+00:00", lookback_minutes=20_160)
    run_incremental(spark, lake, raw, as_of="2024-02-01T00:30:00+00:00")
    return read_layer(spark, lake.root, "serving").drop("updated_at", "date")


def _cut_loads(spark: SparkSession, sf_dir: str, fill: bool) -> DataFrame:
    """Sparse series in three loads, the middle one last: gold and the stored silver it must equal the features of."""
    lake = Lake(scratch_dir(spark, "lake"), DAY_LAYOUT, fill=fill)
    raw = _bronze(spark, sf_dir, t.BY_USER)
    for start, end in (("01-01", "01-12"), ("01-20", "02-01"), ("01-12", "01-20")):
        run_backfill(spark, lake, raw, f"2024-{start}T00:00:00+00:00", f"2024-{end}T00:00:00+00:00")
    return read_layer(spark, lake.root, "serving").drop("updated_at", "date")


@query
def incremental_gap_features(spark, sf_dir):
    return _cut_loads(spark, sf_dir, fill=False)


@query
def backfill_gap_features(spark, sf_dir):
    return _cut_loads(spark, sf_dir, fill=True)


@query
def recent_raw_bars(spark, sf_dir):
    return normalize_bars(extract_recent(t.raw_klines(spark, sf_dir, t.BY_USER), 5))


@query
def realtime_refresh(spark, sf_dir):
    lake = Lake(scratch_dir(spark, "lake"))
    raw = _bronze(spark, sf_dir)
    run_backfill(spark, lake, raw, "2024-01-01T00:00:00+00:00", "2024-02-01T00:00:00+00:00")
    late = F.col("open_time") >= F.unix_millis(F.lit("2024-01-29").cast("timestamp"))
    changed = raw.where(late).withColumns(
        {"close": (F.col("close").cast("double") + 2).cast("string"), "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 HOUR")}
    )
    run_realtime(spark, lake, stored(raw.unionByName(changed), "changed"), 5)
    return read_layer(spark, lake.root, "serving").drop("updated_at", "date")


# Streams. Ticks arrive in three deliveries; each run continues from the state the one before left.


def _stream(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "stream")
    all_ticks = t.ticks(spark, sf_dir)
    # The rules are stored first: a stream must not depend on a query that each batch would run again.
    rule_table(t.rule_lines(spark, sf_dir)).write.parquet(f"{root}/rules")
    rules = spark.read.parquet(f"{root}/rules")
    edges = [None, "2024-01-11", "2024-01-21", None]
    for low, high in zip(edges, edges[1:]):
        part = all_ticks
        if low is not None:
            part = part.where(F.col("event_time") >= low)
        if high is not None:
            part = part.where(F.col("event_time") < high)
        part.write.mode("append").parquet(f"{root}/landing")
        run_once(spark, f"{root}/landing", rules, f"{root}/ticks", f"{root}/alerts", f"{root}/checkpoint")
    return root


@query
def stream_alerts(spark, sf_dir):
    return read_alerts(spark, _stream(spark, sf_dir) + "/alerts").drop("metadata", "batch_id")


def _shuffled(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Landed ticks in eight files of any order, and the stored rules."""
    root = scratch_dir(spark, "stream")
    rule_table(t.rule_lines(spark, sf_dir)).write.parquet(f"{root}/rules")
    dealt = t.ticks(spark, sf_dir).repartition(8, F.xxhash64("event_time", "symbol"))
    dealt.write.parquet(f"{root}/landing")
    return root, spark.read.parquet(f"{root}/rules")


@query
def stream_alerts_unordered(spark, sf_dir):
    root, rules = _shuffled(spark, sf_dir)
    run_once(spark, f"{root}/landing", rules, f"{root}/ticks", f"{root}/alerts", f"{root}/checkpoint", files_per_batch=1)
    return read_alerts(spark, f"{root}/alerts").drop("metadata", "batch_id")


@query
def stream_alerts_continuous(spark, sf_dir):
    root, rules = _shuffled(spark, sf_dir)
    stream = start_alerts(
        tick_stream(spark, f"{root}/landing", 2), rules, f"{root}/alerts", f"{root}/checkpoint", continuous=True, poll_seconds=1
    )
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
        stream.awaitTermination(60)
    return read_alerts(spark, f"{root}/alerts").drop("metadata", "batch_id")


@query
def stream_ticks(spark, sf_dir):
    return read_ticks(spark, _stream(spark, sf_dir) + "/ticks")


@query
def stream_cycles(spark, sf_dir):
    return cycle_counts(spark, _stream(spark, sf_dir) + "/checkpoint/alerts")
