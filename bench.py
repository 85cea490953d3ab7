"""Headline queries over the tables at ``$BENCH_SF_DIR``; prints one JSON line.

Bars are built per user at five minutes, which gap filling turns into a dense grid for every user (12.6 million bars at
sf0.1). Each query starts from the stored layer before it, as in production, and consumes its whole result.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barlake.operators.cleaning import clean_bars  # noqa: E402
from barlake.operators.features import feature_frame  # noqa: E402
from barlake.operators.quality import daily_completeness, window_report  # noqa: E402
from barlake.operators.reports import recent_bars, volatility_screen  # noqa: E402
from barlake.operators.rules import rule_table, threshold_alerts  # noqa: E402
from barlake.operators.strategy import crossing_strategies, evaluate_strategies  # noqa: E402
from barlake.plans.loads import run_backfill, run_incremental  # noqa: E402
from barlake.plans.steps import Lake  # noqa: E402
from barlake.session import scratch_dir, stored  # noqa: E402
from barlake.sources.layers import DAY_LAYOUT  # noqa: E402
from registry import tables as t  # noqa: E402

INTERVAL = "5m"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    shuffled: dict[str, float] = {}

    def written() -> float:
        """MB of shuffle files that the local executor has written so far."""
        return spark.sparkContext._jsc.sc().statusStore().executorList(False).head().totalShuffleWrite() / 1e6

    def measured(name, action):
        started, before = time.time(), written()
        action()
        seconds[name], shuffled[name] = round(time.time() - started, 3), round(written() - before, 1)

    def timed(name, frame):
        measured(name, lambda: frame().write.format("noop").mode("overwrite").save())

    bronze = stored(t.raw_klines(spark, sf_dir, t.BY_USER, INTERVAL), "bench")
    timed("clean_bars", lambda: clean_bars(bronze))
    silver = stored(clean_bars(bronze), "bench")
    timed("feature_frame", lambda: feature_frame(silver))
    rules = stored(rule_table(t.rule_lines(spark, sf_dir, t.BY_USER)), "bench")
    timed("threshold_alerts", lambda: threshold_alerts(t.ticks(spark, sf_dir, t.BY_USER), rules))
    strategies = stored(crossing_strategies(bronze, 106.0, 103.0), "bench")
    timed("strategy_metrics", lambda: evaluate_strategies(silver, strategies))
    timed("daily_completeness", lambda: daily_completeness(silver))
    timed("window_report", lambda: window_report(silver))
    timed("recent_bars", lambda: recent_bars(silver))
    gold = stored(feature_frame(t.bars(spark, sf_dir, t.BY_USER, INTERVAL)), "bench")
    timed("volatility_screen", lambda: volatility_screen(gold, INTERVAL))
    # Loads take hourly bars of all users: a backfill of three weeks, then what follows its marks.
    landed = stored(t.raw_klines(spark, sf_dir, t.BY_USER), "bench")
    lake = Lake(scratch_dir(spark, "bench"), DAY_LAYOUT)
    start, cut, end = (f"2024-{day}T00:00:00+00:00" for day in ("01-01", "01-22", "02-01"))
    measured("backfill", lambda: run_backfill(spark, lake, landed, start, cut).collect())
    measured("incremental", lambda: run_incremental(spark, lake, landed, end, lookback_minutes=14_400).collect())
    bars = silver.count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "shuffle_mb": shuffled,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "silver_bars": bars,
            }
        )
    )


if __name__ == "__main__":
    main()
