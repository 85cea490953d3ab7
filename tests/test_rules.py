from __future__ import annotations

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from barlake.functions.triggers import DIRECTIONS, triggered
from barlake.operators import chunks, rules as rules_module
from barlake.operators.rules import event_lines, price_changes, rejected_rules, rule_table, threshold_alerts
from barlake.schema import RULE, TICK
from helpers import minute


def ticks(spark, prices, symbol="AAA", first=0.0, step=1.0):
    rows = [("x", symbol, minute(first + i * step), p, "poll", minute(first + i * step)) for i, p in enumerate(prices)]
    return spark.createDataFrame(rows, TICK)


def rules(spark, *rows):
    return spark.createDataFrame(list(rows), RULE)


def test_rule_text(spark):
    lines = spark.createDataFrame(
        [("A|cross_above|100|up",), (" A | 1h | below | 5e1 | low ",), ("A|above|1",), ("A|sideways|1|n",), ("A|above|abc|n",)],
        "rule string",
    )
    good = {tuple(r) for r in rule_table(lines).collect()}
    assert good == {("A", None, "cross_above", 100.0, "up"), ("A", "1h", "below", 50.0, "low")}
    assert rejected_rules(lines).count() == 3
    with pytest.raises(Exception, match="Invalid threshold rule"):
        rule_table(lines, strict=True).collect()


@pytest.mark.parametrize(
    "direction, fired, level",
    [("above", [101], [101, 105, 100]), ("below", [99, 100], [99, 100, 98]), ("cross_above", [101], [101]),
     ("cross_below", [100], [100])],
)
def test_truth_table(spark, direction, fired, level):
    prices = [99.0, 101.0, 105.0, 100.0, 98.0]
    seen = price_changes(ticks(spark, prices)).withColumn("direction", F.lit(direction))
    args = (F.col("direction"), F.col("previous_price"), F.col("price"), F.lit(100.0))
    edge = seen.where(triggered(*args)).orderBy("event_time").collect()
    assert [r.price for r in edge] == fired
    held = seen.where(triggered(*args, mode="level")).orderBy("event_time").collect()
    assert [r.price for r in held] == level


def test_rule_interval_must_match_the_stream_label(spark):
    table = rules(
        spark, ("AAA", None, "above", 1.0, "any"), ("AAA", "1m", "above", 1.0, "bars"), ("AAA", "spot", "above", 1.0, "spot"),
        ("BBB", None, "above", 1.0, "other"),
    )
    events = threshold_alerts(ticks(spark, [2.0]), table).collect()
    assert {e.signal_name for e in events} == {"any", "spot"}
    assert all(e.interval == "spot" and e.metadata == {"event_type": "threshold_alert"} for e in events)
    line = json.loads(event_lines(threshold_alerts(ticks(spark, [2.0]), table)).first()[0])
    assert line["event_time"] == "2024-05-01T00:00:00.000000+00:00" and line["observed_value"] == 2.0


def test_null_interval_is_written(spark):
    table = rules(spark, ("AAA", None, "above", 1.0, "any"))
    events = threshold_alerts(ticks(spark, [2.0]), table).withColumn("interval", F.lit(None).cast("string"))
    assert json.loads(event_lines(events).first()[0])["interval"] is None


def test_small_chunks_and_prior_state(spark):
    draw = random.Random(1)
    prices = [draw.uniform(90, 110) for _ in range(300)]
    whole = ticks(spark, prices)
    table = rules(spark, *[("AAA", None, d, 100.0, d) for d in ("above", "below", "cross_above", "cross_below")])
    everything = threshold_alerts(whole, table).count()
    assert threshold_alerts(whole, table, chunk_seconds=60).count() == everything
    prior = spark.createDataFrame(
        [("x", "AAA", minute(99), prices[99])], "exchange string, symbol string, event_time timestamp, price double"
    )
    first = threshold_alerts(whole.where(F.col("event_time") <= minute(99)), table).count()
    rest = threshold_alerts(whole.where(F.col("event_time") > minute(99)), table, prior).count()
    assert first + rest == everything
    late = ticks(spark, [1000.0, 100.0], first=98)
    assert threshold_alerts(late, table, prior).where("observed_value = 1000").isEmpty()


def test_large_rule_table_takes_the_salted_join(spark, monkeypatch):
    table = rules(spark, *[("AAA", None, "cross_above", 90.0 + i, f"r{i}") for i in range(20)])
    stream = ticks(spark, [85.0, 120.0, 80.0, 100.5] * 10)
    small = threshold_alerts(stream, table)
    assert small.count() == 20 * 10 + 11 * 10
    monkeypatch.setattr(chunks, "fits_broadcast", lambda *args, **kwargs: False)
    salted = threshold_alerts(stream, table)
    assert salted.drop("metadata").exceptAll(small.drop("metadata")).isEmpty() and salted.count() == small.count()


def test_fits_broadcast_measures(spark):
    assert chunks.fits_broadcast(spark.range(10).selectExpr("id"), max_rows=10)
    assert not chunks.fits_broadcast(spark.range(11).selectExpr("id"), max_rows=10)
    assert not chunks.fits_broadcast(spark.range(1).selectExpr("repeat('x', 1000) AS t"), max_bytes=100)


@pytest.mark.parametrize("block", [1, 3, 7, 128])
def test_blocks_of_rules_fire_like_every_rule_compared(spark, monkeypatch, block):
    draw = random.Random(block)
    prices = [float(draw.randrange(90, 111)) for _ in range(60)] + [100.0, 100.0, 100.0]
    stream = ticks(spark, prices).unionByName(ticks(spark, prices[::-1], "BBB")).unionByName(ticks(spark, [float("nan"), 95.0], "CCC"))
    table = rules(spark, *[
        (s, None, draw.choice(DIRECTIONS), float(draw.randrange(88, 113)), f"{s}-{i}") for s, n in (("AAA", 80), ("BBB", 5), ("CCC", 40)) for i in range(n)
    ])
    monkeypatch.setattr(rules_module, "RULE_BLOCK", 10**6)
    want = threshold_alerts(stream, table).drop("metadata")
    monkeypatch.setattr(rules_module, "RULE_BLOCK", block)
    got = threshold_alerts(stream, table).drop("metadata")
    assert got.count() == want.count() > 500 and got.exceptAll(want).isEmpty()


def test_compared_rules_grow_with_the_alerts(spark):
    prices = [100.0 + 0.01 * (i % 7) for i in range(200)]
    observed = price_changes(ticks(spark, prices), chunk_seconds=10**6)
    for count in (1_000, 10_000):
        table = spark.range(count).selectExpr("'AAA' AS symbol", "CAST(90 + id * 20.0 / %d AS DOUBLE) AS threshold" % count)
        blocked, fences = rules_module._rule_blocks(table, 128)
        assert blocked.groupBy("_block").count().agg(F.max("count")).first()[0] == 128
        crossed = rules_module._crossed_blocks(observed, fences, count // 128, "event_time", "edge").where("previous_price IS NOT NULL")
        # A step of at most 0.06 crosses 3 of 1,000 rules, or 30 of 10,000: one block, or two at a cut.
        assert crossed.groupBy("event_time").count().agg(F.max("count")).first()[0] <= 2


def test_crossed_blocks_are_never_broadcast_and_rules_not_repeated(spark, monkeypatch):
    """An observation repeated for every block it crosses looks small to Spark, and each rule used to be repeated 64 times."""
    monkeypatch.setattr(rules_module, "RULE_BLOCK", 8)
    monkeypatch.setattr(rules_module, "fits_broadcast", lambda *args, **kwargs: False)
    monkeypatch.setattr(rules_module, "BLOCK_READINGS", 10)
    table = rules(spark, *[("AAA", None, "cross_above", 90.0 + i / 10, f"r{i}") for i in range(100)])
    stream = ticks(spark, [85.0, 120.0] * 40)
    events = threshold_alerts(stream, table)
    plan = events._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"(\w+) \[symbol#\d+, _block#\d+, _part#\d+\]", plan)) == {"SortMergeJoin"}
    assert events.count() == 40 * 100 and events.select("signal_name", "event_time").distinct().count() == 40 * 100


def test_blocks_of_a_symbol_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(rules_module, "RULE_BLOCKS", 16)
    table = spark.range(5000).selectExpr("'AAA' AS symbol", "CAST(pmod(id * 7919, 5000) AS DOUBLE) AS threshold")
    blocked, fences = rules_module._rule_blocks(table, 128)
    assert fences.selectExpr("size(_fences)").first()[0] == 15
    sizes = blocked.groupBy("_block").agg(F.count("*").alias("n"), F.min("threshold").alias("low")).orderBy("low").collect()
    assert [row.n for row in sizes] == [313] * 15 + [305] and [row._block for row in sizes] == list(range(16))


def test_rules_travel_in_packs_and_fire_like_every_rule_compared(spark, monkeypatch):
    """A reading met every rule of its blocks as a row of its own, those of the other direction among them."""
    draw = random.Random(5)
    prices = [draw.choice([float(draw.randrange(80, 121)), draw.uniform(90, 110), float("nan"), None]) for _ in range(80)]
    stream = ticks(spark, prices).unionByName(ticks(spark, [101.0, 99.0, -0.0, 0.0], "BBB"))
    levels = [100.0] * 20 + [float("nan"), 0.0, None] + [draw.uniform(90, 110) for _ in range(60)]
    table = rules(spark, *[(s, draw.choice([None, "spot", "1h"]), d, level, f"{s}-{d}-{i}") for s in ("AAA", "BBB") for d in DIRECTIONS for i, level in enumerate(levels)])
    want = threshold_alerts(stream, table).drop("metadata")
    monkeypatch.setattr(rules_module, "RULE_BLOCK", 10**6)
    assert want.exceptAll(threshold_alerts(stream, table).drop("metadata")).isEmpty()
    monkeypatch.setattr(rules_module, "RULE_BLOCK", 8)
    monkeypatch.setattr(rules_module, "PACK_RULES", 3)
    monkeypatch.setattr(rules_module, "fits_broadcast", lambda *args, **kwargs: False)
    got = threshold_alerts(stream, table).drop("metadata")
    assert got.count() == want.count() > 1000 and got.exceptAll(want).isEmpty()
    assert got.groupBy("direction").count().count() == 4
    assert "inline(CASE WHEN" in got._jdf.queryExecution().executedPlan().toString()


def test_readings_beyond_all_rules_cross_no_block(spark):
    table = spark.range(1000).selectExpr("'AAA' AS symbol", "CAST(100 + id AS DOUBLE) AS threshold")
    blocked, fences = rules_module._rule_blocks(table, 128)
    observed = price_changes(ticks(spark, [50.0, 60.0, 40.0, 2000.0, 3000.0]), chunk_seconds=10**6)
    crossed = rules_module._crossed_blocks(observed, fences, 1000 // 128, "event_time", "edge").where("previous_price IS NOT NULL")
    assert {(row.price, row.n) for row in crossed.groupBy("price").agg(F.count("*").alias("n")).collect()} == {(2000.0, 8)}


def test_shown_doubles_are_those_of_round(spark):
    from registry.queries import _rounded

    draw = random.Random(3)
    values = [0.0, -0.0, 1e-7, -1e-7, 5e-7, 0.1 + 0.2, 4294967296.0000005, 1e300, float("nan"), float("inf"), float("-inf"), None, 2.675, 1e16 + 2]
    values += [draw.uniform(-1, 1) * 10 ** draw.randrange(-8, 12) for _ in range(3000)] + [round(draw.uniform(-500, 500), draw.randrange(8)) for _ in range(3000)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for digits in (2, 4, 6):
        pairs = frame.select(_rounded(F.col("v"), digits).cast("string").alias("a"), F.round("v", digits).cast("string").alias("b"))
        assert pairs.where("NOT a <=> b").isEmpty()
