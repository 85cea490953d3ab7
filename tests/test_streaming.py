from __future__ import annotations

import random

from pyspark.sql import functions as F

from barlake.operators.rules import threshold_alerts
from barlake.schema import RULE
from barlake.session import scratch_scope, stored, subfolders
from barlake.streaming.alerts import (
    _alert_batch, _foldered, cycle_counts, near_history, read_alerts, read_ticks, run_once, start_alerts, tick_stream,
)
from barlake.streaming.runs import Runs
from test_rules import rules, ticks


def _run(spark, root, table, **options):
    return run_once(spark, f"{root}/in", table, f"{root}/ticks", f"{root}/alerts", f"{root}/cp", **options)


def test_three_runs_on_one_state(spark, tmp_path):
    table = rules(spark, ("AAA", None, "cross_above", 100.0, "breakout"))
    counts = []
    for i, price in enumerate([99.0, 101.0, 105.0]):
        ticks(spark, [price], first=i).write.mode("append").parquet(f"{tmp_path}/in")
        counts.append(_run(spark, tmp_path, table))
    assert [c["alert_count"] for c in counts] == [0, 1, 0]
    assert [c["tick_count"] for c in counts] == [1, 1, 1]
    assert read_ticks(spark, f"{tmp_path}/ticks").count() == 3
    event = read_alerts(spark, f"{tmp_path}/alerts").collect()
    assert [(e.signal_name, e.observed_value) for e in event] == [("breakout", 101.0)]
    assert _run(spark, tmp_path, table) == {"tick_count": 0, "alert_count": 0}


def test_stream_equals_batch(spark, tmp_path):
    draw = random.Random(3)
    prices = [draw.uniform(95, 105) for _ in range(120)]
    table = spark.createDataFrame(
        [(s, None, d, 100.0, f"{s}-{d}") for s in ("AAA", "BBB") for d in ("above", "below", "cross_above", "cross_below")],
        RULE,
    )
    everything = ticks(spark, prices).unionByName(ticks(spark, prices[::-1], "BBB"))
    for low in range(0, 120, 40):
        part = everything.where((F.minute("event_time") + 60 * F.hour("event_time")).between(low, low + 39))
        part.write.mode("append").parquet(f"{tmp_path}/in")
        _run(spark, tmp_path, table, chunk_seconds=300)
    got = read_alerts(spark, f"{tmp_path}/alerts").drop("batch_id", "metadata")
    want = threshold_alerts(everything, table).drop("metadata")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    assert cycle_counts(spark, f"{tmp_path}/cp/alerts").agg(F.sum("tick_count")).first()[0] == 240


def test_late_tick_replaces_the_verdict_of_its_successor(spark, tmp_path):
    table = rules(spark, ("AAA", None, "above", 100.0, "high"))
    ticks(spark, [99.0, 105.0], first=10).write.mode("append").parquet(f"{tmp_path}/in")
    assert _run(spark, tmp_path, table) == {"tick_count": 2, "alert_count": 1}
    late = ticks(spark, [500.0], first=10).withColumn("event_time", F.col("event_time") + F.expr("INTERVAL 30 SECONDS"))
    late.write.mode("append").parquet(f"{tmp_path}/in")
    assert _run(spark, tmp_path, table) == {"tick_count": 1, "alert_count": 1}
    assert [a.observed_value for a in read_alerts(spark, f"{tmp_path}/alerts").collect()] == [500.0]
    assert read_ticks(spark, f"{tmp_path}/ticks").count() == 3
    assert cycle_counts(spark, f"{tmp_path}/cp/alerts").agg(F.sum("late_count")).first()[0] == 1


def test_shuffled_files_give_the_alerts_of_a_batch(spark, tmp_path):
    draw = random.Random(5)
    table = spark.createDataFrame([("AAA", None, d, 100.0, d) for d in ("above", "below", "cross_above", "cross_below")], RULE)
    everything = ticks(spark, [draw.uniform(95, 105) for _ in range(60)])
    for part in range(3):
        chosen = everything.where(F.pmod(F.xxhash64("event_time"), F.lit(3)) == part)
        chosen.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        _run(spark, tmp_path, table)
    got = read_alerts(spark, f"{tmp_path}/alerts").drop("batch_id", "metadata")
    want = threshold_alerts(everything, table).drop("metadata")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()


def test_continuous_run(spark, tmp_path):
    table = rules(spark, ("AAA", None, "above", 100.0, "high"))
    ticks(spark, [99.0, 101.0]).write.parquet(f"{tmp_path}/in")
    query = start_alerts(
        tick_stream(spark, f"{tmp_path}/in", 1), table, f"{tmp_path}/alerts", f"{tmp_path}/cp",
        continuous=True, poll_seconds=0.2,
    )
    try:
        query.processAllAvailable()
        assert read_alerts(spark, f"{tmp_path}/alerts").count() == 1
    finally:
        query.stop()
        query.awaitTermination(30)


def test_runs_hold_every_batch_once_in_few_folders(spark, tmp_path):
    log = Runs(spark, f"{tmp_path}/log", width=3)

    def write(batch):
        spark.range(batch, batch + 1).coalesce(1).write.mode("overwrite").parquet(log.path(batch))
        log.merge_before(batch, lambda parts, out: spark.read.parquet(*parts).coalesce(1).write.mode("overwrite").parquet(out))

    for batch in range(50):
        write(batch)
        if batch in (26, 27, 28):
            write(batch)
            got = sorted(r.id for r in spark.read.parquet(*Runs(spark, log.root).live()).collect())
            assert got == list(range(batch + 1))
            before = spark.read.parquet(*log.live(until=batch - 1)).collect()
            assert sorted(r.id for r in before) == list(range(batch))
    assert sorted(r.id for r in spark.read.parquet(*log.live()).collect()) == list(range(50))
    assert len(log.live()) <= 2 * 4
    assert sum(len(subfolders(spark, f"{log.root}/{size}")) for size in subfolders(spark, log.root)) <= 4 * 2 * 3


def test_merged_runs_give_the_alerts_of_a_batch(spark, tmp_path):
    draw = random.Random(8)
    table = spark.createDataFrame([(s, None, d, 100.0, d) for s in ("AAA", "BBB") for d in ("above", "below", "cross_below")], RULE)
    # Ten days, three hours apart; a fifth of the ticks arrive in a later batch.
    everything = ticks(spark, [draw.uniform(95, 105) for _ in range(80)], step=180.0).unionByName(
        ticks(spark, [draw.uniform(95, 105) for _ in range(20)], "BBB", step=720.0)
    ).withColumn("batch", F.expr("int(unix_seconds(event_time) div 172800) + if(pmod(xxhash64(event_time), 5) = 0, 2, 0)"))
    everything = stored(everything.withColumn("batch", F.col("batch") - F.expr("(unix_seconds(timestamp'2024-05-01 00:00:00') div 172800)")), "t")
    evaluate = _alert_batch(f"{tmp_path}/alerts", f"{tmp_path}/cp/state", table, "spot", 3600, width=2)
    for batch in range(8):
        for _ in range(2 if batch == 4 else 1):
            evaluate(everything.where(F.col("batch") == batch).drop("batch"), batch)
    got = read_alerts(spark, f"{tmp_path}/alerts").drop("batch_id", "metadata")
    want = threshold_alerts(everything.drop("batch"), table).drop("metadata")
    assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    counts = cycle_counts(spark, f"{tmp_path}/cp")
    assert sorted(r.batch_id for r in counts.collect()) == list(range(8))
    totals = counts.agg(F.sum("tick_count"), F.sum("late_count")).first()
    assert totals[0] == 100 and totals[1] > 5
    assert sorted(subfolders(spark, f"{tmp_path}/alerts/events")) == ["size=1", "size=2", "size=4"]


def test_late_tick_reads_its_neighbours_only(spark, tmp_path):
    opened = {}
    for days in (6, 30):
        root = f"{tmp_path}/{days}"
        history, index = Runs(spark, f"{root}/ticks"), Runs(spark, f"{root}/days")
        # One instrument with a tick every second day, and one with many.
        rows = ticks(spark, [1.0] * (days // 2), step=2880.0).unionByName(ticks(spark, [2.0] * days * 4, "BBB", step=360.0))
        _foldered(rows).coalesce(1).write.partitionBy("bucket", "day").parquet(history.path(0))
        _foldered(rows).select("exchange", "symbol", "day", "bucket").distinct().coalesce(1).write.partitionBy("bucket").parquet(index.path(0))
        late = stored(_foldered(ticks(spark, [9.0], first=1440.0 * 3 + 60)), "late")
        near = near_history(late, history, index, 0)
        assert sorted(r.event_time.day for r in near.collect()) == [3, 5] and {r.symbol for r in near.collect()} == {"AAA"}
        opened[days] = len(near.inputFiles())
    assert opened[30] == opened[6] <= 4


def test_scratch_scope_removes_its_tables(spark, tmp_path):
    with scratch_scope(spark):
        gone = stored(spark.range(3), "gone").inputFiles()[0]
        left = stored(spark.range(3), "left", keep=True)
    assert left.count() == 3
    assert subfolders(spark, gone.rsplit("/", 2)[0]) == []


def test_late_ticks_are_not_shuffled_by_key_again(spark):
    """Ticks of one time and price lie in one chunk, where they were compared."""
    from barlake.streaming.alerts import _judged_again

    table = ticks(spark, [1.0, 2.0, 2.0, 3.0])
    plan = _judged_again(table.where("price <> 2"), table.where("price = 2"), 3600)._jdf.queryExecution().executedPlan().toString()
    assert "price" not in "".join(line.split("Exchange", 1)[1] for line in plan.splitlines() if "Exchange hashpartitioning" in line)
