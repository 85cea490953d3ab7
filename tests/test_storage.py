from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from barlake.operators.cleaning import clean_bars
from barlake.operators.features import feature_frame
from barlake.operators.quality import assert_quality, integrity_report, rejected_bars, window_report
from barlake.plans.loads import run_backfill, run_incremental, run_realtime
from barlake.plans.steps import Lake, Scope, extract_step, gold_step, quality_step, serving_step, silver_step
from barlake.schema import SERIES
from barlake.sources.klines import extract_recent, extract_window, raw_bars_from_payloads
from barlake.sources.layers import DAY_LAYOUT, merge_layer, read_layer, read_window, upsert_serving, write_layer
from barlake.sources.marks import read_marks
from helpers import bar_frame, column, millis, minute, raw_frame, raw_row, same_rows


def test_payload_page(spark):
    pages = spark.createDataFrame(
        [("AAA", "1m", '[[0,"1","2","0.5","1.5","10",59999,"15",3,"4","6","0"],[60000,"1","2","0.5","1.6","10",119999,"15",3,"4","6","0"]]')],
        "symbol string, interval string, payload string",
    )
    bars = raw_bars_from_payloads(pages, exchange="x", load_source="landed")
    assert column(bars, "close") == ["1.5", "1.6"] and column(bars, "close_time") == [59999, 119999]
    assert raw_bars_from_payloads(pages.limit(0)).columns == bars.columns


def test_window_is_inclusive(spark):
    raw = raw_frame(spark, [raw_row(minute(i), str(i)) for i in range(5)])
    assert column(extract_window(raw, minute(1), minute(3)), "close") == ["1", "2", "3"]
    assert column(extract_window(raw, minute(0.5), minute(1.5)), "close") == ["1"]


def test_recent_bars_use_the_latest_revision(spark):
    rows = [raw_row(minute(i), str(i)) for i in range(4)] + [raw_row(minute(3), "9", ingested=minute(10))]
    assert column(extract_recent(raw_frame(spark, rows), 2), "close") == ["2", "9"]


def test_layer_scan_prunes_folders(spark, tmp_path):
    root = str(tmp_path)
    assert read_layer(spark, root, "silver").count() == 0
    bars = bar_frame(spark, [float(i) for i in range(4000)])
    assert write_layer(bars, root, "silver") == 4000
    assert write_layer(bars.limit(0), root, "silver") == 0
    window = read_window(spark, root, "silver", minute(1440), minute(1500), exchange="x", symbol="AAA", interval="1m")
    assert column(window, "close") == [float(i) for i in range(1440, 1501)]
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "GreaterThanOrEqual(open_time" in plan


def test_bronze_days_come_from_epoch_millis(spark, tmp_path):
    write_layer(raw_frame(spark, [raw_row(minute(0), "1")]), str(tmp_path), "bronze")
    assert str(read_layer(spark, str(tmp_path), "bronze").first().date) == "2024-05-01"


@pytest.mark.parametrize("layout", [("exchange", "symbol", "interval", "date"), DAY_LAYOUT])
def test_merge_keeps_untouched_rows(spark, tmp_path, layout):
    root = str(tmp_path)
    bars = bar_frame(spark, [float(i) for i in range(3000)]).unionByName(bar_frame(spark, [1.0, 2.0], "BBB"))
    merge_layer(spark, bars, root, "silver", layout)
    changed = bars.where((F.col("symbol") == "AAA") & F.col("open_time").between(F.lit(minute(10)), F.lit(minute(20))))
    changed = changed.withColumn("close", F.col("close") + 1000)
    for _ in range(2):
        assert merge_layer(spark, changed, root, "silver", layout) == 11
    stored = read_layer(spark, root, "silver").drop("date")
    want = changed.unionByName(bars.join(changed.select(*SERIES, "open_time"), [*SERIES, "open_time"], "left_anti"))
    assert same_rows(stored, want)


def test_upsert_newest_duplicate_wins_and_nan_becomes_null(spark, tmp_path):
    gold = feature_frame(bar_frame(spark, [1.0]))
    newer = gold.withColumns({"close": F.lit(5.0), "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 SECOND"),
                              "ma_5": F.lit(float("nan"))})
    assert upsert_serving(spark, newer.unionByName(gold), str(tmp_path)) == 2
    row = read_layer(spark, str(tmp_path), "serving").first()
    assert row.close == 5.0 and row.ma_5 is None and row.updated_at is not None


def _raw(spark, first, last, drop=()):
    return raw_frame(spark, [raw_row(minute(i), str(100 + i % 7)) for i in range(first, last) if i not in drop])


def test_staged_steps_equal_one_backfill(spark, tmp_path):
    raw = _raw(spark, 0, 120, drop=(5, 50, 51))
    scope = Scope.window(minute(0), minute(119))
    staged, whole = Lake(str(tmp_path / "staged")), Lake(str(tmp_path / "whole"))
    assert extract_step(spark, staged, raw, scope) == 117
    for _ in range(2):
        assert silver_step(spark, staged, scope) == 120
        assert gold_step(spark, staged, scope) == 120
        assert serving_step(spark, staged, scope) == 120
    summary = run_backfill(spark, whole, raw, minute(0), minute(119)).first()
    assert (summary.rows_extracted, summary.rows_cleaned, summary.rows_loaded) == (117, 120, 120)
    assert summary.status == "success" and summary.metadata["window_start"].startswith("2024-05-01")
    a = read_layer(spark, staged.root, "serving").drop("updated_at")
    assert same_rows(a, read_layer(spark, whole.root, "serving").drop("updated_at"))
    report = quality_step(spark, staged, Scope.window(minute(0), minute(119), exchange="x", symbol="AAA", interval="1m"))
    assert_quality(report)


def test_incremental_continues_with_full_features(spark, tmp_path):
    raw, lake = _raw(spark, 0, 300), Lake(str(tmp_path))
    run_incremental(spark, lake, raw, as_of=minute(200.5), lookback_minutes=150)
    assert read_layer(spark, lake.root, "serving").count() == 150
    run_incremental(spark, lake, raw, as_of=minute(250.5))
    serving = read_layer(spark, lake.root, "serving")
    assert serving.count() == 200
    assert serving.where(F.col("open_time") > F.lit(minute(200))).where("ma_50 IS NULL").isEmpty()
    mark = read_marks(spark, lake.path("marks"), "incremental_batch").first()
    assert mark.last_success_open_time == minute(250).replace(tzinfo=None) and mark.last_row_count == 50
    run_realtime(spark, lake, raw, 5)
    serving = read_layer(spark, lake.root, "serving")
    assert serving.count() == 205
    assert read_marks(spark, lake.path("marks")).count() == 1
    cold = Lake(str(tmp_path / "cold"), warmup_bars=0)
    run_backfill(spark, cold, raw, minute(0), minute(100))
    run_realtime(spark, cold, _raw(spark, 0, 101), 5)
    tail = read_layer(spark, cold.root, "serving").orderBy(F.col("open_time").desc()).limit(1).first()
    assert tail.ma_5 is not None and tail.ma_20 is None


def test_failed_load_is_recorded(spark, tmp_path):
    lake = Lake(str(tmp_path))
    bad = _raw(spark, 0, 3).withColumn("interval", F.lit("7m"))
    with pytest.raises(Exception, match="Unsupported interval"):
        run_backfill(spark, lake, bad, minute(0), minute(5))
    assert spark.read.json(lake.path("runs")).first().status == "failed"


@pytest.mark.parametrize(
    "times, reason, gaps",
    [([0, 1, 2], None, 0), ([0, 1, 1], "duplicate primary key", 0), ([0, 3], "missing bars", 2)],
)
def test_quality_cases(spark, times, reason, gaps):
    row = window_report(bar_frame(spark, [1.0] * len(times), times=times)).first()
    assert row.reason == reason and row.gap_violations == gaps
    assert row.status == ("pass" if reason is None else "fail")


def test_keys_are_counted_exactly_on_and_off_the_grid(spark):
    times = [*range(-70, 70, 3), *range(-70, 70, 6), 0.5, 0.5, 0.25, -3.5, 64, 64]
    bars = bar_frame(spark, [1.0] * len(times), times=times)
    bars = bars.unionByName(bars.limit(1).withColumn("open_time", F.lit(None).cast("timestamp")))
    row = window_report(bars.repartition(3)).first()
    wanted = bars.agg(F.count("*"), F.countDistinct("open_time"), F.min("open_time"), F.max("open_time")).first()
    assert (row.row_count, row.distinct_pk, row.min_open_time, row.max_open_time) == tuple(wanted)
    assert row.distinct_pk == len(set(times)) and row.reason == "duplicate primary key"


def test_empty_window(spark):
    bars = bar_frame(spark, [1.0])
    series = bars.select(*SERIES)
    assert window_report(bars.limit(0), series).first().reason == "empty window"
    assert window_report(bars.limit(0), series, allow_empty=True).first().status == "pass"
    with pytest.raises(RuntimeError, match="empty window"):
        assert_quality(window_report(bars.limit(0), series))


def test_integrity(spark):
    bars = bar_frame(spark, [1.0, None, 3.0], times=[0, 1, 1])
    row = integrity_report(bars).first()
    assert (row.null_close, row.duplicate_keys, row.status) == (1, 1, "fail")
    assert rejected_bars(bars).first().missing.startswith("open,high,low,close")


def test_bars_without_a_time_and_unreadable_pages_are_rejected_and_counted(spark, tmp_path):
    rows = [raw_row(minute(i), "100") for i in range(4)]
    rows[1]["open_time"] = None
    raw = raw_frame(spark, rows)
    pages = spark.createDataFrame([("AAA", "1m", "[]"), ("AAA", "1m", "oops"), ("AAA", "1m", None)], "symbol string, interval string, payload string")
    lake = Lake(f"{tmp_path}/lake")
    summary = run_backfill(spark, lake, raw, minute(0), minute(10), pages=pages).first()
    assert (summary.rows_extracted, summary.rows_rejected, summary.metadata["pages_rejected"]) == (4, 1, "2")
    rejects = spark.read.json(lake.path("rejects")).collect()
    assert [r.reject_reason for r in rejects] == ["no series key or open time"]
    assert spark.read.json(lake.path("rejected_pages")).count() == 2
    assert column(read_layer(spark, lake.root, "silver"), "is_synthetic") == [False, True, False, False]
    # An incremental load reports an undated bar once.
    other = Lake(f"{tmp_path}/other")
    counts = [run_incremental(spark, other, raw, minute(9 + i), lookback_minutes=60).first().rows_rejected for i in range(2)]
    assert counts == [1, 0]
    # Nothing but undated bars is a load too.
    none = run_backfill(spark, Lake(f"{tmp_path}/none"), raw.where("open_time IS NULL"), minute(0), minute(9)).first()
    assert (none.rows_extracted, none.rows_rejected, none.rows_loaded) == (1, 1, 0)


def test_rows_of_empty_folders_are_written_without_ranking(spark, tmp_path, monkeypatch):
    """Bars of days that hold nothing yet go to their folders as they are; days that hold bars are merged by key."""
    from barlake.sources import layers

    ranked, merge_rows = [], layers.merge_rows
    monkeypatch.setattr(layers, "merge_rows", lambda old, new: ranked.append(new.count()) or merge_rows(old, new))
    bars = bar_frame(spark, [float(i) for i in range(15)], times=[day * 1440 + i for day in range(3) for i in range(5)])
    root, rows = str(tmp_path), bars.where(F.col("open_time") < F.lit(minute(2 * 1440)))
    assert merge_layer(spark, rows, root, "silver", DAY_LAYOUT, unique=True) == 10 and ranked == []
    later = bars.where(F.col("open_time") >= F.lit(minute(1440))).withColumn("close", F.col("close") + 100)
    assert merge_layer(spark, later, root, "silver", DAY_LAYOUT, unique=True) == 10 and ranked == [5]
    want = rows.where(F.col("open_time") < F.lit(minute(1440))).unionByName(later)
    assert same_rows(read_layer(spark, root, "silver").drop("date"), want)


def test_series_too_many_to_broadcast_are_joined_by_shuffle(spark, tmp_path, monkeypatch):
    """The bounds of very many series, once for each of 64 salts, looked small to Spark by their compressed file, and the driver
    ran out of memory building their broadcast."""
    from barlake.operators import chunks, cleaning

    rows = [raw_row(minute(at), str(100 + at % 7), symbol=f"S{s}") for s in range(4) for at in range(s, 100, 3 + s)]
    raw = raw_frame(spark, [*rows, raw_row(minute(30.5), "7", symbol="S1"), raw_row(minute(5), "7", symbol=None)])
    lake = Lake(str(tmp_path), DAY_LAYOUT, fill=False)
    write_layer(clean_bars(raw, fill=False), lake.root, "silver", lake.layout)
    scope = Scope.per_series(raw.where(F.col("open_time").between(millis(minute(40)), millis(minute(69)))))

    def frames():
        near = [scope.neighbours(spark, lake, "silver", 4, after) for after in (False, True)]
        return [scope.inside(spark, lake, "silver"), *near, cleaning.rejected_raw_bars(raw, scope.bounds)]

    expected = [frame.collect() for frame in frames()]
    monkeypatch.setattr(chunks, "fits_broadcast", lambda *_: False)
    for frame, want in zip(frames(), expected):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan and "Generate" not in plan
        assert sorted(frame.collect(), key=str) == sorted(want, key=str) != []


@pytest.mark.parametrize("how", ["inner", "left"])
def test_only_hot_keys_are_dealt_over_parts(spark, monkeypatch, how):
    from barlake.operators import chunks

    monkeypatch.setattr(chunks, "fits_broadcast", lambda *_: False)
    rows = spark.range(300).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN concat('k', id % 40) END AS key", "id")
    parameters = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4), ("idle", 5)], "key string, value int")
    dealt = chunks.join_parameters(rows, parameters, ["key"], ["id"], how, part_rows=30)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "_part" in plan
    assert same_rows(dealt, rows.join(parameters, ["key"], how)) and dealt.count() == rows.join(parameters, ["key"], how).count()
