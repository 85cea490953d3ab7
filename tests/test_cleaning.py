from __future__ import annotations

import random
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barlake.operators.cleaning import clean_bars, fill_missing_bars, latest_revision, normalize_bars
from helpers import bar_frame, column, minute, raw_frame, raw_row, same_rows


def test_duplicate_and_gap(spark):
    rows = [
        raw_row(minute(0), "100", "10", "5", minute(0) + timedelta(seconds=1)),
        raw_row(minute(2), "103", "12", "6", minute(2) + timedelta(seconds=1)),
        raw_row(minute(2), "102", "11", "4", minute(1.5)),
    ]
    bars = clean_bars(raw_frame(spark, rows)).orderBy("open_time").collect()
    assert [b.close for b in bars] == [100.0, 100.0, 103.0]
    assert [b.is_synthetic for b in bars] == [False, True, False]
    assert [b.trade_count for b in bars] == [5, 0, 6]
    assert bars[1].volume == 0.0 and bars[1].open == bars[1].high == bars[1].low == 100.0
    assert bars[1].ingested_at == bars[0].ingested_at
    assert (bars[1].close_time - bars[1].open_time) == timedelta(minutes=1) - timedelta(milliseconds=1)
    unfilled = clean_bars(raw_frame(spark, rows), fill=False)
    assert column(unfilled, "close") == [100.0, 103.0]


@pytest.mark.parametrize(
    "text, number",
    [("1.5", 1.5), (" 2 ", 2.0), ("-3e2", -300.0), (".5", 0.5), ("inf", float("inf")), ("nan", None), ("1d", None),
     ("bad", None), ("", None), (None, None), ("0x1", None)],
)
def test_number_text(spark, text, number):
    raw = raw_frame(spark, [raw_row(minute(0), text, trades="5.7")])
    bar = normalize_bars(raw).first()
    assert bar.close == number and bar.trade_count == 5


@pytest.mark.parametrize("text, count", [(None, 0), ("bad", 0), ("7", 7), ("nan", 0)])
def test_trade_count(spark, text, count):
    assert normalize_bars(raw_frame(spark, [raw_row(minute(0), "1", trades=text)])).first().trade_count == count


def test_missing_ingestion_time_wins(spark):
    typed = normalize_bars(raw_frame(spark, [raw_row(minute(0), "1"), raw_row(minute(0), "2")]))
    rows = typed.withColumn(
        "ingested_at", F.when(F.col("close") == 2, F.lit(None).cast("timestamp")).otherwise(F.col("open_time"))
    )
    assert latest_revision(rows).first().close == 2.0


def test_off_grid_bars_drop_out_but_extend_the_grid(spark):
    bars = bar_frame(spark, [1.0, 2.0, 3.0], times=[0, 1.5, 3.5])
    filled = fill_missing_bars(bars)
    assert column(filled, "open_time") == [minute(i).replace(tzinfo=None) for i in range(4)]
    assert column(filled, "close") == [1.0] * 4


def test_metadata_is_filled_forward_then_backward(spark):
    bars = bar_frame(spark, [1.0, 2.0, 3.0], times=[0, 2, 3000])
    bars = bars.withColumn("load_source", F.when(F.col("close") == 2, "known"))
    filled = fill_missing_bars(bars)
    assert filled.where("load_source = 'known'").count() == filled.count() == 3001


def test_missing_close_stays_missing_on_real_bars(spark):
    bars = bar_frame(spark, [1.0, None, 3.0], times=[0, 1, 4])
    assert column(fill_missing_bars(bars), "close") == [1.0, None, 1.0, 1.0, 3.0]


def test_unknown_interval_fails(spark):
    with pytest.raises(Exception, match="Unsupported interval"):
        fill_missing_bars(bar_frame(spark, [1.0], interval="7m")).collect()


def _brute_force(rows):
    """Row-by-row filling of one series: a dict per grid minute."""
    by_time = {r["at"]: r for r in rows}
    times = sorted(by_time)
    out, close, source, at = [], None, None, times[0]
    first_source = next((by_time[t]["source"] for t in times if by_time[t]["source"]), None)
    while at <= times[-1]:
        real = by_time.get(at)
        if real is not None:
            close = real["close"] if real["close"] is not None else close
            source = real["source"] or source
            out.append((at, real["close"], False, source or first_source))
        else:
            out.append((at, close, True, source or first_source))
        at += 1
    return out


@pytest.mark.parametrize("seed", range(3))
def test_chunked_filling_equals_brute_force(spark, seed):
    """Long gaps over empty chunks, off-grid bars, missing closes and missing metadata."""
    draw = random.Random(seed)
    expected, frames = [], []
    for symbol in ("AAA", "BBB"):
        times, at = [], draw.randrange(3000)
        for _ in range(40):
            times.append(at)
            at += draw.choice([1, 1, 1, 2, 700, 4000])
        rows = [
            {"at": t, "close": draw.choice([None, float(t)]), "source": draw.choice([None, "s", f"s{t}"])} for t in times
        ]
        expected += [(symbol, *row) for row in _brute_force(rows)]
        noise = [{"at": t + 0.5, "close": -1.0, "source": "off"} for t in times[1:-1:3]]
        both = rows + noise
        frame = bar_frame(spark, [r["close"] for r in both], symbol, times=[r["at"] for r in both])
        sources = spark.createDataFrame([(minute(r["at"]), r["source"]) for r in both], "open_time timestamp, s string")
        frames.append(frame.join(sources, "open_time").withColumn("load_source", F.col("s")).select(frame.columns))
    bars = frames[0].unionByName(frames[1])
    got = fill_missing_bars(bars, chunk_bars=1440).select("symbol", "open_time", "close", "is_synthetic", "load_source")
    want = pd.DataFrame(expected, columns=["symbol", "at", "close", "is_synthetic", "load_source"])
    have = got.toPandas()
    have["at"] = ((have.open_time - pd.Timestamp("2024-05-01")) / pd.Timedelta(minutes=1)).astype(int)
    have = have.sort_values(["symbol", "at"]).reset_index(drop=True)
    pd.testing.assert_frame_equal(have[want.columns], want, check_dtype=False)


def test_chunk_length_does_not_change_the_result(spark):
    bars = bar_frame(spark, [float(i) for i in range(60)], times=[i * i for i in range(60)])
    assert same_rows(fill_missing_bars(bars, chunk_bars=1440), fill_missing_bars(bars, chunk_bars=100_000))


def test_deduplicated_bars_are_shuffled_once(spark, tmp_path):
    """Gap filling reads them twice; both readings must have the same plan for Spark to share the shuffle."""
    raw_frame(spark, [raw_row(minute(i), "1") for i in range(30)]).write.parquet(f"{tmp_path}/raw")
    cleaned = clean_bars(spark.read.parquet(f"{tmp_path}/raw"))
    cleaned.collect()
    assert "ReusedExchange" in cleaned._jdf.queryExecution().executedPlan().toString()
