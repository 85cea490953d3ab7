from __future__ import annotations

import random

import pandas as pd
import pytest

from barlake.operators.features import add_moving_averages, add_returns, add_volatility, feature_frame
from barlake.schema import FEATURE_COLUMNS, GOLD_COLUMNS
from helpers import bar_frame, column


def test_six_bars(spark):
    gold = feature_frame(bar_frame(spark, [100.0 + i for i in range(6)]))
    assert gold.columns == GOLD_COLUMNS
    assert column(gold, "return_1")[:2] == [None, pytest.approx(0.01)]
    assert column(gold, "return_5") == [None] * 5 + [pytest.approx(0.05)]
    assert column(gold, "log_return_1")[5] == pytest.approx(0.009569451016)
    assert column(gold, "ma_5") == [None] * 4 + [102.0, 103.0]
    assert column(gold, "vol_5") == [None] * 5 + [pytest.approx(0.000135983381, abs=1e-12)]
    for name in ("return_20", "ma_20", "ma_50", "vol_20"):
        assert column(gold, name) == [None] * 6


def _pandas_features(frame: pd.DataFrame) -> pd.DataFrame:
    import numpy as np

    out = frame.sort_values("open_time").copy()
    change = out.close.pct_change(fill_method=None)
    for n in (1, 5, 20):
        out[f"return_{n}"] = out.close.pct_change(n, fill_method=None)
    out["log_return_1"] = np.log(out.close).diff()
    for n in (5, 20, 50):
        out[f"ma_{n}"] = out.close.rolling(n, min_periods=n).mean()
    for n in (5, 20):
        out[f"vol_{n}"] = change.rolling(n, min_periods=n).apply(lambda v: v.std(ddof=0), raw=True)
    return out


@pytest.mark.parametrize("density", ["dense", "sparse"])
def test_chunked_features_equal_whole_series(spark, density):
    """The look-back counts bars: it must cross chunk borders, and many sparse chunks at once."""
    draw = random.Random(density)
    times, at = [], 0
    for _ in range(300):
        times.append(at)
        at += draw.choice([1, 20, 60]) if density == "dense" else draw.choice([300, 1440, 5000])
    closes = [None if draw.random() < 0.03 else 100 + draw.random() * 10 for _ in times]
    bars = bar_frame(spark, closes, times=times).unionByName(bar_frame(spark, closes[::-1], "BBB", times=times))
    got = feature_frame(bars, chunk_bars=1440).toPandas().sort_values(["symbol", "open_time"]).reset_index(drop=True)
    source = bars.toPandas()
    source["close"] = source["close"].astype(float)
    want = pd.concat([_pandas_features(part) for _, part in source.groupby("symbol")]).reset_index(drop=True)
    for name in FEATURE_COLUMNS:
        pd.testing.assert_series_equal(got[name].astype(float), want[name].astype(float), rtol=1e-9, atol=1e-12)


def test_other_windows(spark):
    closes = [float((i * 37) % 101 + 50) for i in range(250)]
    bars = bar_frame(spark, closes)
    series = pd.Series(closes)
    for windows in ([3], [7, 11], [97]):
        means = add_moving_averages(bars, windows)
        spread = add_volatility(bars, windows)
        for n in windows:
            want = series.rolling(n).mean()
            got = pd.Series(column(means, f"ma_{n}"), dtype=float)
            pd.testing.assert_series_equal(got, want, check_names=False)
            want = series.pct_change().rolling(n).std(ddof=0)
            got = pd.Series(column(spread, f"vol_{n}"), dtype=float)
            pd.testing.assert_series_equal(got, want, check_names=False, rtol=1e-7)
    assert add_returns(bars, []).columns == add_returns(bars).columns


def test_zero_and_constant_closes(spark):
    gold = feature_frame(bar_frame(spark, [0.0, 1.0] + [2.0] * 10))
    assert column(gold, "return_1")[:3] == [None, None, 1.0]
    assert column(gold, "log_return_1")[1] is None
    assert column(gold, "vol_5")[-1] == 0.0


def test_features_need_two_wide_shuffles_at_most(spark):
    plan = feature_frame(bar_frame(spark, [1.0, 2.0]))._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert plan.count("Exchange hashpartitioning") == 3
    assert "Python" not in plan
