from __future__ import annotations

import random

import pytest

from barlake.operators.strategy import (
    crossing_strategies,
    evaluate_strategies,
    strategy_bars,
    strategy_metrics,
)
from barlake.schema import STRATEGY
from helpers import bar_frame, column


def test_eight_bars(spark):
    bars = bar_frame(spark, [95.0, 99.0, 101.0, 103.0, 100.0, 97.0, 94.0, 96.0])
    results = strategy_bars(bars, crossing_strategies(bars, 100.0, 98.0))
    assert column(results, "strategy_id")[0] == "aaa_entry/aaa_exit"
    assert column(results, "target_position") == [0, 0, 1, 1, 1, 0, 0, 0]
    assert column(results, "position") == [0, 0, 0, 1, 1, 1, 0, 0]
    assert column(results, "turnover") == [0, 0, 1, 0, 0, 1, 0, 0]
    assert column(results, "strategy_return") == pytest.approx(
        [0, 0, -0.0005, 0.0198019802, -0.0291262136, -0.0305, 0, 0]
    )
    assert column(results, "equity_curve") == pytest.approx(
        [100000, 100000, 99950, 101929.207921, 98960.396040, 95942.103960, 95942.103960, 95942.103960]
    )
    metrics = strategy_metrics(results).first()
    assert metrics.total_return == pytest.approx(-0.040578960396)
    assert metrics.annualized_return == pytest.approx(-1.0)
    assert metrics.annualized_volatility == pytest.approx(11.370041406591)
    assert metrics.sharpe_ratio == pytest.approx(-233.007254721774)
    assert metrics.max_drawdown == pytest.approx(-0.058737864078)
    assert metrics.trade_count == 2


def _fires(direction, previous, current, level):
    if direction == "above":
        return current >= level
    if direction == "below":
        return current <= level
    if previous is None:
        return False
    if direction == "cross_above":
        return previous < level <= current
    return previous > level >= current


def _loop(closes, strategy):
    """Bar-by-bar evaluation of one strategy."""
    _, _, _, d_in, t_in, d_out, t_out, capital, bps = strategy
    position, previous, equity, peak, out = 0, None, capital, None, []
    for close in closes:
        old = position
        if _fires(*((d_out, previous, close, t_out) if position else (d_in, previous, close, t_in))):
            position = 1 - position
        change = close / previous - 1 if previous else 0.0
        equity *= 1 + old * change - abs(position - old) * bps / 10000
        peak = equity if peak is None else max(peak, equity)
        out.append((position, old, equity, equity / peak - 1))
        previous = close
    return out


DIRECTIONS = ("above", "below", "cross_above", "cross_below")


def test_chunks_chain_like_a_loop(spark):
    """All direction pairs over a dozen chunks, toggling pairs and ruinous costs included."""
    draw = random.Random(5)
    closes = [100 + draw.choice([-3, -2, -1, 0, 1, 2, 3]) for _ in range(200)]
    strategies = [
        (f"{a}-{b}-{bps}", "AAA", "15m", a, 100.5, b, 100.0, 1000.0, bps)
        for a in DIRECTIONS for b in DIRECTIONS for bps in (5.0, 30000.0)
    ]
    bars = bar_frame(spark, [float(c) for c in closes], interval="15m", step=15)
    table = spark.createDataFrame(strategies, STRATEGY)
    results = strategy_bars(bars, table, chunk_bars=16)
    got = {}
    for row in results.orderBy("open_time").collect():
        got.setdefault(row.strategy_id, []).append((row.target_position, row.position, row.equity_curve, row.drawdown))
    for strategy in strategies:
        for have, want in zip(got[strategy[0]], _loop(closes, strategy), strict=True):
            assert have[:2] == want[:2], strategy
            assert have[2:] == pytest.approx(want[2:], rel=1e-9, abs=1e-9), strategy
    bar_by_bar = {r.strategy_id: [0.0 if v is None else v for v in r[4:]] for r in strategy_metrics(results).collect()}
    chained = {r.strategy_id: [0.0 if v is None else v for v in r[4:]] for r in evaluate_strategies(bars, table, 16).collect()}
    assert len(chained) == len(strategies)
    for name in chained:
        assert chained[name] == pytest.approx(bar_by_bar[name], rel=1e-9, abs=1e-9, nan_ok=True), name
    small, whole = (
        {r.strategy_id: [0.0 if v is None else v for v in r[5:]] for r in evaluate_strategies(bars, table, n).collect()} for n in (16, 100_000)
    )
    for name in small:
        assert small[name] == pytest.approx(whole[name], rel=1e-6, abs=1e-9, nan_ok=True), name


def test_metrics_do_not_read_bars_twice(spark):
    bars = bar_frame(spark, [100.0 + (i * 7) % 5 for i in range(40)], interval="15m", step=15)
    plan = evaluate_strategies(bars, crossing_strategies(bars, 102.0, 101.0), 16)._jdf.queryExecution().executedPlan().toString()
    assert "strategy-chunks" in plan and "close" not in plan


def test_no_bars_is_an_error(spark):
    bars = bar_frame(spark, [1.0])
    table = spark.createDataFrame([("s", "AAA", "1m", "above", 1.0, "below", 1.0, 1.0, 0.0)], STRATEGY)
    with pytest.raises(ValueError, match="no bars"):
        evaluate_strategies(bars.limit(0), table)
    with pytest.raises(ValueError, match="more than once"):
        evaluate_strategies(bars, table.unionByName(table))


def test_flat_series_has_zero_sharpe(spark):
    bars = bar_frame(spark, [50.0] * 5)
    assert evaluate_strategies(bars, crossing_strategies(bars, 100.0, 98.0)).first().sharpe_ratio == 0.0


def test_unknown_direction_fails(spark):
    bars = bar_frame(spark, [1.0, 2.0])
    table = spark.createDataFrame([("s", "AAA", "1m", "sideways", 1.0, "below", 1.0, 1.0, 0.0)], STRATEGY)
    with pytest.raises(Exception, match="No such direction"):
        strategy_bars(bars, table).collect()


def test_many_strategies_are_brought_to_the_chunks(spark, monkeypatch):
    """Strategies too many to broadcast: neither they nor the bars are copied, save for symbols with very many of them."""
    from barlake.operators import chunks, strategy

    bars = bar_frame(spark, [90.0 + i * 7 % 23 for i in range(60)]).unionByName(bar_frame(spark, [95.0, 104.0, 99.0], symbol="BBB"))
    rows = [(f"s{i}", symbol, "1m", "above", 95.0 + i, "below", 100.0 + i, 1000.0, 5.0) for i in range(5) for symbol in ("AAA", "BBB") if symbol == "AAA" or i < 2]
    strategies = spark.createDataFrame(rows, STRATEGY)
    expected = sorted(evaluate_strategies(bars, strategies).collect())
    for module in (chunks, strategy):
        monkeypatch.setattr(module, "fits_broadcast", lambda *_: False)
    salted, join = [], chunks.join_parameters
    monkeypatch.setattr(strategy, "join_parameters", lambda *args, **more: salted.append(1) or join(*args, **more))
    assert sorted(evaluate_strategies(bars, strategies).collect()) == expected and not salted
    monkeypatch.setattr(strategy, "MANY", 3)
    assert sorted(evaluate_strategies(bars, strategies).collect()) == expected and salted
