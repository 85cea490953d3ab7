"""Long/flat threshold strategies as window computations over many series and parameter sets.

Per bar, an entry and an exit trigger drive a latch. The latch has a closed form over running windows, and a whole
chunk of bars is a function of the position it is entered with (0 or 1). Chunks are therefore evaluated for
both entering positions, and the small per-chunk results are chained per series and strategy. Per-bar results take a second
pass over the same chunks, which writes the bars with the position, equity and peak they really start from. Metrics do
not: a chunk's summary holds its moments, trades, growth and worst dip, which combine along the chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from barlake.functions.intervals import periods_per_year
from barlake.functions.scalars import null_if_nan, ratio_change
from barlake.functions.triggers import triggered, valid_direction
from barlake.operators.chunks import CHUNK, CHUNK_BARS, fits_broadcast, join_parameters, with_bar_chunk, with_previous
from barlake.schema import SERIES, STRATEGY
from barlake.session import stored

# The default starting capital and cost per position change in basis points.
INITIAL_CAPITAL = 100_000.0
TRANSACTION_COST_BPS = 5.0

RESULT_COLUMNS = [
    "strategy_id", "initial_capital", "target_position", "position", "asset_return", "turnover",
    "transaction_cost", "strategy_return", "equity_curve", "drawdown",
]

# Strategies of one symbol that a task may meet with a whole chunk.
MANY = 1000

_HOLD, _ENTER, _LEAVE, _TOGGLE = 0, 1, 2, 3
_KEYS = [*SERIES, CHUNK, "strategy_id"]


def crossing_strategies(
    series: DataFrame,
    entry_threshold: float | Column,
    exit_threshold: float | Column,
    initial_capital: float = INITIAL_CAPITAL,
    transaction_cost_bps: float = TRANSACTION_COST_BPS,
) -> DataFrame:
    """One strategy per (symbol, interval) row: enter on crossing above, leave on crossing below."""
    name = F.lower("symbol")
    return series.select("symbol", "interval").distinct().select(
        F.concat(name, F.lit("_entry"), F.lit("/"), name, F.lit("_exit")).alias("strategy_id"),
        "symbol", "interval",
        F.lit("cross_above").alias("entry_direction"),
        (entry_threshold if isinstance(entry_threshold, Column) else F.lit(float(entry_threshold)))
        .alias("entry_threshold"),
        F.lit("cross_below").alias("exit_direction"),
        (exit_threshold if isinstance(exit_threshold, Column) else F.lit(float(exit_threshold)))
        .alias("exit_threshold"),
        F.lit(float(initial_capital)).alias("initial_capital"),
        F.lit(float(transaction_cost_bps)).alias("transaction_cost_bps"),
    )


def _running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def _earlier(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _signal(enter: Column, leave: Column) -> Column:
    return (enter.cast("tinyint") + leave.cast("tinyint") * F.lit(2).cast("tinyint")).cast("tinyint")


def _latch(rows: DataFrame, w: WindowSpec, toggling: bool) -> DataFrame:
    """From ``_signal`` add what the position after each row (``_now``) and before it (``_old``) depends on.

    Enter forces 1, leave forces 0, both together toggle, neither holds. With the last forced position and the
    toggles since, the position is ``(coalesce(forced, entering position) + toggles) % 2``. A forced position is
    kept together with the toggles counted up to it, as ``2 * toggles + position``. Without toggling signals the
    count, and the window pass for it, is left out.
    """
    signal, zero = F.col("_signal"), F.lit(0).cast("bigint")
    if toggling:
        toggle = (signal == _TOGGLE).cast("bigint")
        rows = rows.withColumn("_toggles", F.sum(toggle).over(_running(w)))
    else:
        rows = rows.withColumn("_toggles", zero)
    forced = F.when(signal.isin(_ENTER, _LEAVE), F.col("_toggles") * 2 + (signal == _ENTER).cast("bigint"))
    return rows.withColumn("_forced", forced).withColumns(
        {
            "_now": F.last("_forced", ignorenulls=True).over(_running(w)),
            "_old": F.last("_forced", ignorenulls=True).over(_earlier(w)),
            "_toggles_old": F.coalesce(F.lag("_toggles").over(w), zero) if toggling else zero,
        }
    ).drop("_forced")


def _position(state: str, toggles: str, entering: Column) -> Column:
    """Position from a packed state; toggles before it and toggles now differ by those since."""
    known = F.col(state)
    start = F.coalesce(known % 2, entering)
    since = F.col(toggles) - F.coalesce(F.call_function("div", known, F.lit(2)), F.lit(0))
    return F.pmod(start + since, F.lit(2)).cast("double")


def _after(entering: Column) -> Column:
    return _position("_now", "_toggles", entering)


def _before(entering: Column) -> Column:
    return _position("_old", "_toggles_old", entering)


def _with_signals(rows: DataFrame) -> DataFrame:
    """Reduce the triggers of a bar to one small number before rows are sorted; parameters are dropped."""

    def fires(side: str) -> Column:
        direction, level = F.col(f"{side}_direction"), F.col(f"{side}_threshold")
        return triggered(direction, F.col("_previous"), F.col("close"), level, mode="level")

    change = F.coalesce(ratio_change(F.col("close"), F.col("_previous")), F.lit(0.0))
    reduced = rows.withColumns(
        {
            "_signal": _signal(fires("entry"), fires("exit")),
            "asset_return": change,
            "_fee": F.col("transaction_cost_bps") / F.lit(10_000.0),
        }
    )
    used = ("entry_direction", "entry_threshold", "exit_direction", "exit_threshold", "transaction_cost_bps", "_previous")
    return reduced.drop(*used)


def _with_strategies(rows: DataFrame, strategies: DataFrame, chunks: DataFrame | None = None) -> DataFrame:
    """Rows with each of the strategies of their symbol and interval.

    ``chunks`` names the distinct chunks of rows that lie together by series and chunk already. Where the strategies are too
    many to broadcast, they are brought to the chunks, and the rows are neither shuffled again nor the strategies
    repeated. Only symbols with more than ``MANY`` strategies are spread, so that no chunk meets them all in one task.
    """
    on = ["symbol", "interval"]
    if fits_broadcast(strategies):
        return rows.join(F.broadcast(strategies), on)
    many = strategies.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > MANY).select(*on)
    none = many.isEmpty()
    few = strategies if none else strategies.join(many, on, "left_anti")
    met = rows.join(few, on) if chunks is None else rows.join(chunks.join(few, on), [*SERIES, CHUNK])
    if none:
        return met
    return met.unionByName(join_parameters(rows, strategies.join(many, on, "left_semi"), on, spread=["exchange", CHUNK]))


def _chunk_outcomes(
    bars: DataFrame, chunks: DataFrame, strategies: DataFrame, toggling: bool, measured: bool = False
) -> DataFrame:
    """Per chunk and strategy, for both entering positions: final position, growth and growth extremes.

    With ``measured`` also bars, trades, mean and squared deviations of the returns, the extremes of a bar's gain, and the
    lowest growth relative to the highest before it within the chunk.
    """
    w = Window.partitionBy(*_KEYS).orderBy("open_time")
    joined = _with_strategies(bars.drop("_more"), strategies, chunks)
    slim = _with_signals(joined).select(*_KEYS, "open_time", "_signal", "asset_return", "_fee")
    rows = _latch(slim, w, toggling)
    moves, gains, growths, tops, aggregates = {}, {}, {}, {}, [F.count("*").alias("_bars")] if measured else []
    for entering in (0, 1):
        start, growth, change = F.lit(entering), f"_growth{entering}", F.col(f"_return{entering}")
        held, target = _before(start), _after(start)
        moves[f"_moved{entering}"] = F.abs(target - held)
        gains[f"_return{entering}"] = held * F.col("asset_return") - F.col(f"_moved{entering}") * F.col("_fee")
        growths[growth] = F.product(F.lit(1.0) + change).over(_running(w))
        aggregates += [
            F.max_by(target, "open_time").alias(f"_out{entering}"),
            F.max_by(growth, "open_time").alias(f"_end{entering}"),
            F.max(growth).alias(f"_high{entering}"),
            F.min(growth).alias(f"_low{entering}"),
        ]
        if measured:
            tops[f"_top{entering}"] = F.max(growth).over(_running(w))
            aggregates += [
                F.avg(change).alias(f"_mean{entering}"),
                (F.var_pop(change) * F.count("*")).alias(f"_square{entering}"),
                F.count_if(F.col(f"_moved{entering}") > 0).alias(f"_trades{entering}"),
                F.min(change).alias(f"_worst{entering}"),
                F.max(change).alias(f"_best{entering}"),
                F.min(F.try_divide(F.col(growth), F.col(f"_top{entering}"))).alias(f"_dip{entering}"),
            ]
    return rows.withColumns(moves).withColumns(gains).withColumns(growths).withColumns(tops).groupBy(*_KEYS).agg(*aggregates)


def _actual(name: str) -> Column:
    """The one of a chunk's two outcomes that belongs to the position it is entered with."""
    return F.when(F.col("_start_position") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))


def _chained(chunks: DataFrame) -> DataFrame:
    """Chunk outcomes with the position, growth and peak that each chunk starts from."""
    w = Window.partitionBy(*SERIES, "strategy_id").orderBy(CHUNK)
    # A chunk's outcome pair acts on the position exactly as a bar's triggers do.
    signal = _signal(F.coalesce(F.col("_out0") == 1, F.lit(False)), F.coalesce(F.col("_out1") == 0, F.lit(False)))
    chained = _latch(chunks.withColumn("_signal", signal), w, toggling=True)
    chained = chained.withColumn("_start_position", _before(F.lit(0)).cast("bigint"))
    grown = chained.withColumn("_start_growth", F.coalesce(F.product(_actual("_end")).over(_earlier(w)), F.lit(1.0)))
    top = F.greatest(F.col("_start_growth") * _actual("_high"), F.col("_start_growth") * _actual("_low"))
    return grown.withColumn("_start_peak", F.max(top).over(_earlier(w)))


def _chunk_starts(chunks: DataFrame, outcomes: DataFrame, strategies: DataFrame) -> DataFrame:
    """Every chunk with each of its strategies and the position, growth and peak it starts from.

    The last chunk of a series needs no outcome: no other chunk depends on it.
    """
    every = _with_strategies(chunks, strategies)
    parameters = [c for c in strategies.columns if c not in ("symbol", "interval", "strategy_id")]
    return _chained(every.join(outcomes, _KEYS, "left")).select(*_KEYS, *parameters, "_start_position", "_start_growth", "_start_peak")


def _may_toggle(strategies: DataFrame) -> bool:
    """Can entry and exit fire on the same bar? Crossing upwards and downwards cannot."""
    pair = F.struct("entry_direction", "exit_direction")
    opposite = [F.struct(F.lit(a), F.lit(b)) for a, b in (("cross_above", "cross_below"), ("cross_below", "cross_above"))]
    return not strategies.where(~pair.isin(*opposite)).isEmpty()


def _checked(strategies: DataFrame) -> DataFrame:
    directions = {c: valid_direction(F.col(c)) for c in ("entry_direction", "exit_direction")}
    return strategies.select(STRATEGY.fieldNames()).withColumns(directions)


def _keyed(gold: DataFrame, chunk_bars: int) -> DataFrame:
    """Bars that have a series, a time and a known interval, with their chunk."""
    present = F.col("open_time").isNotNull()
    for name in SERIES:
        present = present & F.col(name).isNotNull()
    return with_bar_chunk(gold.where(present), chunk_bars).where(F.col(CHUNK).isNotNull())


def strategy_bars(gold: DataFrame, strategies: DataFrame, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Per bar and strategy: position, returns, costs, equity curve and drawdown.

    ``strategies`` has the STRATEGY schema and applies to every series of its symbol and interval.
    """
    checked, toggling = _checked(strategies), _may_toggle(strategies)
    keyed = _keyed(gold, chunk_bars)
    slim = keyed.select(*SERIES, CHUNK, "open_time", "close")
    leading = with_previous(slim, SERIES, ["open_time"], "close", "_previous").where("_more")
    chunks = slim.select(*SERIES, CHUNK).distinct()
    outcomes = _chunk_outcomes(leading, chunks, checked, toggling)
    starts = _chunk_starts(chunks, outcomes, checked)
    wide = with_previous(keyed, SERIES, ["open_time"], "close", "_previous").drop("_more")
    w = Window.partitionBy(*_KEYS).orderBy("open_time")
    rows = _latch(_with_signals(wide.join(starts, [*SERIES, CHUNK])), w, toggling)
    entering = F.col("_start_position")
    rows = rows.withColumns({"target_position": _after(entering), "position": _before(entering)})
    rows = rows.withColumn("turnover", F.abs(F.col("target_position") - F.col("position")))
    rows = rows.withColumn("transaction_cost", F.col("turnover") * F.col("_fee"))
    rows = rows.withColumn(
        "strategy_return", F.col("position") * F.col("asset_return") - F.col("transaction_cost")
    )
    growth = F.col("_start_growth") * F.product(F.lit(1.0) + F.col("strategy_return")).over(_running(w))
    rows = rows.withColumn("_growth", growth)
    peak = F.greatest(F.col("_start_peak"), F.max("_growth").over(_running(w)))
    rows = rows.withColumn("drawdown", F.try_divide(F.col("_growth"), peak) - F.lit(1.0))
    rows = rows.withColumn("equity_curve", F.col("initial_capital") * F.col("_growth"))
    return rows.select(*gold.columns, *RESULT_COLUMNS)


def strategy_metrics(bars: DataFrame) -> DataFrame:
    """Performance of each series and strategy from its per-bar result."""
    return _performance(
        bars.groupBy(*SERIES, "strategy_id").agg(
            F.count("*").alias("bar_count"),
            F.max_by(F.col("equity_curve") / F.col("initial_capital"), "open_time").alias("_ratio"),
            F.avg("strategy_return").alias("_mean"),
            F.stddev_pop("strategy_return").alias("_volatility"),
            F.min("drawdown").alias("max_drawdown"),
            F.count_if(F.col("turnover") > 0).alias("trade_count"),
        )
    )


def _performance(totals: DataFrame) -> DataFrame:
    ratio, volatility, scale = F.col("_ratio"), F.col("_volatility"), F.sqrt(F.col("_periods"))
    return totals.withColumn("_periods", periods_per_year()).select(
        *SERIES, "strategy_id", "bar_count",
        (ratio - 1.0).alias("total_return"),
        null_if_nan(F.pow(ratio, F.col("_periods") / F.col("bar_count")) - 1.0).alias("annualized_return"),
        (volatility * scale).alias("annualized_volatility"),
        F.when(volatility == 0, F.lit(0.0)).otherwise(F.col("_mean") / volatility * scale).alias("sharpe_ratio"),
        "max_drawdown", "trade_count",
    )


def chunk_metrics(outcomes: DataFrame) -> DataFrame:
    """Performance of each series and strategy from measured chunk outcomes, without looking at bars again.

    Returns combine by counts, means and squared deviations. While growth is positive, a bar's drawdown is the lower of the
    one within its chunk and the one from the peak the chunk starts with, so the worst of each is enough.
    """
    whole = Window.partitionBy(*SERIES, "strategy_id")
    overall = F.sum(F.col("_bars") * _actual("_mean")).over(whole) / F.sum("_bars").over(whole)
    dip = F.least(_actual("_dip"), F.try_divide(F.col("_start_growth") * _actual("_low"), F.col("_start_peak")))
    apart = _actual("_square") + F.col("_bars") * F.pow(_actual("_mean") - F.col("_overall"), 2)
    chunks = _chained(outcomes).withColumn("_overall", overall)
    return _performance(
        chunks.groupBy(*SERIES, "strategy_id").agg(
            F.sum("_bars").alias("bar_count"),
            F.max_by(F.col("_start_growth") * _actual("_end"), CHUNK).alias("_ratio"),
            F.max("_overall").alias("_mean"),
            F.sqrt(F.sum(apart) / F.sum("_bars")).alias("_volatility"),
            (F.min(dip) - 1.0).alias("max_drawdown"),
            F.sum(_actual("_trades")).alias("trade_count"),
        )
    )


def evaluate_strategies(gold: DataFrame, strategies: DataFrame, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Metrics per series and strategy in one pass over the bars; only series, time and close are read from ``gold``.

    Where a bar may lose everything or more, growth does not stay positive and drawdowns do not combine; those series
    and strategies are evaluated bar by bar. Raises if there are no bars, or if a strategy id occurs twice for a symbol and
    interval.
    """
    narrow = require_bars(gold.select(*SERIES, "open_time", "close"))
    twice = strategies.groupBy("symbol", "interval", "strategy_id").agg(F.count("*").alias("_n")).where("_n > 1").limit(3).collect()
    if twice:
        raise ValueError(f"Strategy ids occur more than once: {[tuple(row)[:3] for row in twice]}")
    keyed = _keyed(narrow, chunk_bars).select(*SERIES, CHUNK, "open_time", "close")
    bars = with_previous(keyed, SERIES, ["open_time"], "close", "_previous")
    chunks = keyed.select(*SERIES, CHUNK).distinct()
    outcomes = stored(_chunk_outcomes(bars, chunks, _checked(strategies), _may_toggle(strategies), measured=True), "strategy-chunks")
    # NaN compares as larger than any number, so it counts as unsafe too.
    safe = " AND ".join(f"_worst{i} > -1 AND _best{i} < 1e100 AND _end{i} > 0 AND _low{i} > 0 AND _high{i} < 1e300" for i in (0, 1))
    key = [*SERIES, "strategy_id"]
    unsafe = outcomes.where(f"NOT coalesce({safe}, false)").select(*key).distinct()
    if unsafe.isEmpty():
        return chunk_metrics(outcomes)
    own = strategies.join(unsafe.select("symbol", "interval", "strategy_id").distinct(), ["symbol", "interval", "strategy_id"], "left_semi")
    exact = strategy_metrics(strategy_bars(narrow.join(unsafe, SERIES, "left_semi"), own, chunk_bars)).join(unsafe, key, "left_semi")
    return chunk_metrics(outcomes.join(unsafe, key, "left_anti")).unionByName(exact)


def require_bars(gold: DataFrame) -> DataFrame:
    """A strategy run on no bars at all is an error."""
    if gold.isEmpty():
        raise ValueError("Strategy input has no bars")
    return gold
