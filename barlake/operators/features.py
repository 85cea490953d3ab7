"""Returns, moving averages and rolling volatility per series.

Rolling values are built from lags instead of sliding frames: Spark evaluates a sliding frame from scratch for every
row, so a 50-bar mean costs 50 updates per bar. Here a short block (the common divisor of the requested windows, five
bars by default) is summed once from its lags and longer windows add up lagged blocks. A NULL close or a
window that reaches before the first bar makes the sum NULL, which is the rule for incomplete windows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from barlake.functions.scalars import ratio_change
from barlake.operators.chunks import CHUNK, CHUNK_BARS, with_bar_chunk, with_halo
from barlake.schema import FEATURE_COLUMNS, GOLD_COLUMNS, SERIES

# The default look-backs in bars.
RETURN_WINDOWS = (1, 5, 20)
AVERAGE_WINDOWS = (5, 20, 50)
VOLATILITY_WINDOWS = (5, 20)

LONGEST_LAG_SUM = 64

Columns = dict[str, Column]
Stage = Callable[[WindowSpec], Columns]


def _total(columns: Sequence[Column]) -> Column:
    return reduce(add, columns)


def _block(windows: Sequence[int]) -> int | None:
    """Bars per block, or None where adding up lagged blocks would take too many terms."""
    block = math.gcd(*windows)
    return block if block + max(windows) // block <= LONGEST_LAG_SUM else None


def _back(n: int) -> Column:
    return F.col("close") if n == 0 else F.col(f"_back_{n}")


def _backs(offsets: Sequence[int]) -> Stage:
    """Earlier closes, one lag each."""
    return lambda w: {f"_back_{n}": F.lag("close", n).over(w) for n in sorted(set(offsets)) if n > 0}


def _blocks(column: str, block: int, window: int, w: WindowSpec) -> list[Column]:
    later = [F.lag(column, k).over(w) for k in range(block, window, block)]
    return [F.col(column), *later]


def _idle(w: WindowSpec) -> Columns:
    return {}


class _Returns:
    def __init__(self, windows: Sequence[int]):
        self.windows = windows
        self.offsets = [*windows, 1]

    def stages(self) -> list[Stage]:
        def returns(w: WindowSpec) -> Columns:
            columns = {f"return_{n}": ratio_change(F.col("close"), _back(n)) for n in self.windows}
            return columns | {"log_return_1": F.ln("close") - F.ln(_back(1))}

        return [returns]


class _Averages:
    def __init__(self, windows: Sequence[int]):
        self.windows, self.block = windows, _block(windows)
        self.offsets = list(range(self.block)) if self.block else []

    def stages(self) -> list[Stage]:
        def block_sum(w: WindowSpec) -> Columns:
            return {"_sum": _total([_back(k) for k in range(self.block)])}

        def means(w: WindowSpec) -> Columns:
            return {f"ma_{n}": _total(_blocks("_sum", self.block, n, w)) / n for n in self.windows}

        def framed(w: WindowSpec) -> Columns:
            return {f"ma_{n}": _framed(w, "close", n, F.avg) for n in self.windows}

        # Idle stages line the lagged blocks up with those of the volatility, to share one window pass.
        return [block_sum, _idle, _idle, means] if self.block else [framed]


class _Volatility:
    """Blocks keep mean and squared deviations; combining them has no cancellation, unlike sums of squares."""

    def __init__(self, windows: Sequence[int]):
        self.windows, self.block = windows, _block(windows)
        self.offsets = list(range(self.block + 1)) if self.block else [1]

    def stages(self) -> list[Stage]:
        def changes(w: WindowSpec) -> Columns:
            return {f"_change_{k}": ratio_change(_back(k), _back(k + 1)) for k in range(self.block or 1)}

        def block_mean(w: WindowSpec) -> Columns:
            return {"_mean": _total([F.col(f"_change_{k}") for k in range(self.block)]) / self.block}

        def block_spread(w: WindowSpec) -> Columns:
            away = [F.col(f"_change_{k}") - F.col("_mean") for k in range(self.block)]
            return {"_spread": _total([d * d for d in away])}

        def lagged(w: WindowSpec) -> Columns:
            steps = range(self.block, max(self.windows), self.block)
            return {f"{c}_{k}": F.lag(c, k).over(w) for c in ("_mean", "_spread") for k in steps}

        def parts(column: str, n: int) -> list[Column]:
            return [F.col(column), *[F.col(f"{column}_{k}") for k in range(self.block, n, self.block)]]

        def means(w: WindowSpec) -> Columns:
            return {f"_mean_of_{n}": _total(parts("_mean", n)) / (n // self.block) for n in self.windows}

        def deviations(w: WindowSpec) -> Columns:
            out = {}
            for n in self.windows:
                away = [m - F.col(f"_mean_of_{n}") for m in parts("_mean", n)]
                spread = _total(parts("_spread", n)) + _total([d * d for d in away]) * self.block
                out[f"vol_{n}"] = F.sqrt(spread / n)
            return out

        def framed(w: WindowSpec) -> Columns:
            return {f"vol_{n}": _framed(w, "_change_0", n, F.stddev_pop) for n in self.windows}

        if self.block:
            return [changes, block_mean, block_spread, lagged, means, deviations]
        return [changes, framed]


def _framed(w: WindowSpec, value: str, n: int, aggregate: Callable[[str], Column]) -> Column:
    """Rolling aggregate over a frame, for windows too long for lag sums."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(value).over(frame) == n, aggregate(value).over(frame))


def _over_series(
    bars: DataFrame, depth: int, chunk_bars: int, groups: Sequence[_Returns | _Averages | _Volatility]
) -> DataFrame:
    """Evaluate feature groups along every series: one shuffle, one sort.

    ``depth`` preceding bars are copied into each chunk, enough for the deepest look-back. The n-th stages of all
    groups are evaluated together.
    """
    rows = with_halo(with_bar_chunk(bars, chunk_bars), SERIES, "open_time", depth, ["close"])
    w = Window.partitionBy(*SERIES, CHUNK).orderBy("open_time")
    kept = set(rows.columns)
    rows = rows.withColumns(_backs([n for group in groups for n in group.offsets])(w))
    staged = [group.stages() for group in groups]
    results = []
    for level in range(max(len(stages) for stages in staged)):
        columns: Columns = {}
        for stages in staged:
            if level < len(stages):
                columns |= stages[level](w)
        results += [name for name in columns if not name.startswith("_")]
        rows = rows.withColumns(columns) if columns else rows
    kept_names = [c for c in rows.columns if c in kept and c not in ("_halo", CHUNK)]
    return rows.where(~F.col("_halo")).select(*kept_names, *[c for c in results if c not in kept_names])


def add_returns(bars: DataFrame, windows: Sequence[int] | None = None, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """``return_n`` for each window and the one-bar log return."""
    windows = windows or RETURN_WINDOWS
    return _over_series(bars, max(windows), chunk_bars, [_Returns(windows)])


def add_moving_averages(
    bars: DataFrame, windows: Sequence[int] | None = None, chunk_bars: int = CHUNK_BARS
) -> DataFrame:
    """``ma_n``: mean close of the last n bars, NULL while fewer than n are known."""
    windows = windows or AVERAGE_WINDOWS
    return _over_series(bars, max(windows), chunk_bars, [_Averages(windows)])


def add_volatility(bars: DataFrame, windows: Sequence[int] | None = None, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """``vol_n``: population deviation of the last n one-bar returns, NULL while fewer are known."""
    windows = windows or VOLATILITY_WINDOWS
    return _over_series(bars, max(windows), chunk_bars, [_Volatility(windows)])


def feature_frame(bars: DataFrame, chunk_bars: int = CHUNK_BARS, keep: Sequence[str] = ()) -> DataFrame:
    """All default features in the serving layout, from a single pass over each chunk.

    ``keep`` names further columns of ``bars`` to pass through.
    """
    groups = [_Returns(RETURN_WINDOWS), _Averages(AVERAGE_WINDOWS), _Volatility(VOLATILITY_WINDOWS)]
    depth = max(*RETURN_WINDOWS, *AVERAGE_WINDOWS, *VOLATILITY_WINDOWS)
    return serving_columns(_over_series(bars, depth, chunk_bars, groups), keep)


def serving_columns(frame: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Project the serving layout; a feature the frame lacks becomes NULL."""
    absent = [c for c in FEATURE_COLUMNS if c not in frame.columns]
    return frame.withColumns({c: F.lit(None).cast("double") for c in absent}).select(*GOLD_COLUMNS, *keep)
