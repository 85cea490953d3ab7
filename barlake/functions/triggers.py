"""Threshold predicates on a pair of consecutive observations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The supported directions.
DIRECTIONS = ["above", "below", "cross_above", "cross_below"]


def triggered(direction: Column, previous: Column, current: Column, threshold: Column, mode: str = "edge") -> Column:
    """Does the observation fire a rule of this direction?

    ``edge`` (alerts): above/below fire only when the condition becomes true.
    ``level`` (strategies): above/below fire on every bar that satisfies them.
    The cross directions need a previous observation in both modes.
    """
    if mode not in ("edge", "level"):
        raise ValueError(f"Unknown trigger mode: {mode}")
    high, low = current >= threshold, current <= threshold
    above, below = high, low
    if mode == "edge":
        above = high & ~F.coalesce(previous >= threshold, F.lit(False))
        below = low & ~F.coalesce(previous <= threshold, F.lit(False))
    fires = (
        F.when(direction == "above", above)
        .when(direction == "below", below)
        .when(direction == "cross_above", (previous < threshold) & high)
        .when(direction == "cross_below", (previous > threshold) & low)
    )
    return F.coalesce(fires, F.lit(False))


def valid_direction(direction: Column) -> Column:
    """Pass a known direction through; an unknown one fails the job."""
    message = F.concat(F.lit("No such direction of a rule: "), F.coalesce(direction, F.lit("NULL")))
    return F.when(direction.isin(*DIRECTIONS), direction).otherwise(F.raise_error(message).cast("string"))
