"""Raw klines to clean bars: typing, deduplication and gap filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import TimestampType

from barlake.functions.intervals import step_us
from barlake.functions.scalars import millis_to_time, to_count, to_number, to_utc
from barlake.operators.chunks import CHUNK, CHUNK_BARS, chunk_us, floor_div, join_parameters
from barlake.schema import (
    PRICE_COLUMNS,
    PRIMARY_KEY,
    SERIES,
    SILVER_COLUMNS,
    VOLUME_COLUMNS,
)


def normalize_bars(raw: DataFrame) -> DataFrame:
    """Type the raw columns and bring them into the fixed bar layout (one projection)."""
    typed = {c: to_number(c) for c in [*PRICE_COLUMNS, *VOLUME_COLUMNS]} | {
        "trade_count": to_count("trade_count"),
        "open_time": millis_to_time(F.col("open_time")),
        "close_time": millis_to_time(F.col("close_time")),
        "is_synthetic": F.lit(False),
    }
    if raw.schema["ingested_at"].dataType != TimestampType():
        typed["ingested_at"] = to_utc(F.col("ingested_at"))
    # Columns that pass as they are carry no alias: gap filling reads deduplicated bars twice, and Spark shares the shuffle of
    # both only where their plans are the same to the last alias.
    return raw.select(*[typed[c].alias(c) if c in typed else F.col(c) for c in SILVER_COLUMNS])


def has_series_key(bars: DataFrame) -> DataFrame:
    """Rows that belong to a series; the others are reported by the integrity check."""
    complete = F.lit(True)
    for name in PRIMARY_KEY:
        complete = complete & F.col(name).isNotNull()
    return bars.where(complete)


def rejected_raw_bars(raw: DataFrame, origins: DataFrame | None = None) -> DataFrame:
    """Raw bars that cleaning leaves out, with ``reject_reason``.

    ``origins`` (series key and ``_from``, the first bar) adds the bars off the grid, which gap filling drops.
    """
    keyed = F.lit(True)
    for name in PRIMARY_KEY:
        keyed = keyed & F.col(name).isNotNull()
    reason = F.when(~keyed, "no series key or open time")
    rows = raw
    if origins is not None:
        first = origins.select(*SERIES, F.unix_micros("_from").alias("_origin"))
        rows = join_parameters(rows, first, SERIES, spread=["open_time"], how="left")
        off = F.pmod(F.unix_micros(millis_to_time(F.col("open_time"))) - F.col("_origin"), step_us()) != 0
        reason = reason.when(F.when(keyed, off), "off the grid")
    return rows.withColumn("reject_reason", reason).where(F.col("reject_reason").isNotNull()).select(*raw.columns, "reject_reason")


def latest_revision(bars: DataFrame) -> DataFrame:
    """One row per primary key: the newest ``ingested_at`` (a missing one counts as newest).

    The remaining columns break ties, so the result does not depend on row order. Spark ranks before the
    shuffle as well, so each task sends at most one copy of a bar however often it was delivered.
    """
    others = [c for c in bars.columns if c not in (*PRIMARY_KEY, "ingested_at")]
    newest = Window.partitionBy(*PRIMARY_KEY).orderBy(
        F.col("ingested_at").desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in others]
    )
    return bars.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")


_CARRIED = ("close", "load_source", "ingested_at")


def _chunk_summaries(bars: DataFrame, times: DataFrame) -> DataFrame:
    """Per series and chunk: the values to carry over.

    Bars are summarised by their offset within a step, because the grid starts at the first bar of the series,
    which only the pass over ``times`` (series and time alone) tells.
    """
    by_offset = bars.groupBy(*SERIES, CHUNK, F.pmod("_at", F.col("_step")).alias("_offset")).agg(
        F.first("_step").alias("_step"),
        F.first("_width").alias("_width"),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(f"_last_{c}") for c in _CARRIED],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(f"_first_{c}") for c in _CARRIED[1:]],
    )
    extent = times.groupBy(*SERIES).agg(F.min("_at").alias("_origin"), F.max("_at").alias("_limit"))
    # Null-safe on purpose: a plain "=" would push an IS NOT NULL below the deduplication of this branch
    # only, and Spark could no longer share that shuffle with the bars themselves.
    on_grid = F.col("_offset").eqNullSafe(F.pmod("_origin", F.col("_step")))
    return by_offset.join(extent, SERIES).where(on_grid)


def _seeds(bars: DataFrame, times: DataFrame) -> DataFrame:
    """One row per series and chunk of its span, chunks without any bar included.

    A seed stands on the first grid point of its chunk and holds what was known before the chunk: the last
    close and metadata, or, at the start of a series, the first metadata to come.
    """
    summaries = _chunk_summaries(bars, times)
    in_order = Window.partitionBy(*SERIES).orderBy(CHUNK)
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*SERIES)
    grid_end = F.col("_origin") + floor_div(F.col("_limit") - F.col("_origin"), F.col("_step")) * F.col("_step")
    filled = summaries.select(
        *SERIES, CHUNK, "_step", "_width", "_origin",
        grid_end.alias("_grid_end"),
        F.coalesce(F.lead(CHUNK).over(in_order) - 1, floor_div(grid_end, F.col("_width"))).alias("_until"),
        *[F.last(f"_last_{c}", ignorenulls=True).over(so_far).alias(f"_known_{c}") for c in _CARRIED],
        *[F.min_by(f"_first_{c}", F.when(F.col(f"_first_{c}").isNotNull(), F.col(CHUNK))).over(whole)
          .alias(f"_next_{c}") for c in _CARRIED[1:]],
    )
    entering = filled.select(
        "*",
        *[F.lag(f"_known_{c}").over(in_order).alias(f"_before_{c}") for c in _CARRIED],
    )
    spans = entering.select("*", F.explode(F.sequence(CHUNK, "_until")).alias("_here"))
    chunk_start = F.col("_here") * F.col("_width")
    to_grid = F.pmod(F.col("_origin") - chunk_start, F.col("_step"))
    last_in_chunk = chunk_start + to_grid + floor_div(
        F.col("_width") - 1 - to_grid, F.col("_step")
    ) * F.col("_step")

    def known(column: str) -> F.Column:
        return F.when(F.col("_here") == F.col(CHUNK), F.col(f"_before_{column}")).otherwise(F.col(f"_known_{column}"))

    return spans.select(
        *SERIES,
        F.col("_here").alias(CHUNK),
        "_step", "_width", "_origin",
        F.greatest(chunk_start + to_grid, F.col("_origin")).alias("_at"),
        F.least(last_in_chunk, F.col("_grid_end")).alias("_end"),
        known("close").alias("close"),
        *[F.coalesce(known(c), F.col(f"_next_{c}")).alias(c) for c in _CARRIED[1:]],
        F.lit(True).alias("_seed"),
    )


def fill_missing_bars(
    bars: DataFrame, enabled: bool = True, chunk_bars: int = CHUNK_BARS, times: DataFrame | None = None
) -> DataFrame:
    """Put every series on a dense grid from its first to its last bar.

    A missing bar repeats the last known close as open/high/low/close, has zero volumes and counts and is
    flagged synthetic; metadata is filled forward, then backward. Bars off the grid drop out. No time spine is
    joined: each bar is exploded up to the next one. Chunks are filled independently from their seed row, so a
    long gap is spread over the chunks it covers. ``times`` may name a cheaper frame with the same series and
    open times, such as the bars before deduplication.
    """
    if not enabled:
        return bars.select(*SILVER_COLUMNS)
    keyed = (
        bars.select(*SILVER_COLUMNS)
        .withColumn("_at", F.unix_micros("open_time"))
        .withColumn("_step", step_us())
        .withColumn("_width", chunk_us(chunk_bars))
        .withColumn(CHUNK, floor_div(F.col("_at"), F.col("_width")))
    )
    moments = (times or bars).select(*SERIES, F.unix_micros("open_time").alias("_at"))
    rows = keyed.withColumn("_seed", F.lit(False)).unionByName(_seeds(keyed, moments), allowMissingColumns=True)
    in_order = Window.partitionBy(*SERIES, CHUNK).orderBy(F.col("_seed").desc(), "_at")
    so_far = in_order.rowsBetween(Window.unboundedPreceding, 0)
    gridded = rows.select(
        "*",
        F.first("_origin", ignorenulls=True).over(so_far).alias("_grid"),
        F.first("_end", ignorenulls=True).over(so_far).alias("_stop"),
    ).where(F.pmod(F.col("_at") - F.col("_grid"), F.col("_step")) == 0)
    known = gridded.select(
        "*",
        F.lead("_at").over(in_order).alias("_next"),
        F.last("close", ignorenulls=True).over(so_far).alias("_close"),
        F.last("load_source", ignorenulls=True).over(so_far).alias("_load_source"),
        F.last("ingested_at", ignorenulls=True).over(so_far).alias("_ingested_at"),
    )
    upto = F.coalesce(F.col("_next") - F.col("_step"), F.col("_stop"))
    points = F.when(upto >= F.col("_at"), F.sequence(F.col("_at"), upto, F.col("_step")))
    dense = known.withColumn("_point", F.explode(points))
    real = ~F.col("_seed") & (F.col("_point") == F.col("_at"))
    out = {c: F.col(c) for c in SERIES}
    out["open_time"] = F.timestamp_micros("_point")
    closing = F.timestamp_micros(F.col("_point") + F.col("_step") - 1000)
    out["close_time"] = F.when(real, F.col("close_time")).otherwise(closing)
    out |= {c: F.when(real, F.col(c)).otherwise(F.col("_close")) for c in PRICE_COLUMNS}
    out |= {c: F.when(real, F.col(c)).otherwise(F.lit(0.0)) for c in VOLUME_COLUMNS}
    out["trade_count"] = F.when(real, F.col("trade_count")).otherwise(F.lit(0).cast("bigint"))
    out["is_synthetic"] = ~real
    out["load_source"] = F.col("_load_source")
    out["ingested_at"] = F.col("_ingested_at")
    return dense.select(*[out[c].alias(c) for c in SILVER_COLUMNS])


def clean_bars(raw: DataFrame, fill: bool = True, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Raw klines to silver: normalize, keep the latest revision of each bar, fill gaps."""
    typed = has_series_key(normalize_bars(raw))
    return fill_missing_bars(latest_revision(typed), fill, chunk_bars, times=typed)
