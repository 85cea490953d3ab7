"""Splitting long series over many tasks.

A window over a whole series puts that series into one task, which fails once a single symbol holds a large
part of the lake. Every ordered operator here therefore works on *chunks*: fixed stretches of time, a whole
number of days each, so that the chunk of a row follows from its own timestamp. What crosses a chunk border is
handed over in one of two exact ways:

* ``with_halo``: the last rows before a chunk are copied into it (bounded look-back, such as rolling means);
* carried state: each chunk is summarised, the small summaries are scanned per series, and the result enters
  the next chunk as one extra *seed* row or through a join on the chunk key (fills, products, latches).

A summary scan sees one row per series and chunk; the calendar bounds that (ten years of minute bars are about
1800 chunks), whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from barlake.functions.intervals import DAY_US, INTERVAL_MINUTES, MINUTE_US, by_interval
from barlake.session import stored

CHUNK = "_chunk"
# 2880 bars are whole days for every interval, and few enough for Spark to hold a chunk in its window buffer
# (spark.sql.windowExec.buffer.in.memory.threshold, 4096 rows) instead of spilling each one.
CHUNK_BARS = 2880
TICK_CHUNK_SECONDS = 3600

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024
# Rows of one key that meet one copy of its parameters where those are too many to broadcast.
PART_ROWS = 100_000


def floor_div(value: Column, width: Column) -> Column:
    return F.call_function("div", value - F.pmod(value, width), width)


def chunk_us(chunk_bars: int = CHUNK_BARS) -> Column:
    """Chunk length in microseconds: at least ``chunk_bars`` bars, rounded up to whole days."""
    days = {code: -(-minutes * MINUTE_US * chunk_bars // DAY_US) for code, minutes in INTERVAL_MINUTES.items()}
    return by_interval({code: count * DAY_US for code, count in days.items()})


def with_bar_chunk(bars: DataFrame, chunk_bars: int = CHUNK_BARS) -> DataFrame:
    """Add the chunk number of each bar; days never straddle two chunks."""
    return bars.withColumn(CHUNK, floor_div(F.unix_micros("open_time"), chunk_us(chunk_bars)))


def with_tick_chunk(ticks: DataFrame, seconds: int = TICK_CHUNK_SECONDS) -> DataFrame:
    return ticks.withColumn(CHUNK, floor_div(F.unix_micros("event_time"), F.lit(seconds * 1_000_000)))


def with_halo(rows: DataFrame, keys: Sequence[str], order: str, depth: int, carry: Sequence[str]) -> DataFrame:
    """Copy into each chunk the ``depth`` rows that precede it in its series.

    The result has a boolean ``_halo``; copied rows fill only keys, order and ``carry``. The look-back counts
    rows, not time, so it is exact across gaps. Only the last ``depth`` rows of each chunk take part: ranking
    keeps them before the shuffle, and the chunks a row must reach are those that start within the next
    ``depth`` of these tail rows.
    """
    newest_first = Window.partitionBy(*keys, CHUNK).orderBy(F.col(order).desc())
    tails = (
        rows.select(*keys, CHUNK, order, *carry)
        .withColumn("_back", F.row_number().over(newest_first))
        .where(F.col("_back") <= depth)
    )
    following = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, depth)
    reached = tails.withColumn("_chunks", F.collect_set(CHUNK).over(following))
    copies = reached.withColumn(
        "_target", F.explode(F.array_except("_chunks", F.array(CHUNK)))
    ).select(*keys, F.col("_target").alias(CHUNK), order, *carry, F.lit(True).alias("_halo"))
    return rows.withColumn("_halo", F.lit(False)).unionByName(copies, allowMissingColumns=True)


def chunk_ends(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, prior: DataFrame | None = None
) -> DataFrame:
    """One row per series and chunk: the ``value`` before the chunk (``_before``) and whether chunks follow."""
    # A plain ordering column keeps the aggregate hash-based; a struct would make Spark sort all rows first.
    by = F.struct(*order) if len(order) > 1 else F.col(order[0])
    ends = rows.groupBy(*keys, CHUNK).agg(F.max_by(value, by).alias("_last"))
    if prior is not None:
        ends = ends.unionByName(prior.select(*keys, F.lit(-(2**62)).alias(CHUNK), F.col(value).alias("_last")))
    along = Window.partitionBy(*keys).orderBy(CHUNK)
    return ends.select(
        *keys, CHUNK,
        F.lag("_last").over(along).alias("_before"),
        F.lead(CHUNK).over(along).isNotNull().alias("_more"),
    )


def with_previous(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, prior: DataFrame | None = None
) -> DataFrame:
    """Add ``name``, the ``value`` of the preceding row of the series, and ``_more``: do later chunks follow?

    ``prior`` (keys + value, one row per series) supplies the row before the first one. Each chunk's last value
    enters the next chunk as a seed row, so only the rows themselves are shuffled once by series and chunk.
    """
    seeds = chunk_ends(rows, keys, order, value, prior).select(
        *keys, CHUNK, F.col("_before").alias(value), "_more", F.lit(True).alias("_seed")
    )
    in_chunk = Window.partitionBy(*keys, CHUNK).orderBy(F.col("_seed").desc(), *order)
    so_far = in_chunk.rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumns({"_seed": F.lit(False), "_more": F.lit(None).cast("boolean")})
        .unionByName(seeds, allowMissingColumns=True)
        .withColumns({name: F.lag(value).over(in_chunk), "_more": F.first("_more").over(so_far)})
        .where(~F.col("_seed"))
        .drop("_seed")
    )


def fits_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a parameter table; stops reading after ``max_rows``."""
    rows, size = (
        small.limit(max_rows + 1)
        .agg(F.count("*"), F.coalesce(F.sum(F.length(F.to_json(F.struct("*")))), F.lit(0)))
        .first()
    )
    return rows <= max_rows and size <= max_bytes


def join_parameters(
    rows: DataFrame,
    parameters: DataFrame,
    on: Sequence[str],
    spread: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Equi-join of many rows with a parameter table (rules, strategies, marks).

    A table measured to be small is broadcast. A larger one is joined by shuffle with hot keys dealt over parts.
    """
    if fits_broadcast(parameters, max_rows):
        return rows.join(F.broadcast(parameters), list(on), how)
    return join_dealt(rows, parameters, on, spread, how, part_rows)


def join_dealt(
    rows: DataFrame, parameters: DataFrame, on: Sequence[str], spread: Sequence[str], how: str = "inner", part_rows: int = PART_ROWS
) -> DataFrame:
    """Equi-join by shuffle. A key with more than ``part_rows`` rows is dealt over parts by a hash of ``spread``, and only the
    parameters of such a key are repeated, once for each part. Neither side is broadcast on Spark's estimate, which takes a
    table by its compressed files and does not see how often rows are repeated."""
    counts = rows.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > part_rows)
    own = [f"_hot_{c}" for c in on]
    hot = counts.select(*[F.col(c).alias(name) for c, name in zip(on, own)], F.ceil(F.col("_n") / part_rows).cast("int").alias("_parts"))
    hot = stored(hot, "hot")
    if hot.isEmpty():
        return rows.join(parameters.hint("merge"), list(on), how)
    hot = F.broadcast(hot) if fits_broadcast(hot) else hot.hint("merge")
    parts = F.coalesce("_parts", F.lit(1))

    def with_parts(frame: DataFrame) -> DataFrame:
        # Null-safe, so that rows without a key, which an outer join keeps, are spread as well.
        return frame.join(hot, [F.col(c).eqNullSafe(F.col(name)) for c, name in zip(on, own)], "left").drop(*own)

    dealt = with_parts(rows).withColumn("_part", F.pmod(F.xxhash64(*spread), parts).cast("int")).drop("_parts")
    repeated = with_parts(parameters).withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return dealt.join(repeated.hint("merge"), [*on, "_part"], how).drop("_part")
