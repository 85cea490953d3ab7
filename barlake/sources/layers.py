"""Lakehouse layers and the serving table as partitioned Parquet."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T
from pyspark.sql.utils import AnalysisException

from barlake.functions.scalars import null_if_nan, utc_literal
from barlake.operators.chunks import fits_broadcast
from barlake.schema import GOLD, LAYERS, PRIMARY_KEY, SERIES, SERVING
from barlake.session import stored
from barlake.sources.klines import missing_path, of_series

SERIES_LAYOUT = (*SERIES, "date")
"""One folder per series and day: the layout other readers of the lake expect."""
DAY_LAYOUT = ("interval", "date")
"""One folder per interval and day, for lakes with very many symbols; files are sorted by series."""


def open_moment(layer: str) -> Column:
    """Open time as a timestamp; bronze stores epoch milliseconds."""
    return F.timestamp_millis("open_time") if layer == "bronze" else F.col("open_time")


def layer_path(root: str, layer: str) -> str:
    if layer not in LAYERS:
        raise ValueError(f"Unknown layer: {layer}")
    return f"{root.rstrip('/')}/{layer}"


def read_layer(spark: SparkSession, root: str, layer: str, **series: str | None) -> DataFrame:
    """A layer with its ``date``; a layer that was never written is an empty typed frame.

    With a whole series key only that series' folder is listed, where the layer has one.
    """
    schema = T.StructType([*LAYERS[layer].fields, T.StructField("date", T.DateType())])
    base = layer_path(root, layer)
    values = [series.get(c) for c in SERIES]
    paths = [base]
    # Folder names of other characters are escaped by the writer; such series are found by listing.
    if all(value and re.fullmatch(r"[\w.-]+", value) for value in values):
        paths.insert(0, "/".join([base, *(f"{c}={v}" for c, v in zip(SERIES, values, strict=True))]))
    for path in paths:
        try:
            return of_series(spark.read.schema(schema).option("basePath", base).parquet(path), **series)
        except AnalysisException as error:
            if not missing_path(error):
                raise
    return spark.createDataFrame([], schema)


def read_window(
    spark: SparkSession,
    root: str,
    layer: str,
    start: datetime | str,
    end: datetime | str,
    exchange: str | None = None,
    symbol: str | None = None,
    interval: str | None = None,
) -> DataFrame:
    """Rows of a layer that open in the inclusive window.

    Series and date predicates prune folders, the open-time range prunes row groups.
    """
    low, high = utc_literal(start), utc_literal(end)
    rows = read_layer(spark, root, layer, exchange=exchange, symbol=symbol, interval=interval)
    rows = rows.where(F.col("date").between(F.to_date(low), F.to_date(high)))
    if layer == "bronze":
        floor, ceiling = F.ceil(F.unix_micros(low) / 1000), F.floor(F.unix_micros(high) / 1000)
        return rows.where(F.col("open_time").between(floor.cast("bigint"), ceiling.cast("bigint"))).drop("date")
    return rows.where(F.col("open_time").between(low, high)).drop("date")


def _for_writing(frame: DataFrame, layout: Sequence[str]) -> DataFrame:
    """Cluster by target folder: AQE merges small folders into one task and splits big ones, so a hot folder
    is written by many tasks. Rows are sorted for min/max skipping inside each file."""
    order = [c for c in (*layout, *SERIES, "open_time") if c in frame.columns]
    return frame.hint("rebalance", *layout).sortWithinPartitions(*dict.fromkeys(order))


def write_layer(frame: DataFrame, root: str, layer: str, layout: Sequence[str] = SERIES_LAYOUT) -> int:
    """Append rows under their partition folders and return how many were written."""
    counted, observation = observe_rows(frame.withColumn("date", F.to_date(open_moment(layer))))
    _for_writing(counted, layout).write.mode("append").partitionBy(*layout).parquet(layer_path(root, layer))
    return observed_rows(observation)


def observe_rows(frame: DataFrame) -> tuple[DataFrame, Observation]:
    """Count rows as they pass, without a second job."""
    observation = Observation()
    return frame.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def observed_rows(observation: Observation) -> int:
    try:
        return observation.get["rows"]
    except Py4JJavaError:
        # Spark leaves the observation out of a plan it proves to be empty.
        return 0


def merge_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert incoming rows, or replace existing ones with the same primary key.

    Among incoming duplicates the newest ``ingested_at`` wins. One ranking replaces anti-join, deduplication and
    union, and is applied before the shuffle too.
    """
    others = [c for c in existing.columns if c not in (*PRIMARY_KEY, "ingested_at")]
    winner = Window.partitionBy(*PRIMARY_KEY).orderBy(
        F.col("_incoming").desc(), F.col("ingested_at").desc_nulls_first(),
        *[F.col(c).desc_nulls_last() for c in others],
    )
    both = existing.withColumn("_incoming", F.lit(False)).unionByName(incoming.withColumn("_incoming", F.lit(True)))
    return both.withColumn("_rank", F.row_number().over(winner)).where(F.col("_rank") == 1).drop("_rank", "_incoming")


def serving_rows(gold: DataFrame) -> DataFrame:
    """Gold rows as the serving table takes them: NaN as NULL, stamped with the load time."""
    doubles = {f.name for f in GOLD.fields if f.dataType.typeName() == "double"}
    columns = [null_if_nan(F.col(c)).alias(c) if c in doubles else F.col(c) for c in GOLD.fieldNames()]
    return gold.select(*columns, F.current_timestamp().alias("updated_at"))


def upsert_rows(serving: DataFrame, gold: DataFrame) -> DataFrame:
    """The serving table after merging ``gold`` into it."""
    return merge_rows(serving.select(*SERVING.fieldNames()), serving_rows(gold))


def merge_layer(
    spark: SparkSession,
    incoming: DataFrame,
    root: str,
    layer: str,
    layout: Sequence[str] = SERIES_LAYOUT,
    unique: bool = False,
) -> int:
    """Merge rows into a layer by primary key, rewriting only the folders they touch.

    Returns the number of incoming rows. The existing rows of every touched folder are read back first, because
    dynamic overwrite replaces whole folders; the date range narrows the scan to the touched days. ``unique`` says that
    no key comes twice in ``incoming``: rows of folders that hold nothing yet are then written as they are, without ranking.
    """
    # Stored once in the shared folder: the rows are read several times and must not differ between the reads.
    kept = stored(incoming.withColumn("date", F.to_date("open_time")), "merge")
    first, last, rows = kept.agg(F.min("date"), F.max("date"), F.count("*")).first()
    if rows == 0:
        return 0
    touched = kept.select(*layout).distinct()
    present = read_layer(spark, root, layer).where(F.col("date").between(F.lit(first), F.lit(last)))
    existing = present.join(touched, list(layout), "left_semi").select(*kept.columns)
    if unique:
        # Stored before the layer is written, since this write would change the answer.
        held = stored(present.select(*layout).distinct().join(touched, list(layout), "left_semi"), "held")
        held = F.broadcast(held) if fits_broadcast(held) else held.hint("merge")
        merged = kept.join(held, list(layout), "left_anti").select(*kept.columns)
        if not held.isEmpty():
            met = kept.join(held, list(layout), "left_semi").select(*kept.columns)
            merged = merged.unionByName(merge_rows(existing, met))
    else:
        merged = merge_rows(existing, kept)
    (
        _for_writing(merged, layout)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*layout)
        .parquet(layer_path(root, layer))
    )
    return rows


def upsert_serving(
    spark: SparkSession, gold: DataFrame, root: str, layout: Sequence[str] = SERIES_LAYOUT, unique: bool = False
) -> int:
    """Keyed upsert of gold rows into the stored serving table; returns rows attempted. ``unique`` as in ``merge_layer``."""
    return merge_layer(spark, serving_rows(gold), root, "serving", layout, unique)


def write_strategy_csv(bars: DataFrame, path: str) -> None:
    """Per-bar strategy results as CSV with a header."""
    bars.write.mode("overwrite").option("header", True).csv(path)
