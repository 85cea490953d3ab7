"""Landed kline payloads as raw bars."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from barlake.functions.scalars import to_utc, utc_literal
from barlake.operators.cleaning import latest_revision
from barlake.operators.reports import recent_bars
from barlake.schema import BRONZE, KLINE_FIELDS, SERIES

# Default exchange and source label of landed payloads.
EXCHANGE = "binance"
LOAD_SOURCE = "binance_rest_api"

PAYLOAD_ROW = "array<array<string>>"


def raw_bars_from_payloads(
    pages: DataFrame,
    exchange: str = EXCHANGE,
    load_source: str = LOAD_SOURCE,
    payload: str = "payload",
    strict: bool = False,
) -> DataFrame:
    """One raw bar per 12-element array of each landed page.

    Unreadable pages give no bars (see ``rejected_pages``), or fail the job if ``strict``. Unreadable times are NULL
    (see ``undated``).
    ``pages`` has ``symbol``, ``interval``, the JSON text and, optionally, ``exchange``, ``load_source`` and
    ``ingested_at`` (when the page was fetched; otherwise the time of this job).
    """

    def given(name: str, default: Column) -> Column:
        return F.col(name) if name in pages.columns else default

    bars = pages.select(
        given("exchange", F.lit(exchange)).alias("exchange"),
        "symbol",
        "interval",
        F.explode(_readable(payload, strict)).alias("_bar"),
        given("load_source", F.lit(load_source)).alias("load_source"),
        given("ingested_at", F.current_timestamp()).alias("ingested_at"),
    )
    fields = {name: F.get("_bar", F.lit(i)) for i, name in enumerate(KLINE_FIELDS)}
    out = {c: F.col(c) for c in (*SERIES, "load_source")} | {"ingested_at": to_utc(F.col("ingested_at"))}
    out |= {name: value.try_cast(BRONZE[name].dataType) for name, value in fields.items()}
    return bars.select(*[out[c].alias(c) for c in BRONZE.fieldNames()])


def _page_reason(payload: str) -> Column:
    text = F.col(payload)
    # from_json gives NULL for text that is not an array of arrays.
    return F.when(text.isNull(), "no payload").when(F.from_json(text, PAYLOAD_ROW).isNull(), "payload is not an array of bars")


def _readable(payload: str, strict: bool) -> Column:
    rows = F.from_json(F.col(payload), PAYLOAD_ROW)
    if not strict:
        return rows
    reason = _page_reason(payload)
    return F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit("Unreadable page: "), reason)).cast(PAYLOAD_ROW)).otherwise(rows)


def rejected_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """The pages that give no bars, with ``reject_reason``; an empty array is a readable page."""
    return pages.withColumn("reject_reason", _page_reason(payload)).where(F.col("reject_reason").isNotNull())


def read_payloads(spark: SparkSession, path: str, **labels: str) -> DataFrame:
    """Raw bars of all pages landed under ``path`` as JSON lines (symbol, interval, payload, ingested_at)."""
    schema = "exchange string, symbol string, interval string, load_source string, ingested_at string, payload string"
    pages = spark.read.schema(schema).json(path)
    return raw_bars_from_payloads(pages, **labels)


def of_series(
    frame: DataFrame, exchange: str | None = None, symbol: str | None = None, interval: str | None = None
) -> DataFrame:
    """Equality filter on any part of the series key."""
    for name, value in (("exchange", exchange), ("symbol", symbol), ("interval", interval)):
        if value is not None:
            frame = frame.where(F.col(name) == value)
    return frame


def extract_window(raw: DataFrame, start: datetime | str, end: datetime | str) -> DataFrame:
    """Raw bars that open in the inclusive window; compares the stored epoch-ms so the scan can skip files."""
    low, high = F.unix_micros(utc_literal(start)), F.unix_micros(utc_literal(end))
    # Bars open on whole milliseconds: round the lower bound up and the upper bound down.
    return raw.where(
        F.col("open_time").between(F.ceil(low / 1000).cast("bigint"), F.floor(high / 1000).cast("bigint"))
    )


def undated(raw: DataFrame) -> DataFrame:
    """Raw bars without a readable open time. They belong to no window, so loads report them instead of leaving them out."""
    return raw.where(F.col("open_time").isNull())


def extract_recent(raw: DataFrame, count: int = 5) -> DataFrame:
    """The newest ``count`` bars of each series, each in its latest revision."""
    return recent_bars(latest_revision(raw.where(F.col("open_time").isNotNull())), count)


def missing_path(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"
