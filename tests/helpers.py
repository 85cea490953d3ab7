"""Small frames in the engine's layouts."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from barlake.schema import BRONZE, SILVER

START = datetime(2024, 5, 1, tzinfo=timezone.utc)


def minute(n: float) -> datetime:
    return START + timedelta(minutes=n)


def millis(moment: datetime) -> int:
    return round(moment.timestamp() * 1000)


def raw_row(at, close, volume="1", trades="1", ingested=None, symbol="AAA", interval="1m", source="landed", open_=None):
    return {
        "exchange": "x", "symbol": symbol, "interval": interval, "open_time": millis(at),
        "open": open_ or close, "high": close, "low": close, "close": close, "volume": volume,
        "close_time": millis(at) + 59_999, "quote_volume": "1", "trade_count": trades,
        "taker_buy_base_volume": "1", "taker_buy_quote_volume": "1", "ignore": "0",
        "load_source": source, "ingested_at": ingested if ingested is not None else at,
    }


def raw_frame(spark, rows):
    return spark.createDataFrame([[row[c] for c in BRONZE.fieldNames()] for row in rows], BRONZE)


def bar_frame(spark, closes, symbol="AAA", interval="1m", step=1, first=0, times=None):
    """Silver bars with the given closes, one per step unless ``times`` (in minutes) says otherwise."""
    rows = []
    for i, close in enumerate(closes):
        at = minute(times[i] if times else first + i * step)
        rows.append(
            ("x", symbol, interval, at, at + timedelta(minutes=step) - timedelta(milliseconds=1), close, close, close,
             close, 1.0, 1.0, 1, 1.0, 1.0, False, "landed", at)
        )
    return spark.createDataFrame(rows, SILVER)


def column(frame, name, order="open_time"):
    return [row[0] for row in frame.orderBy(order).select(name).collect()]


def same_rows(left, right, digits=9):
    def rounded(frame):
        return frame.select(
            *[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in sorted(frame.dtypes)]
        )

    a, b = rounded(left), rounded(right)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
