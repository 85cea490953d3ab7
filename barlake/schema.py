"""Schemas and column lists of the candle lake."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES = ["exchange", "symbol", "interval"]
PRIMARY_KEY = [*SERIES, "open_time"]

# Positional fields of one kline array, in payload order.
KLINE_FIELDS = [
    "open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume",
    "trade_count", "taker_buy_base_volume", "taker_buy_quote_volume", "ignore",
]
PRICE_COLUMNS = ["open", "high", "low", "close"]
VOLUME_COLUMNS = ["volume", "quote_volume", "taker_buy_base_volume", "taker_buy_quote_volume"]

_S, _D, _L, _TS, _B = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType(), T.BooleanType()


def _struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_TEXT_FIELDS = [f for f in KLINE_FIELDS if f not in ("open_time", "close_time")]

BRONZE = _struct(
    {c: _S for c in SERIES}
    | {c: (_S if c in _TEXT_FIELDS else _L) for c in KLINE_FIELDS}
    | {"load_source": _S, "ingested_at": _TS}
)

SILVER = _struct(
    {c: _S for c in SERIES}
    | {"open_time": _TS, "close_time": _TS}
    | {c: _D for c in PRICE_COLUMNS}
    | {"volume": _D, "quote_volume": _D, "trade_count": _L}
    | {"taker_buy_base_volume": _D, "taker_buy_quote_volume": _D}
    | {"is_synthetic": _B, "load_source": _S, "ingested_at": _TS}
)

# Column names of features, ticks, rules and marks.
FEATURE_COLUMNS = [
    "return_1", "return_5", "return_20", "log_return_1",
    "ma_5", "ma_20", "ma_50", "vol_5", "vol_20",
]
GOLD = T.StructType(SILVER.fields + _struct({c: _D for c in FEATURE_COLUMNS}).fields)
SERVING = T.StructType(GOLD.fields + [T.StructField("updated_at", _TS)])

TICK = _struct({"exchange": _S, "symbol": _S, "event_time": _TS, "price": _D, "source": _S, "ingested_at": _TS})
RULE = _struct({"symbol": _S, "interval": _S, "direction": _S, "threshold": _D, "signal_name": _S})
STRATEGY = _struct(
    {"strategy_id": _S, "symbol": _S, "interval": _S}
    | {"entry_direction": _S, "entry_threshold": _D, "exit_direction": _S, "exit_threshold": _D}
    | {"initial_capital": _D, "transaction_cost_bps": _D}
)
MARK = _struct(
    {"job_name": _S}
    | {c: _S for c in SERIES}
    | {"last_success_open_time": _TS, "last_row_count": _L, "updated_at": _TS}
)

SILVER_COLUMNS = SILVER.fieldNames()
GOLD_COLUMNS = GOLD.fieldNames()
LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD, "serving": SERVING}
