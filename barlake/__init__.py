"""Candle (OHLCV) and tick analytics as plain PySpark DataFrame jobs."""
