"""Structured Streaming jobs for ticks and threshold alerts."""
