"""Landed payloads, lakehouse layers, serving table and high-water marks."""
