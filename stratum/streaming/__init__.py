"""Structured Streaming: continuous file ingest into bronze (each file once)."""
