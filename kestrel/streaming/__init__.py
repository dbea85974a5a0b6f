"""Structured Streaming: stream specs, payload parsing, bronze ingest, windowed and stateful jobs."""
