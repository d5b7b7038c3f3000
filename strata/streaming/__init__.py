"""Structured Streaming jobs: incremental file ingest, streaming
de-duplication and keyed upserts into key-hash-bucketed tables."""
