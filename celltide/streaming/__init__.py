"""Structured Streaming: ingest, and detection over arriving batches."""
