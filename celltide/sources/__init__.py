"""Readers: telemetry lines and archives, topology, the event store, documents."""
