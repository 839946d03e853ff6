"""Table schemas of the data model."""

from __future__ import annotations

KPI_SOURCE_NAMES = [
    "Cell ID", "Datetime", "Band", "Frequency", "UEs Usage", "Area Type", "Lat", "Lon",
    "City", "Adjacent Cells", "RSRP", "RSRQ", "SINR", "Throughput (Mbps)", "Latency (ms)",
    "Max Capacity",
]  # fixed values: field order of a telemetry line

KPI_COLUMNS = [
    "cell_id", "event_time", "band", "frequency", "ues_usage", "area_type", "lat", "lon",
    "city", "adjacent_cells", "rsrp", "rsrq", "sinr", "throughput_mbps", "latency_ms",
    "max_capacity",
]

# The first telemetry format had no place columns.
KPI_V0_COLUMNS = [c for c in KPI_COLUMNS if c not in ("lat", "lon", "city")]

KPI_SCHEMA = """
    cell_id BIGINT, event_time TIMESTAMP, band STRING, frequency STRING, ues_usage DOUBLE,
    area_type STRING, lat DOUBLE, lon DOUBLE, city STRING, adjacent_cells ARRAY<BIGINT>,
    rsrp DOUBLE, rsrq DOUBLE, sinr DOUBLE, throughput_mbps DOUBLE, latency_ms DOUBLE,
    max_capacity DOUBLE
"""

# Readings whose text was no number; a history with one of them has no mean.
MARKS = ["bad_ues", "bad_throughput"]

DU_COLUMNS = [
    "cell_id", "event_time", "cpu_pct", "memory_mb", "disk_gb", "rtt_ms", "temperature_c",
    "power_w",
]

DU_SCHEMA = """
    cell_id BIGINT, event_time TIMESTAMP, cpu_pct DOUBLE, memory_mb BIGINT, disk_gb DOUBLE,
    rtt_ms DOUBLE, temperature_c DOUBLE, power_w DOUBLE
"""

CELL_SCHEMA = """
    cell_id BIGINT, id BIGINT, name STRING, max_capacity BIGINT, lat DOUBLE, lon DOUBLE,
    lng DOUBLE, bands ARRAY<STRING>, area_type STRING, city STRING, status STRING,
    adjacent_cells ARRAY<BIGINT>
"""

EVENT_SCHEMA = """
    id BIGINT, cell_id BIGINT, creation_date TIMESTAMP, event STRING, data STRING, active INT
"""

FEED_SCHEMA = """
    type STRING, timestamp TIMESTAMP, message STRING, tower_id BIGINT, cell_id STRING,
    recovery_time DOUBLE, location STRUCT<lat: DOUBLE, lng: DOUBLE>, signal_strength DOUBLE,
    anomaly_type STRING, band STRING, source_id STRING, recommended_fix STRING
"""

REQUEST_SCHEMA = "ARRAY<STRUCT<`Cell ID`: STRING, `Datetime_ts`: STRING>>"


def string_schema(columns) -> str:
    return ", ".join(f"`{c}` STRING" for c in columns)
