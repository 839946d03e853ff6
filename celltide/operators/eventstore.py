"""The append-only event store.

Events are never updated. Resolving a cell appends a row to a resolutions table; an event is active
when it was stored active and no resolution of its cell came at or after it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.text import snippet
from celltide.sinks.files import text_columns
from celltide.sinks.messages import csv_line
from celltide.sources.telemetry import parse_kpi_lines, split_payload, type_kpi

DETECTED_EVENT = "auto_detected_anomaly"


def to_events(reconciled: DataFrame, include_normal=False, created: Column | None = None):
    """Event rows of scored rows: the text of the anomaly and the row itself as `data`.

    By default only anomalies are stored. `include_normal` stores every scored row with its raw
    answer, active like the rest.
    """
    text = (
        F.col("raw_response") if include_normal
        else F.coalesce("event_text", "reason")
    )
    rows = reconciled if include_normal else reconciled.where("is_anomaly")
    return rows.select(
        "cell_id",
        (F.col("event_time") if created is None else created).alias("creation_date"),
        text.alias("event"),
        csv_line(text_columns(reconciled)).alias("data"),
        F.lit(1).alias("active"),
    )


def latest_resolutions(resolutions: DataFrame) -> DataFrame:
    """The newest resolution of each cell."""
    return resolutions.groupBy("cell_id").agg(F.max("resolved_at").alias("resolved_at"))


def with_active(events: DataFrame, resolutions: DataFrame) -> DataFrame:
    """Events with `active` as it stands after the resolutions.

    The resolution side is reduced to one row per cell first; a cell with very many events is on
    the split side of the left join.
    """
    joined = events.join(latest_resolutions(resolutions), "cell_id", "left")
    still = F.col("resolved_at").isNull() | (F.col("resolved_at") < F.col("creation_date"))
    return joined.withColumn(
        "active", F.when(still, F.col("active")).otherwise(F.lit(0))
    ).select(*events.columns)


def resolve(events: DataFrame, cells: DataFrame, at: Column) -> tuple[DataFrame, DataFrame]:
    """(resolution rows to append, one-row count of the events that they close)."""
    wanted = cells.select("cell_id").distinct()
    rows = wanted.withColumn("resolved_at", at)
    closed = (
        events.where((F.col("active") == 1) & (F.col("creation_date") <= at))
        .join(wanted, "cell_id", "left_semi")
        .agg(F.count("*").alias("resolved_events"))
    )
    return rows, closed


def resolve_range(events: DataFrame, low: int, high: int, at: Column):
    """The same for every cell with events in an id range."""
    cells = events.where(F.col("cell_id").between(low, high)).select("cell_id")
    return resolve(events, cells, at)


def resolve_all(events: DataFrame, at: Column):
    return resolve(events, events.select("cell_id"), at)


def active_cells(events: DataFrame) -> DataFrame:
    return events.where("active = 1").select("cell_id").distinct()


def active_events(events: DataFrame) -> DataFrame:
    return events.where("active = 1").orderBy(F.desc("creation_date"), F.desc("id"))


def latest_events(events: DataFrame, n=10) -> DataFrame:
    """The newest n events with a short form of their text."""
    return (
        events.orderBy(F.desc("creation_date"), F.desc("id")).limit(n)
        .withColumn("snippet", snippet(F.col("event")))
    )


def event_details(events: DataFrame) -> DataFrame:
    """Each event in full, with the telemetry rows stored in its `data`, one row per reading."""
    stored = events.select(
        F.col("id"), F.col("cell_id").alias("event_cell_id"), "creation_date", "event", "active",
        F.col("data"),
    )
    good, _ = parse_kpi_lines(split_payload(stored, "data"))
    return type_kpi(good)
