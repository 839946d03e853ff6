"""Incremental ingest of telemetry lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltide.schemas import KPI_COLUMNS, MARKS
from celltide.sources.telemetry import parse_kpi_lines, split_payload, type_kpi

# Refresh periods in seconds.
PERIODS = {
    "anomalies": 5, "calls": 5, "parser": 10, "remediation": 10, "towers": 15, "recovery": 30,
    "telemetry": 300,
}


def trigger(seconds=None) -> dict:
    """All that is there and then stop; or every so many seconds."""
    if seconds is None:
        return {"availableNow": True}
    return {"processingTime": f"{seconds} seconds"}


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per batch, replaced on a retry: a batch that runs twice is stored once."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def ingest(
    stream: DataFrame, archive: str, quarantine: str, checkpoint: str, seconds=None, value="value"
):
    """Start the ingest query: well-formed readings to `archive`, other lines to `quarantine`.

    Both are parquet with one folder per batch; the position lives in `checkpoint`. Readings are
    partitioned by date inside a batch, so later scans prune by time.
    """
    def store(batch: DataFrame, batch_id: int) -> None:
        messages = batch.select(value).persist()
        good, bad = parse_kpi_lines(split_payload(messages, value))
        typed = type_kpi(good).select(*KPI_COLUMNS, *MARKS)
        dated = typed.withColumn("event_date", F.to_date("event_time"))
        dated.write.mode("overwrite").partitionBy("event_date").parquet(
            f"{archive}/batch_id={batch_id}"
        )
        write_batch(bad, quarantine, batch_id)
        messages.unpersist()

    return (
        stream.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(seconds))
        .start()
    )
