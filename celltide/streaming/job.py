"""The whole pass over arriving lines: archive, detection, answers, events, remediation requests.

Every batch writes one folder of its own in each store, replaced when the batch is run again. So a
retry stores nothing twice, and events are keyed by batch id and row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltide.operators.clean import filter_valid_bands
from celltide.operators.eventstore import to_events
from celltide.operators.reports import reconcile, remediation, render_report
from celltide.operators.rules import Thresholds
from celltide.schemas import DU_COLUMNS, KPI_COLUMNS, MARKS
from celltide.sources.telemetry import (
    parse_du_lines,
    parse_kpi_lines,
    split_payload,
    type_du,
    type_kpi,
)
from celltide.streaming.ingest import trigger, write_batch
from celltide.streaming.store import BUCKETS, ReadingStore, score_arrivals

STORES = ["archive", "quarantine", "results", "events", "remediation", "state"]


def stored(batch: DataFrame, path: str, batch_id: int) -> DataFrame:
    """The batch as written, so that nothing after it asks the source again."""
    write_batch(batch, path, batch_id)
    return batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/batch_id={batch_id}")


def run_batch(
    lines: DataFrame, batch_id: int, folder: str, answer: Callable[[DataFrame], DataFrame],
    t: Thresholds = Thresholds(), value="value", buckets=BUCKETS,
) -> None:
    """One batch of lines. `answer` adds `raw_response` to rows with `report_text` and `is_anomaly`.

    The state of a batch is made from that of the batch before it, so a batch can be run again. Readings
    that arrive late are scored against the history of their time; nothing is told twice.
    """
    good, bad = parse_kpi_lines(split_payload(lines.select(value), value))
    write_batch(bad, f"{folder}/quarantine", batch_id)
    readings = stored(type_kpi(good).select(*KPI_COLUMNS, *MARKS), f"{folder}/archive", batch_id)
    valid = filter_valid_bands(readings)
    known = ReadingStore(f"{folder}/state", t.history, buckets)
    scored = score_arrivals(valid, batch_id, known, t, amend=False)
    answered = reconcile(answer(render_report(scored)))
    answered = stored(answered, f"{folder}/results", batch_id)
    # Equal lines of a batch are one event: the key is made of the batch and the reading itself.
    key = F.concat_ws("-", F.lit(str(batch_id)), F.md5("data"))
    events = to_events(answered).withColumn("event_key", key).dropDuplicates(["event_key"])
    write_batch(events, f"{folder}/events", batch_id)
    write_batch(remediation(answered), f"{folder}/remediation", batch_id)


def telemetry_job(
    stream: DataFrame, folder: str, answer: Callable[[DataFrame], DataFrame],
    t: Thresholds = Thresholds(), seconds=None, value="value",
):
    """Start the pass over a stream of telemetry lines; its stores are the folders in STORES."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(value).persist()
        run_batch(batch, batch_id, folder, answer, t, value)
        batch.unpersist()

    return (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger(seconds)).start()
    )


def host_metrics_job(stream: DataFrame, folder: str, seconds=None, value="value"):
    """Start the ingest of host-metric lines: typed rows to `archive`, other lines to `quarantine`."""
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.select(value).persist()
        good, bad = parse_du_lines(split_payload(batch, value))
        write_batch(type_du(good).select(*DU_COLUMNS), f"{folder}/archive", batch_id)
        write_batch(bad, f"{folder}/quarantine", batch_id)
        batch.unpersist()

    return (
        stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(**trigger(seconds)).start()
    )
