"""Detection on arriving batches.

`score_batch` scores a batch against a given past with the operators of a table. `detect_stream` keeps the
past in a store of key buckets and days, so the cost of a batch does not grow with what has arrived before,
and readings that arrive late get, and give, the history they would have in a table. A key's readings are
split by the sliced history: no task holds a whole key, as keyed state would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltide.operators.rules import Thresholds, apply_rules, with_history
from celltide.streaming.ingest import trigger, write_batch
from celltide.streaming.store import (
    BUCKETS,
    KEYS,
    ReadingStore,
    current,
    drop_path,
    history_values,
    score_arrivals,
    tail,
)

__all__ = ["KEYS", "current", "detect_stream", "detect_with_tail", "drop_path", "score_batch", "tail"]


def score_batch(batch: DataFrame, past: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """The batch with flags and anomalies, its history reaching back into `past`."""
    older = past.select(*KEYS, "event_time", *history_values(past)).withColumn("_new", F.lit(False))
    readings = batch.withColumn("_new", F.lit(True)).unionByName(older, allowMissingColumns=True)
    told = with_history(readings, t)
    return apply_rules(told.where("_new").drop("_new"), t)


def detect_stream(
    stream: DataFrame, store: str, out: str, checkpoint: str, t: Thresholds = Thresholds(),
    seconds=None, buckets=BUCKETS,
):
    """Archive each batch under `store` and score it; `current` reads the valid results from `out`.

    A late reading amends the results of the readings after it: they are written again with its batch.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        known = ReadingStore(store, t.history, buckets)
        write_batch(score_arrivals(batch, batch_id, known, t), out, batch_id)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint).trigger(**trigger(seconds)).start()
    )


def detect_with_tail(
    stream: DataFrame, state: str, out: str, checkpoint: str, t: Thresholds = Thresholds(),
    seconds=None, buckets=BUCKETS,
):
    """The same, but every reading is told once, when it arrives: against all that has arrived until then."""
    def run(batch: DataFrame, batch_id: int) -> None:
        known = ReadingStore(state, t.history, buckets)
        write_batch(score_arrivals(batch, batch_id, known, t, amend=False), out, batch_id)

    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint).trigger(**trigger(seconds)).start()
    )
