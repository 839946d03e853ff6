"""Roll-ups kept up to date by batches."""

import datetime as dt
import os

from pyspark.sql import functions as F

from celltide.operators import rollups
from celltide.streaming.kept import ANOMALIES, CALLS, KeptRollup
from tests.conftest import rows

CALL = "cell_id BIGINT, timestamp TIMESTAMP, is_dropped BOOLEAN"


def _calls(spark, told):
    def at(day):
        return None if day is None else dt.datetime(2024, 1, day, 12)

    return spark.createDataFrame([(c, at(d), x) for c, d, x in told], CALL)


def test_late_rows_retries_and_empty_batches(spark, tmp_path):
    batches = [
        [(1, 9, True), (1, 9, False), (2, 9, None)],
        [(1, 3, True), (None, 9, True), (3, None, False)],  # a late day, no cell, no time
        [],
        [(1, 9, False), (2, 3, True), (3, None, True)],
    ]
    kept = KeptRollup(spark, str(tmp_path), CALLS)
    for number, told in enumerate(batches):
        for _ in range(1 + (number == 1)):  # one of them runs twice
            kept.add(_calls(spark, told), number)
        so_far = _calls(spark, [r for b in batches[: number + 1] for r in b])
        assert rows(kept.read(so_far, number)) == rows(rollups.tower_activity(so_far))
    assert kept.versions(3) == {"2024-01-03": 3, "2024-01-09": 3, "none": 3}


def test_a_batch_touches_only_its_own_days(spark, tmp_path):
    kept = KeptRollup(spark, str(tmp_path), CALLS)
    kept.add(_calls(spark, [(c, d, False) for c in range(5) for d in range(1, 21)]), 0)
    kept.add(_calls(spark, [(1, 7, True)]), 1)
    written = [p for p, _, files in os.walk(tmp_path / "days") if files and p.endswith("batch_id=1")]
    assert [os.path.basename(os.path.dirname(p)) for p in written] == ["day=2024-01-07"]
    read = kept._sums({"2024-01-07": 0}, rollups.activity_parts(
        _calls(spark, []).withColumn("day", F.lit("")), ("day", "cell_id")).schema)
    assert len(read.inputFiles()) <= 5 and read.count() == 5
    # What no retry can ask for any more goes.
    kept.add(_calls(spark, [(1, 7, True)]), 2)
    assert not os.path.exists(tmp_path / "days/day=2024-01-07/batch_id=0")


def test_kinds_and_newest_anomaly(spark, tmp_path):
    schema = "cell_id BIGINT, creation_date TIMESTAMP, anomaly_type STRING, anomaly STRING, source_id STRING, item_no INT"
    when = [dt.datetime(2024, 1, d) for d in (1, 2, 2)]
    told = [(1, when[0], "b", "x", "1", 1), (1, when[1], "a", "y", "2", 2), (1, when[2], "b", "z", "3", 1)]
    kept = KeptRollup(spark, str(tmp_path), ANOMALIES)
    for number, k in enumerate((2, 0, 1)):
        kept.add(spark.createDataFrame([told[k]], schema), number)
    whole = spark.createDataFrame(told, schema)
    got = kept.read(whole, 2)
    assert got.columns == rollups.anomaly_summary(whole).columns
    assert rows(got) == rows(rollups.anomaly_summary(whole)) == [(1, 3, ["a", "b"], "z", when[2])]


def test_nothing_yet(spark, tmp_path):
    kept = KeptRollup(spark, str(tmp_path), CALLS)
    kept.add(_calls(spark, []), 0)
    assert kept.read(_calls(spark, []), 0).collect() == []
