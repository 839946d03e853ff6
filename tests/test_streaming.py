import datetime as dt

import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL, rows

from celltide.operators import eventstore, reports
from celltide.operators import rules as R
from celltide.plans import views
from celltide.schemas import KPI_COLUMNS
from celltide.sinks.messages import encode_kpi_lines
from celltide.streaming.detect import current, detect_stream, detect_with_tail, tail
from celltide.streaming.ingest import PERIODS, ingest, trigger
from celltide.streaming.job import host_metrics_job, run_batch, telemetry_job
from celltide.streaming.store import ReadingStore, score_arrivals


def batches(spark, folder, days):
    """Readings of a range of days as one more file of the stream's folder."""
    kpi = views.valid_kpi(spark, SMALL).where(F.dayofmonth("event_time").between(*days))
    kpi.coalesce(1).write.mode("append").parquet(folder)


def test_ingest_keeps_its_place(spark, tmp_path):
    source, archive, bad, place = (str(tmp_path / n) for n in ("in", "archive", "bad", "checkpoint"))
    kpi = views.kpi(spark, SMALL).select(*KPI_COLUMNS)
    lines = encode_kpi_lines(kpi)
    lines.where("value LIKE '%\"Band 29\"%'").write.mode("append").text(source)

    def run():
        ingest(spark.readStream.text(source), archive, bad, place).awaitTermination()
        return spark.read.parquet(archive)

    first = run().count()
    assert first == kpi.where("band = 'Band 29'").count()
    assert run().count() == first
    rest = lines.where("value NOT LIKE '%\"Band 29\"%'")
    rest.union(spark.createDataFrame([("a,b",), ("",)], "value string")).coalesce(1).write.mode(
        "append").text(source)
    assert rows(run().select(*KPI_COLUMNS)) == rows(kpi)
    assert rows(spark.read.parquet(bad), "field_count", "line") == [(2, "a,b")]


@pytest.mark.parametrize("start", [detect_stream, detect_with_tail])
def test_stream_equals_table(spark, tmp_path, start):
    source, store, out, place = (str(tmp_path / n) for n in ("in", "store", "out", "checkpoint"))
    table = R.detect(views.valid_kpi(spark, SMALL))
    columns = ["event_id", "prior_count", *R.FLAGS.values()]
    for days in ((1, 9), (10, 10), (11, 31)):
        batches(spark, source, days)
        stream = spark.readStream.schema(views.valid_kpi(spark, SMALL).schema).option(
            "maxFilesPerTrigger", 1).parquet(source)
        start(stream, store, out, place).awaitTermination()
    scored = spark.read.parquet(out)
    assert scored.select("batch_id").distinct().count() == 3
    assert rows(scored, *columns) == rows(table, *columns)


def test_tail_keeps_what_equal_times_need(spark):
    t = dt.datetime(2024, 1, 1)
    data = [(1, "Band 29", t + dt.timedelta(seconds=s), float(v), 1.0)
            for s, v in [(0, 1), (1, 2), (2, 3), (3, 4)] + [(4, v) for v in range(10)]]
    df = spark.createDataFrame(
        data, "cell_id long, band string, event_time timestamp, ues_usage double, throughput_mbps double")
    kept = tail(df)
    assert sorted(r.ues_usage for r in kept.collect()) == [2.0, 3.0, 4.0, 7.0, 8.0, 9.0]


def test_triggers():
    assert trigger() == {"availableNow": True}
    assert trigger(PERIODS["parser"]) == {"processingTime": "10 seconds"}


def by_report(df):
    """Answers of every kind, told by the reading."""
    kind = F.pmod(F.col("cell_id"), F.lit(3))
    said = F.when(kind == 0, F.col("report_text")).when(kind == 1, "The cell looks degraded.")
    return df.withColumn("raw_response", F.when(F.col("is_anomaly"), said).otherwise("NO_ANOMALY"))


def test_whole_job(spark, tmp_path):
    """Three batches, the second one run twice: the same rows, events and requests as of the table."""
    source, folder = str(tmp_path / "in"), str(tmp_path / "job")
    kpi = views.kpi(spark, SMALL)
    for days in ((1, 9), (10, 10), (11, 31)):
        part = kpi.where(F.dayofmonth("event_time").between(*days)).select(*KPI_COLUMNS)
        encode_kpi_lines(part).coalesce(1).write.mode("append").text(source)
        telemetry_job(spark.readStream.option("maxFilesPerTrigger", 1).text(source), folder, by_report).awaitTermination()
    again = encode_kpi_lines(kpi.where("dayofmonth(event_time) = 10").select(*KPI_COLUMNS))
    run_batch(again, 1, folder, by_report)

    table = reports.reconcile(by_report(reports.render_report(R.detect(views.valid_kpi(spark, SMALL)))))
    results = spark.read.parquet(f"{folder}/results")
    assert results.select("batch_id").distinct().count() == 3
    columns = ["cell_id", "band", "event_time", "prior_count", "outcome", *R.FLAGS.values()]
    assert rows(results, *columns) == rows(table, *columns)
    assert rows(spark.read.parquet(f"{folder}/archive").select(*KPI_COLUMNS)) == rows(kpi.select(*KPI_COLUMNS))
    events = spark.read.parquet(f"{folder}/events")
    assert rows(events, "cell_id", "event") == rows(eventstore.to_events(table), "cell_id", "event")
    assert events.select("event_key").distinct().count() == events.count()
    requests = spark.read.parquet(f"{folder}/remediation")
    assert rows(requests, "value") == rows(reports.remediation(table), "value") and requests.count() > 0


def test_host_metrics(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "du")
    views.du_payloads(spark, SMALL).select("value").union(
        spark.createDataFrame([("a,b",)], "value string")).write.text(source)
    host_metrics_job(spark.readStream.text(source), folder).awaitTermination()
    du = views.du(spark, SMALL).drop("event_id")
    assert rows(spark.read.parquet(f"{folder}/archive").select(*du.columns)) == rows(du)
    assert spark.read.parquet(f"{folder}/quarantine").count() == 1


def feed(spark, part, source, *places, **options):
    """One more file, and one more batch."""
    part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(part.schema).parquet(source)
    detect_stream(stream, *places, **options).awaitTermination()


def test_files_out_of_order_equal_the_table(spark, tmp_path):
    """Newest days first, so every key is late in every batch; and the last batch run a second time."""
    source, store, out, place = (str(tmp_path / n) for n in ("in", "store", "out", "checkpoint"))
    kpi = views.valid_kpi(spark, SMALL)
    columns = ["event_id", "prior_count", "avg_prior_ues", "avg_prior_throughput", *R.FLAGS.values()]
    for days in ((21, 31), (11, 20), (1, 10)):
        feed(spark, kpi.where(F.dayofmonth("event_time").between(*days)), source, store, out, place, buckets=4)
    want = rows(R.detect(kpi), *columns)
    assert rows(current(spark.read.parquet(out)), *columns) == want
    assert rows(spark.read.parquet(out), *columns) != want  # some were told again
    last = kpi.where(F.dayofmonth("event_time").between(1, 10))
    again = score_arrivals(last, 2, ReadingStore(store, 3, 4))
    assert rows(again, *columns) == rows(spark.read.parquet(f"{out}/batch_id=2"), *columns)


def test_a_late_reading_changes_what_follows(spark, tmp_path):
    """One key far in the past, one in the same second, one without a band; what is told again is no more than needed."""
    source, store, out, place = (str(tmp_path / n) for n in ("in", "store", "out", "checkpoint"))
    kpi = views.valid_kpi(spark, SMALL).limit(1).drop("event_id", "cell_id", "event_time", "band", "ues_usage")
    start = dt.datetime(2024, 1, 1)

    def readings(*told):
        rows_ = [(i, c, b, start + dt.timedelta(hours=h), float(u)) for i, c, b, h, u in told]
        schema = "event_id long, cell_id long, band string, event_time timestamp, ues_usage double"
        return spark.createDataFrame(rows_, schema).crossJoin(kpi)

    first = readings(*[(k, 1, "Band 29", 24 * k, k) for k in range(40)], (100, 2, "Band 29", 0, 7))
    second = readings((200, 1, "Band 29", 24 * 20 + 1, 50), (201, 2, "Band 29", 0, 8), (202, 3, None, 5, 1),
                      (203, 1, "Band 29", 24 * 50, 9), (204, 1, "Band 29", -24 * 90, 3))
    feed(spark, first, source, store, out, place)
    feed(spark, second, source, store, out, place)
    found = current(spark.read.parquet(out)).select("event_id", "prior_count", F.round("avg_prior_ues", 6))
    whole = R.detect(first.union(second)).select("event_id", "prior_count", F.round("avg_prior_ues", 6))
    assert rows(found) == rows(whole)
    told = {r[0] for r in spark.read.parquet(f"{out}/batch_id=1").select("event_id").collect()}
    assert told == {200, 201, 202, 203, 204, 21, 22, 23, 100, 0, 1, 2}


def test_what_a_batch_reads_does_not_grow(spark, tmp_path):
    """In time order the archive is never read; a late reading reads its own days, however long the archive is."""
    kpi = views.valid_kpi(spark, SMALL).limit(20).drop("event_time")
    known = ReadingStore(str(tmp_path / "store"), 3, 4)
    start = dt.datetime(2024, 1, 1)

    def at(*hours):
        return kpi.crossJoin(spark.createDataFrame([(start + dt.timedelta(hours=h),) for h in hours], "event_time timestamp"))

    read = []
    for k, days in enumerate((4, 40)):
        before = 24 * sum((4, 40)[:k])
        score_arrivals(at(*range(before, before + 24 * days, 6)), 2 * k, known).count()
        assert known.looked_up == []
        score_arrivals(at(before + 24 * days - 30.5), 2 * k + 1, known).count()
        read.append([len(days) for days, _ in known.looked_up])
    assert read[0] == read[1] == [1, 3]
