import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL, rows

from celltide.plans import views
from celltide.schemas import KPI_COLUMNS, KPI_V0_COLUMNS
from celltide.sinks.files import (
    write_anomalies,
    write_archive,
    write_report,
    write_results,
    write_topology,
)
from celltide.sinks.messages import encode_kpi_lines, send
from celltide.sources import telemetry as tel
from celltide.sources.documents import read_documents
from celltide.sources.events import read_event_table, read_events_json
from celltide.sources.topology import normalize_towers, read_topology

GOOD = '"1","2024-01-01 00:00:00","Band 29","700","5.0","rural","33.0","-97.0","A","2,3","-90","-10","5","20","15","60"'


def test_payload_lines(spark):
    df = spark.createDataFrame(
        [(1, bytearray(b"a\r\n\n  b \n")), (2, bytearray(b"A\xffB")), (3, None), (4, bytearray(b""))],
        "id int, value binary")
    assert rows(tel.split_payload(df)) == [(1, "a"), (1, "b"), (2, "AB")]


def test_lines_of_wrong_arity_are_quarantined(spark):
    short, long = GOOD.rsplit(",", 1)[0], GOOD + ',"x"'
    quoted = GOOD.replace('"A"', '"x""y"')
    df = spark.createDataFrame([(x,) for x in (GOOD, short, long, quoted)], "line string")
    good, bad = tel.parse_kpi_lines(df)
    assert sorted(r.city for r in good.collect()) == ["A", 'x"y']
    assert {r.adjacent_cells for r in good.collect()} == {"2,3"}
    assert sorted(r.field_count for r in bad.collect()) == [15, 17]


def test_encode_then_parse_gives_the_same_rows(spark):
    kpi = views.kpi(spark, SMALL).select(*KPI_COLUMNS)
    lines = encode_kpi_lines(kpi).withColumnRenamed("value", "line")
    good, bad = tel.parse_kpi_lines(lines)
    assert rows(tel.type_kpi(good).select(*KPI_COLUMNS)) == rows(kpi)
    assert bad.count() == 0


def test_archive_round_trip(spark, tmp_path):
    kpi = views.kpi(spark, SMALL).select(*KPI_COLUMNS)
    quoted = kpi.withColumn("city", F.concat("city", F.lit(', "x"')))
    write_archive(quoted, str(tmp_path / "ran-combined-metrics" / "b1"))
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "x.csv").write_text('"a"\n"b"\n')
    back = tel.read_archive(spark, str(tmp_path))
    assert rows(tel.type_kpi(back).select(*KPI_COLUMNS)) == rows(quoted)
    newest = tel.newest_first(back).select("file_time").first()[0]
    assert newest == back.agg(F.max("file_time")).first()[0]


def test_repeated_headers_and_old_formats(spark, tmp_path):
    folder = tmp_path / "ran-combined-metrics"
    folder.mkdir()
    fields = [f.strip('"') for f in GOOD.replace("2,3", "2;3").split(",")]
    old = [f for i, f in enumerate(fields) if i not in (6, 7, 8)]
    header = ",".join(f'"{c}"' for c in KPI_V0_COLUMNS)
    line = ",".join(f'"{f}"' for f in old)
    again = header.replace("cell_id", "Cell ID")
    (folder / "a.csv").write_text("\n".join([header, line, again, line]) + "\n")
    back = tel.read_archive(spark, str(tmp_path), columns=tuple(KPI_V0_COLUMNS))
    got = back.select("cell_id", "city", "max_capacity").collect()
    assert [tuple(r) for r in got] == [("1", None, "60")] * 2


def test_newest_batch_only(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 3)], "id int, batch int")
    assert rows(tel.latest_batch(df, "batch"), "id") == [(2,), (3,)]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2)], '`Disk Space (GB)` int, ` "Cell ID" ` int')
    assert tel.normalize_names(df).columns == ["diskspacegb", "cellid"]
    assert tel.strip_names(df).columns == ["Disk Space (GB)", "Cell ID"]


def test_topology_files(spark, tmp_path):
    cells = [
        {"cell_id": 1, "max_capacity": 87, "lat": 33.0, "lon": -96.7, "bands": ["Band 29", "Band 66"],
         "area_type": "industrial", "city": "A", "adjacent_cells": [2, 3]},
        {"cell_id": 2, "max_capacity": 0, "lat": 33.1, "lon": -96.8, "bands": [],
         "area_type": "rural", "city": "A", "adjacent_cells": []},
    ]
    (tmp_path / "nested.json").write_text(json.dumps({"cells": cells}, indent=1))
    (tmp_path / "bare.json").write_text(json.dumps(cells))
    want = [(1, ["Band 29", "Band 66"], [2, 3]), (2, [], [])]
    for name in ("nested.json", "bare.json"):
        df = read_topology(spark, str(tmp_path / name))
        assert rows(df, "cell_id", "bands", "adjacent_cells") == want
    write_topology(df.select("cell_id", "max_capacity", "lat", "lon", "bands", "area_type", "city",
                             "adjacent_cells"), str(tmp_path / "csv"), "csv")
    write_topology(df, str(tmp_path / "lines"))
    assert rows(read_topology(spark, str(tmp_path / "csv"), "csv"),
                "cell_id", "bands", "adjacent_cells") == want
    assert rows(read_topology(spark, str(tmp_path / "lines"), "ndjson"),
                "cell_id", "bands", "adjacent_cells") == want
    towers = normalize_towers(df)
    assert rows(towers, "id", "name", "status") == [(1, "Cell 1", "up"), (2, "Cell 2", "down")]


def test_towers_need_a_place(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0), (2, float("nan"), 1.0), (3, float("inf"), 1.0), (4, 1.0, 1.0)],
        "id int, lat double, lng double").selectExpr(
        "*", "cast(null as array<string>) bands", "'A' city", "'x' area_type", "5 max_capacity",
        "'down' status", "'T' name")
    assert rows(normalize_towers(df), "id", "name", "status", "bands") == [(4, "T", "down", [])]


def test_event_files(spark, tmp_path):
    items = [{"id": 1, "cell_id": 5, "event": "x", "creation_date": "2024-01-01"},
             {"id": 2, "cell_id": 5, "Event": "y", "date": "2024-01-02"}, {"id": 3, "cell_id": 6}]
    (tmp_path / "array.json").write_text(json.dumps(items))
    (tmp_path / "one.json").write_text(json.dumps(items[0]))
    (tmp_path / "lines.json").write_text("\n".join(json.dumps(i) for i in items))
    want = [("1", "x", "2024-01-01"), ("2", "y", "2024-01-02")]
    columns = ("id", "event", "creation_date")
    assert rows(read_events_json(spark, str(tmp_path / "array.json")), *columns) == want
    assert rows(read_events_json(spark, str(tmp_path / "one.json")), *columns) == want[:1]
    assert rows(read_events_json(spark, str(tmp_path / "lines.json"), True), *columns) == want
    views.event_store(spark, SMALL).write.parquet(str(tmp_path / "store"))
    assert read_event_table(spark, str(tmp_path / "store")).count() == 1000


def test_documents(spark, tmp_path):
    (tmp_path / "a.txt").write_text("one\ntwo")
    (tmp_path / "b.json").write_text("{}")
    got = read_documents(spark, str(tmp_path)).collect()
    assert sorted((r.text, r.whole) for r in got) == [("one\ntwo", False), ("{}", True)]


def test_result_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 29, "Low RSRP", None)],
                               "cell_id int, band int, anomaly_type string, source_id string")
    write_anomalies(df.coalesce(1), str(tmp_path / "csv"), "csv")
    write_anomalies(df, str(tmp_path / "json"))
    write_results(df, str(tmp_path / "results"))
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("part*"))
    assert text.splitlines() == [
        "cell_id,band,anomaly_type,anomaly,recommended_fix,source_id,creation_date",
        "1,29,Low RSRP,,,,"]
    report = spark.createDataFrame([("a",), ("b",)], "report_text string").coalesce(1)
    write_report(report, str(tmp_path / "report"))
    assert "".join(p.read_text() for p in (tmp_path / "report").glob("part*")) == "a\n\nb\n\n"


def test_publishing_failures_do_not_stop_the_run(spark):
    df = spark.createDataFrame([("x",)], "value string")
    assert send(df, {}, "topic") is False
    with pytest.raises(Exception, match="(?i)kafka"):
        send(df, {}, "topic", strict=True)


def test_times_are_utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    first = views.kpi(spark, SMALL).orderBy("event_time").first().event_time
    assert first.date() == dt.date(2024, 1, 1)
