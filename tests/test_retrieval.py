import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests.conftest import plan, rows

from celltide.operators import forecast, retrieval
from celltide.operators.retrieval import split_text


def test_fixed_chunks(spark):
    text = "".join(chr(97 + i % 26) for i in range(250))
    df = spark.createDataFrame([(1, text), (2, "abc"), (3, ""), (4, None)], "doc_id long, text string")
    got = {}
    for r in retrieval.chunk_documents(df, size=100, overlap=20).orderBy("doc_id", "chunk_no").collect():
        got.setdefault(r.doc_id, []).append(r.chunk_text)
    assert got == {1: [text[0:100], text[80:180], text[160:250]], 2: ["abc"]}
    whole = retrieval.chunk_documents(df, 100, 20, whole=F.col("doc_id") == 1)
    assert rows(whole, "doc_id", "chunk_no", "chunk_text") == [(1, 1, text), (2, 1, "abc")]


def test_chunks_never_hold_overlap_alone(spark):
    df = spark.createDataFrame([(n, "x" * n) for n in range(1, 400)], "doc_id long, text string")
    pieces = retrieval.chunk_documents(df, 100, 20)
    assert pieces.where("chunk_no > 1 AND length(chunk_text) <= 20").count() == 0
    total = pieces.groupBy("doc_id").agg(
        (F.sum(F.length("chunk_text")) - 20 * (F.count("*") - 1)).alias("n"))
    assert total.where("n <> doc_id").count() == 0


def test_separator_chunks(spark):
    assert split_text("aa bb cc dd", 6, 3) == ["aa bb", "bb cc", "cc dd"]
    assert split_text("one\n\ntwo three\n\nfour", 9, 0) == ["one", "two", "three", "four"]
    assert split_text("x" * 25, 10, 2) == ["x" * 10, "x" * 10, "x" * 9]
    assert split_text("  \n\n ", 10, 2) == []
    rng = random.Random(3)
    words = [("w" * rng.randint(1, 12)) + rng.choice(["\n", "\n\n", " ", " "]) for _ in range(600)]
    text = "".join(words)
    for size, overlap in ((50, 10), (200, 40)):
        chunks = split_text(text, size, overlap)
        assert all(0 < len(c) <= size for c in chunks)
        at = 0
        for c in chunks:
            found = text.find(c, max(0, at - overlap - 2))
            assert found >= 0
            at = found + len(c)
        assert at == len(text.rstrip())
    df = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    got = retrieval.chunk_at_separators(df, 50, 10).orderBy("chunk_no").collect()
    assert [r.chunk_text for r in got] == split_text(text, 50, 10)


def odd_vectors(metric):
    """Vectors that take no part; one of them used to hide all others of its batch."""
    rows = [(990, None), (991, []), (992, [float("nan")] + [0.1] * 7), (993, [float("inf")] * 8),
            (994, [None] * 8), (995, [0.1] * 7), (996, [0.1] * 9), (None, [0.1] * 8)]
    return rows + [(997, [0.0] * 8)] * (metric == "cosine")


@pytest.mark.parametrize("metric,block", [("l2", 256), ("l2", 2), ("cosine", 256)])
def test_nearest(spark, metric, block):
    rng = np.random.default_rng(5)
    points = rng.normal(size=(300, 8)).astype("float32")
    points[10] = points[20]
    asked = points[[20, 40, 60, 80, 100]].astype("float64") + 0.01
    vectors = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)]
                                    + odd_vectors(metric), "vec_id long, embedding array<float>").repartition(7)
    queries = spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(asked)],
                                    "query_id long, query_vector array<double>")
    got = retrieval.nearest(vectors, queries, 4, metric=metric, vector_block=20 * block, query_block=block)
    want = []
    for i, q in enumerate(asked):
        p = points.astype("float64")
        far = np.sqrt(((p - q) ** 2).sum(1)) if metric == "l2" else 1 - (p @ q) / (
            np.linalg.norm(p, axis=1) * np.linalg.norm(q))
        best = sorted((round(float(d), 6), j) for j, d in enumerate(far))[:4]
        want += [(i, r + 1, j) for r, (_, j) in enumerate(best)]
    assert rows(got, "query_id", "rank", "vec_id") == sorted(want, key=repr)
    assert retrieval.nearest(vectors, queries.where("false")).count() == 0


@pytest.mark.parametrize("label,query,way", [
    ("prediction", "yaml", "forecast"), ("Upgrade", "x", "upgrade"), ("x", "give me Yaml", "upgrade"),
    ("x", "y", "general"),
])
def test_route(spark, label, query, way):
    df = spark.createDataFrame([(label, query)], "label string, query string")
    assert retrieval.route(df).first().route == way


def test_requests(spark):
    item = "{'Cell ID': '1', 'Datetime_ts': '2026-02-26T12:00:00'}"
    texts = [f"please [{item}] thanks", "[" + ", ".join([item] * 7) + "]", "no list", "[{'Cell ID': ", "[{x]",
             f"[{item.replace(chr(39) + '1' + chr(39), '7')}]", f"[{item}, {item.replace('02-26', '02-29')}]",
             "[" + ", ".join([item] * 5 + [item.replace("02-26", "02-29")]) + "]", f"[{item.replace('02-26', '13-29')}]"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r for r in retrieval.parse_request(df).collect()}
    assert [len(got[i].requests or []) for i in range(6)] == [1, 5, 0, 0, 0, 1]
    assert got[2].error == retrieval.NO_LIST and got[3].error == retrieval.NO_LIST
    assert got[4].error == retrieval.BAD_LIST and got[0].error is None
    assert got[5].requests[0]["Cell ID"] == "7"
    assert got[6].error == retrieval.BAD_DATE and got[6].requests is None
    assert got[7].error is None and len(got[7].requests) == 5 and got[8].error is None
    asked = forecast.requests_to_rows(retrieval.parse_request(df))
    assert rows(asked.distinct()) == [(1, dt.datetime(2026, 2, 26, 12)), (7, dt.datetime(2026, 2, 26, 12))]


def test_full_outer_and_status(spark):
    t = dt.datetime(2024, 1, 1)
    a = spark.createDataFrame([(1, t, 0.5), (None, t, 0.1)], "cell_id long, event_time timestamp, anomaly_score double")
    b = spark.createDataFrame([(1, t, 10.0), (1, t, 11.0), (2, t, 9.0)],
                              "cell_id long, event_time timestamp, predicted_traffic double")
    keys = ["cell_id", "event_time"]
    assert rows(retrieval.full_outer(a, b, keys)) == rows(a.join(b, keys, "full").select(
        *keys, "anomaly_score", "predicted_traffic"))
    du = spark.createDataFrame([(3, t, 1.0, 2, 3.0, 4.0, 5.0, 6.0)],
                               "cell_id long, event_time timestamp, cpu_pct double, memory_mb long, disk_gb double, "
                               "rtt_ms double, temperature_c double, power_w double")
    joined = retrieval.join_kpi_du(a, b, du)
    assert joined.count() == 5
    assert "FullOuter" not in plan(joined)
    row = retrieval.status_text(joined.where("cell_id = 3")).first().status_text.split("\n")
    assert row[:4] == ["CellID: 3", "KPI Anomaly Score: -", "Predicted Traffic Load: -", "DU CPU Usage: 1.0%"]
