import tracemalloc
from types import SimpleNamespace
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from celltide.llm import quality as q
from tests.llm.helpers import awkward, empty, prose, table

SF = "/root/testdata/sf0.01"


def _tables(spark):
    rows, labels = [], []
    for i in range(160):
        bad = i % 4 == 0
        text = prose(i, 80)
        rows.append((i, text.upper().replace(" ", "!! ") if bad else text.capitalize() + ".", "en", "a", 0, (1,), "x"))
        labels.append((i, 0 if bad else 1, 0))
    labels += [(None, 1, 0), (9999, 0, 0), (3, None, 0)]
    return rows, spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT")


def test_held_out_accuracy_on_the_given_labels(spark):
    found = q.op5_quality_classifier(spark, SF)
    both = found.where("held_out").join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    right = both.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("a")).first()["a"]
    assert right >= 0.95


def test_scores_and_folds(spark):
    rows, labels = _tables(spark)
    rows += awkward()
    model = q.NeighbourVote(sample=60).fit(table(spark, rows), labels)
    scored = model.score(table(spark, rows))
    assert scored.count() == len(rows)
    got = scored.select("row.doc_id", "row.text", "score", q.held_out(F.col("row.doc_id")).alias("held")).collect()
    for r in got:
        assert 0 <= r.score <= 1
        assert r.held == (r.doc_id is not None and crc32(str(r.doc_id).encode()) % 5 == 0)
    wrong = [r for r in got if r.doc_id is not None and r.doc_id < 160 and r.doc_id % 4 == 0
             and r.score >= 0.3 and (r.text or "").isupper()]
    assert wrong == []


def test_held_out_labels_are_not_learned(spark):
    rows, labels = _tables(spark)
    docs = table(spark, rows)
    turned = labels.withColumn("quality", F.when(q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.row.doc_id: r.score for r in q.NeighbourVote().fit(docs, labels).score(docs).collect()}
    b = {r.row.doc_id: r.score for r in q.NeighbourVote().fit(docs, turned).score(docs).collect()}
    assert a == b


def test_equal_texts_have_equal_scores_whatever_else_they_have(spark):
    rows, labels = _tables(spark)
    rows.append((500, rows[0][1], "fr", "z", 7, (2,), "y"))
    docs = table(spark, rows)
    got = {r.row.doc_id: r.score for r in q.NeighbourVote().fit(docs, labels).score(docs).collect()}
    assert got[500] == got[0]


def test_without_labels_or_rows(spark):
    rows, labels = _tables(spark)
    docs = table(spark, rows)
    none = q.NeighbourVote().fit(docs, labels.where("false")).score(docs)
    assert {r.score for r in none.collect()} == {0.5}
    good = q.NeighbourVote().fit(docs, labels.where("quality = 1")).score(docs)
    assert {round(r.score, 9) for r in good.collect()} == {1.0}
    assert q.accepted(empty(spark), labels).collect() == []


def test_accepted_keeps_columns(spark):
    rows, labels = _tables(spark)
    kept = q.accepted(table(spark, rows), labels)
    assert kept.schema == table(spark, rows).schema
    assert {r.doc_id for r in kept.collect()} == {i for i in range(160) if i % 4}


def _peak(make):
    tracemalloc.start()
    try:
        for _ in make():
            pass
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_many_short_texts():
    texts = pa.array([prose(i, 20) for i in range(2000)])
    batch = pa.record_batch({"doc_id": pa.array(range(2000), pa.int64()), "text": texts})
    learn = pa.record_batch({"text": texts, "y": pa.array([i % 2 for i in range(2000)], pa.int32())})
    matrix = 2000 * q.WIDTH * 4
    assert _peak(lambda: q._fit(8)([learn])) < 2 * matrix
    parts = {b["kind"][0].as_py(): b["data"][0].as_py() for b in q._fit(8)([learn.slice(0, 100)])}
    model = SimpleNamespace(value={
        "prior": 0.5, "idf": np.frombuffer(parts["idf"], np.float32), "labels": np.ones(100), "weights": np.ones(100),
        "space": np.frombuffer(parts["space"], np.float32).reshape(q.WIDTH, -1),
        "vectors": np.frombuffer(parts["vectors"], np.float32).reshape(100, -1)})
    assert _peak(lambda: q._scored(model, 15, 4)([batch])) < 2 * matrix
