import pyarrow as pa
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from celltide.llm.jaccard_join import JaccardJoin
from celltide.llm.queries import ORACLES, QUERIES
from celltide.session import BATCH_BYTES, small_batches
from tests.llm.helpers import awkward, components, table

SF = "/root/testdata/sf0.001"


def test_registered_queries():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert names["pipeline"] is corpus_pipeline.run and set(ORACLES) <= set(QUERIES)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{i}"
        stage(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        if i + 1 < len(corpus_pipeline.STAGES):
            assert docs.columns == columns
        seen[name] = (before, docs)

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    before, after = seen["quality classifier"]
    kept = {r.doc_id for r in after.collect()}
    known = [r.doc_id for r in before.collect() if r.doc_id in labels]
    assert sum((i in kept) == (labels[i] == 1) for i in known) >= 0.95 * len(known)

    before, after = seen["n-gram Jaccard join"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert sorted(r.doc_id for r in after.collect()) == sorted({c for _, _, c in components(rows)})

    before, after = seen["mixing sources to target weights"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}

    before, after = seen["best-fit packing"]
    first = after.where("piece = 0")
    assert first.count() == before.count()
    fill = after.groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in fill) <= 2048
    assert len(fill) <= sum(r[1] for r in fill) // 2048 + 2


def test_run_gives_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_texts_go_to_python_in_small_batches(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.range(0, 6000, 1, 1).select("id", F.repeat(F.lit("word "), 500).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"n": pa.array([batch.nbytes], pa.int64())})

    try:
        spark.conf.unset(key)
        stage = corpus_pipeline.staged(lambda session, rows, sf_dir: rows.mapInArrow(sizes, "n BIGINT"))
        assert max(r.n for r in stage(spark, docs, SF).collect()) <= BATCH_BYTES + (1 << 20)
        spark.conf.set(key, "1m")
        small_batches(spark)
        assert spark.conf.get(key) == "1m"
        spark.conf.unset(key)
        JaccardJoin(table(spark, awkward()))
        assert spark.conf.get(key) == str(BATCH_BYTES)
    finally:
        spark.conf.unset(key)
