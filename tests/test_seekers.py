"""Cells that come in one piece are searched by several tasks."""

from tests.conftest import rows

from celltide.operators import matching


def test_seekers_are_dealt_to_several_tasks(spark, monkeypatch):
    cells = spark.range(3_000, numPartitions=1).selectExpr(
        "id cell_id", "'a' city", "33 + id % 20 / 1000 lat", "-97 + id % 30 / 1000 lon", "array('b') bands")
    files = {}

    def kept(df, name="stage", real=matching.materialize):
        out = real(df, name)
        files.setdefault(name, len(out.inputFiles()))
        return out

    monkeypatch.setattr(matching, "materialize", kept)
    size = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(size, "5000")
    try:
        found = rows(matching.nearest_links(cells, max_group=0))
    finally:
        spark.conf.unset(size)
    assert files["seekers"] > 1
    assert found == rows(matching.nearest_links(cells, max_group=3_000))
