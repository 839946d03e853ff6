"""What a pass over the training rows costs: nothing is worked out twice."""

from tests.conftest import plan

from celltide.operators import features, forecast
from celltide.plans import queries as q


def _table(spark, n=400):
    rows = spark.range(n).selectExpr(
        "id % 7 cell_id", "timestamp_seconds(1700000000 + id * 3600) event_time", "'Band 26' band", "'850' frequency",
        "double(id * 13 % 60) ues_usage")
    return features.traffic_features(rows)


def test_forests_keep_the_nodes_of_their_rows(spark):
    train, _ = features.split(_table(spark))
    for model in (forecast.train_regressor(train, 2, depth=2), forecast.train_classifier(train, 2, depth=2)):
        assert model.stages[-1].getCacheNodeIds()


def test_rows_are_stored_with_their_part(spark, tmp_path):
    spark.range(300).selectExpr(
        "id event_id", "timestamp_seconds(1700000000 + id * 3600) ts", "id % 7 user_id", "'view' event_type",
        "double(id) value", "'{}' props").write.parquet(f"{tmp_path}/events.parquet")
    train, test = q._parts(spark, str(tmp_path))
    assert "md5" not in plan(train) + plan(test)
    again = features.split(q.features.traffic_features(q.v.kpi(spark, str(tmp_path))))
    for got, want in zip((train, test), again):
        assert got.columns == want.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert not train.isEmpty() and not test.isEmpty()
