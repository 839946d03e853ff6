"""Every registered query against its reference SQL on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import types as T
from tests.conftest import SMALL

import __spark_entry__ as entry_points
from celltide import schemas
from celltide.operators import rollups
from celltide.plans import views
from celltide.plans.queries import QUERIES as OWN

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
# The operators in llm have tests of their own.
QUERIES = {k: q for k, q in entry_points.queries().items() if k in OWN}
ORACLES = {k: s for k, s in entry_points.oracle_sql().items() if k in OWN}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() == 976
    assert df.columns[:3] == ["cell_id", "band", "event_ts"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    cursor = duck.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in places)) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_no_pairing_of_everything_with_everything(spark, name):
    text = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


@pytest.mark.parametrize("view,ddl", [
    (views.kpi, schemas.KPI_SCHEMA), (views.du, schemas.DU_SCHEMA),
    (views.event_store, schemas.EVENT_SCHEMA),
])
def test_views_have_the_schemas_of_the_data_model(spark, view, ddl):
    kinds = dict(view(spark, SMALL).dtypes)
    for field in T._parse_datatype_string(ddl).fields:
        assert kinds[field.name] == field.dataType.simpleString()


def test_feed_has_the_schema_of_the_data_model(spark):
    parts = [
        rollups.feed_anomalies(views.anomaly_rows(spark, SMALL), views.as_of()),
        rollups.feed_calls(views.calls(spark, SMALL)),
        rollups.feed_remediation(views.remediations(spark, SMALL), views.as_of()),
    ]
    kinds = dict(rollups.feed(*parts).dtypes)
    wanted = T._parse_datatype_string(schemas.FEED_SCHEMA).fields
    for field in wanted:
        if field.name in kinds:
            assert kinds[field.name] == field.dataType.simpleString()
    assert set(kinds) <= {f.name for f in wanted}


def test_forests_learn_something(spark):
    from celltide.operators import features, forecast

    train, test = features.split(features.traffic_features(views.kpi(spark, SMALL)))
    found = forecast.evaluate(*forecast.train_traffic(train, trees=20), test)
    metrics = {(r.model, r.metric): r.value for r in found.collect()}
    assert metrics["classifier", "accuracy"] > 0.9
    assert 0 < metrics["regressor", "mae"] < 40


def test_models_can_be_saved(spark, tmp_path):
    from celltide.operators import features, forecast

    table = features.traffic_features(views.kpi(spark, SMALL))
    models = forecast.train_traffic(table, trees=3, depth=3)
    forecast.save_models(*models, str(tmp_path))
    forecast.save_models(*models, str(tmp_path))
    again = forecast.load_models(str(tmp_path))
    asked = views.kpi(spark, SMALL).select("cell_id", "event_time").distinct()
    first = forecast.forecast(asked, *models).orderBy("cell_id", "event_time").collect()
    second = forecast.forecast(asked, *again).orderBy("cell_id", "event_time").collect()
    assert first == second and os.path.exists(tmp_path / "traffic_regressor_model")
    assert {r.threshold for r in first} == {80.0}
    assert len({r.predicted_ues_usage for r in first}) > 1


def test_trees_as_sql_predict_what_the_forests_predict(spark):
    """Trained forests, their trees as columns, and their trees as SQL in another engine: the same values."""
    from celltide.operators import features, forecast

    train, test = features.split(features.traffic_features(views.kpi(spark, SMALL)))
    models = forecast.train_traffic(train, trees=7, depth=5)
    assert not models[1].stages[-1].hasSummary
    trees = [forecast.trees_of(m) for m in models]

    def told(usage, busy):
        scored = forecast.predict_class(forecast.predict_usage(test, usage), busy)
        return {(r.cell_id, r.event_ts, r.frequency): (r.predicted_usage, r.predicted_class, r.confidence) for r in scored.collect()}

    by_model, by_columns = told(*models), told(*trees)
    con = duckdb.connect()
    frame = test.toPandas()
    con.register("held", frame)
    usage, busy = map(forecast.forest_sql, trees)
    by_sql = {(r[0], r[1], r[2]): r[3:] for r in con.execute(
        f"SELECT cell_id, event_ts, frequency, {usage}, ({busy} > 0.5)::INT, {busy} FROM held").fetchall()}
    assert by_model.keys() == by_columns.keys() == by_sql.keys() and len(by_model) > 100
    for key, value in by_model.items():
        assert by_columns[key] == pytest.approx(value, abs=1e-9) == by_sql[key]
    assert len({v[0] for v in by_model.values()}) > 20 and {v[1] for v in by_model.values()} == {0, 1}
