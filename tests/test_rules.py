import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL, plan, rows

from celltide.operators import clean, features, sequences
from celltide.operators import rules as R
from celltide.operators.history import prior_n
from celltide.plans import views

SCHEMA = (
    "cell_id long, band string, event_time timestamp, ues_usage double, throughput_mbps double, "
    "rsrp double, rsrq double, sinr double, max_capacity long"
)
T0 = dt.datetime(2024, 1, 1, 23, 50)


def reading(i=0, ues=50.0, tput=100.0, rsrp=-90.0, rsrq=-10.0, sinr=10.0, cap=100, cell=1,
            minutes=5):
    return (cell, "Band 29", T0 + dt.timedelta(minutes=minutes * i), ues, tput, rsrp, rsrq, sinr, cap)


def last_kinds(spark, data):
    df = R.detect(spark.createDataFrame(data, SCHEMA))
    row = df.orderBy(F.desc("event_time"), F.desc("throughput_mbps")).first()
    return [a.anomaly_type for a in row.anomalies]


@pytest.mark.parametrize("change,expected", [
    (dict(ues=96.0), [R.PRB]), (dict(ues=95.0), []), (dict(ues=85.0, cap=98), []),
    (dict(ues=5.0, cap=0), [R.PRB_ERROR]), (dict(ues=0.0, cap=0), []),
    (dict(ues=5.0, cap=None), []), (dict(ues=5.0, cap=-3), [R.PRB_ERROR]),
    (dict(rsrp=-110.1), [R.RSRP]), (dict(rsrp=-110.0), []),
    (dict(sinr=-0.1), [R.SINR]), (dict(sinr=0.0), []),
    (dict(ues=0.0, tput=0.0, sinr=-10.0, rsrp=-120.0, rsrq=-20.0), [R.RSRP, R.SINR, R.OUTAGE]),
    (dict(ues=0.0, tput=0.0, sinr=0.0, rsrp=0.0, rsrq=0.0), []),
    (dict(ues=None, tput=None, rsrp=float("nan"), sinr=None), []),
])
def test_single_reading_limits(spark, change, expected):
    assert last_kinds(spark, [reading(**change)]) == expected


@pytest.mark.parametrize("before,now,expected", [
    ([(50, 200), (50, 210), (50, 190)], (50, 50), [R.THROUGHPUT]),
    ([(50, 200), (50, 210), (50, 190)], (50, 120), []),
    ([(50, 100)] * 3, (10, 100), [R.UES]),
    ([(50, 100)] * 3, (30, 100), []),
    ([(0, 100)] * 3, (90, 100), []),
    ([(50, 200), (50, 210)], (10, 5), []),
    ([(50, None), (50, 200), (50, 200)], (50, 50), [R.THROUGHPUT]),
])
def test_limits_against_history(spark, before, now, expected):
    data = [reading(i, float(u), None if t is None else float(t)) for i, (u, t) in enumerate(before)]
    data.append(reading(len(before), float(now[0]), float(now[1])))
    assert last_kinds(spark, data) == expected


def test_history_with_equal_times(spark):
    two_share = [reading(0, 50.0, 200.0), reading(0, 50.0, 210.0), reading(1, 50.0, 190.0),
                 reading(2, 50.0, 50.0)]
    assert last_kinds(spark, two_share) == [R.THROUGHPUT]
    same_time = [reading(0, 50.0, 200.0), reading(1, 50.0, 210.0), reading(2, 50.0, 190.0),
                 reading(2, 50.0, 50.0)]
    df = R.detect(spark.createDataFrame(same_time, SCHEMA))
    got = {(r.throughput_mbps, r.prior_count) for r in df.collect()}
    assert got == {(200.0, 0), (210.0, 1), (190.0, 2), (50.0, 2)}


def test_bad_text_in_history_skips_its_rule(spark):
    data = [(*reading(i, 50.0, 200.0), i == 1) for i in range(3)] + [(*reading(3, 5.0, 5.0), False)]
    df = spark.createDataFrame(data, SCHEMA + ", bad_throughput boolean")
    row = R.detect(df).orderBy(F.desc("event_time")).first()
    assert [a.anomaly_type for a in row.anomalies] == [R.UES]


def test_texts(spark):
    data = [reading(i, 50.0, 200.0) for i in range(3)] + [
        reading(3, 96.0, 50.0, rsrp=-111.17, sinr=-3.0)]
    row = R.detect(spark.createDataFrame(data, SCHEMA)).orderBy(F.desc("event_time")).first()
    assert [a.text for a in row.anomalies] == [
        "High PRB Utilization: 96.00% > 95.0%",
        "Low RSRP: -111.17 dBm < -110 dBm",
        "Low SINR: -3.0 dB < 0 dB",
        "Throughput Drop: 50.00 Mbps (Current) vs. 200.00 Mbps (Avg Prior 3) - drop > 50%",
        "UEs Spike/Drop: 96.0 UEs (Current) vs. 50.00 UEs (Avg Prior 3) - change > 50%",
    ]
    zero = R.detect(spark.createDataFrame([
        reading(0, 5.0, cap=0), reading(0, 0.0, 0.0, -121.0, -20.0, -10.0, cell=2)], SCHEMA))
    texts = {a.text for r in zero.collect() for a in r.anomalies}
    assert "PRB Utilization Error: UEs Usage (5.0) with Zero Max Capacity (0)." in texts
    assert ("Cell Outage: UEs=0, Tput=0, SINR<=-10 (-10.0), RSRP<=-120 (-121.0), RSRQ<=-20 (-20.0)"
            in texts)


def test_ten_row_sample(spark):
    figures = [(-84.36, 14.98), (-104.18, 8.12), (-83.97, 17.69), (-97.23, 17.31), (-116.26, 6.66),
               (-118.92, -5.11), (-110.24, 24.66), (-101.57, 18.67), (-102.33, 2.01), (0.0, 0.0)]
    data = [(i, "Band 29", T0, None, 10.0, r, None, s, 90) for i, (r, s) in enumerate(figures)]
    long = R.anomalies_long(R.detect(spark.createDataFrame(data, SCHEMA)))
    assert rows(long, "cell_id", "anomaly_type") == [
        (4, R.RSRP), (5, R.RSRP), (5, R.SINR), (6, R.RSRP)]


def brute_prior(data, n):
    out = []
    for cell, t, v, w in data:
        older = sorted(
            (x for x in data if x[0] == cell and x[1] < t),
            key=lambda x: (x[1], (x[2] is not None, x[2] or 0), (x[3] is not None, x[3] or 0)))
        out.append((cell, t, v, w, [(x[2], x[3]) for x in older[-n:]]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("seed,n,spread", [(1, 3, 400_000), (2, 3, 40), (3, 9, 500_000), (4, 1, 8)])
def test_prior_n_against_brute_force(spark, seed, n, spread):
    rng = random.Random(seed)
    data = []
    for _ in range(400):
        cell = 1 if rng.random() < 0.6 else rng.randint(2, 6)
        t = T0 + dt.timedelta(seconds=rng.randint(0, spread))
        data.append((cell, t, rng.choice([None, float(rng.randint(0, 9))]), float(rng.randint(0, 3))))
    data += data[:30]
    df = spark.createDataFrame(data, "cell_id long, event_time timestamp, a double, b double")
    got = prior_n(df, n, ("cell_id",), "event_time", ("a", "b"))
    told = sorted(((r.cell_id, r.event_time, r.a, r.b, [(p.a, p.b) for p in r.prior])
                   for r in got.collect()), key=repr)
    assert told == brute_prior(data, n)


def test_rows_without_key_or_time_stay(spark):
    df = spark.createDataFrame([(None, T0, 1.0), (None, T0 + dt.timedelta(1), 1.0), (1, None, 2.0), (1, T0, 3.0)],
                               "cell_id long, event_time timestamp, a double")
    got = prior_n(df, 3, ("cell_id",), "event_time", ("a",))
    assert sorted(len(r.prior) for r in got.collect()) == [0, 0, 0, 0]


def test_history_of_a_hot_key(spark):
    """One key holds half the rows."""
    hot = spark.range(4000).selectExpr(
        "if(id % 2 = 0, -1, id) AS cell_id", "timestamp_seconds(1704067200 + id * 600) AS event_time",
        "cast(id AS double) AS a")
    got = prior_n(hot, 3, ("cell_id",), "event_time", ("a",))
    told = {r.a: [p.a for p in r.prior] for r in got.where("cell_id = -1").collect()}
    assert told[1000.0] == [994.0, 996.0, 998.0] and told[0.0] == [] and len(told) == 2000



def test_history_plan(spark):
    text = plan(R.with_history(views.valid_kpi(spark, SMALL)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "Python" not in text


def test_sequences(spark):
    data = [(1, T0 + dt.timedelta(hours=i), float(i), 1.0) for i in range(30)]
    df = spark.createDataFrame(
        data, "cell_id long, event_time timestamp, throughput_mbps double, ues_usage double"
    ).withColumn("band", F.lit("Band 29"))
    seq = sequences.sequences(df)
    got = {r.throughput_mbps: [s.throughput_mbps for s in r.sequence] for r in seq.collect()}
    assert got == {float(i): [float(j) for j in range(i - 9, i + 1)] for i in range(9, 30)}
    before = sequences.sequences(df, own_row=False)
    got = {r.throughput_mbps: [s.throughput_mbps for s in r.sequence] for r in before.collect()}
    assert got == {float(i): [float(j) for j in range(i - 10, i)] for i in range(10, 30)}
    scored = sequences.sequence_score(seq, ("throughput_mbps", "ues_usage"), cut=1.0)
    assert {(round(r.score, 6), r.is_anomaly) for r in scored.collect()} == {(1.25, True)}


def test_minmax_of_a_constant_column(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    got = rows(sequences.minmax(df, ["a", "b"]), "a_scaled", "b_scaled")
    assert got == [(0.0, 0.0), (1.0, 0.0), (None, 0.0)]


def test_cleaning(spark):
    df = spark.createDataFrame([
        ("1", "2024-01-01 00:00:00.7", "5", "60.5", None, None),
        ("x", "2024-01-01 00:00:00", "5", "60", "Band 29", "rural"),
        ("2", "bad", "5", "60", "Band 29", "rural"),
        ("3", "2024-01-01 00:00:00", "oops", "61.5", "Band 29", "rural"),
    ], "cell_id string, event_time string, ues_usage string, max_capacity string, band string, "
       "area_type string")
    got = rows(clean.clean_kpi(df), "cell_id", "event_time", "ues_usage", "max_capacity", "band",
               "area_type")
    t = dt.datetime(2024, 1, 1)
    assert got == [(1, t, 5.0, 60, "Unknown Band", "Unknown Area"), (3, t, 0.0, 62, "Band 29", "rural")]
    commas = spark.createDataFrame([("1,234.5", "1"), ("x", "2")], "a string, b string")
    assert rows(clean.numbers_without_commas(commas, ["a", "b"])) == [(1234.5, 1.0)]


def test_features(spark):
    kpi = views.kpi(spark, SMALL)
    table = features.traffic_features(kpi, wide=True)
    assert set(features.feature_columns(wide=True)) <= set(table.columns)
    assert table.select(sum(F.col(f"dow_{d}".lower()) for d in features.DAY_NAMES).alias("n")
                        ).distinct().collect() == [(1,)]
    text = plan(table)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    train, test = features.split(table)
    again, _ = features.split(table.repartition(7))
    assert train.count() + test.count() == table.count()
    assert rows(train, *features.GROUP_KEYS) == rows(again, *features.GROUP_KEYS)
    empty = features.traffic_grouped(kpi.withColumn("frequency", F.lit(None).cast("string")))
    assert empty.count() == 0
