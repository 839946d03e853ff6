import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F
from tests.conftest import SMALL, plan, rows

from celltide.operators import eventstore, matching, rollups, topology
from celltide.plans import views

BANDS = ["Band 29", "Band 26", "Band 71", "Band 66"]
CELLS = "cell_id long, city string, lat double, lon double, bands array<string>, wanted int"


def brute_links(cells):
    """Every pair of a city in order, granted while both ends want one."""
    def km(a, b):
        p1, p2, dl = math.radians(a[2]), math.radians(b[2]), math.radians(b[3] - a[3])
        x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
        return round(2 * 6371 * math.atan2(math.sqrt(x), math.sqrt(1 - x)), 9)

    pairs = []
    for i, a in enumerate(cells):
        for b in cells[i + 1:]:
            shared = len(set(a[4]) & set(b[4]))
            if a[1] == b[1] and shared:
                pairs.append((km(a, b), -shared, a[0], b[0]))
    open_ = {c[0]: c[5] for c in cells}
    links = []
    for _, _, a, b in sorted(pairs):
        if open_[a] and open_[b]:
            open_[a] -= 1
            open_[b] -= 1
            links.append((a, b))
    return sorted(links)


def some_cells(n, crowded):
    rng = random.Random(n)
    places = [(33.0, -97.0)] * 5 + [(33.01, -97.0), (33.02, -97.01)]
    out = []
    for i in range(n):
        free = (33 + rng.random() * 0.03, -97 + rng.random() * 0.03)
        lat, lon = rng.choice(places + [free]) if crowded else free
        out.append((i, "A" if i % 3 else "B", lat, lon, rng.sample(BANDS, rng.randint(1, 3)),
                    rng.randint(1, 3)))
    return out


@pytest.mark.parametrize("n,crowded", [(60, False), (120, True)])
def test_links_one_task_per_city(spark, n, crowded):
    cells = some_cells(n, crowded)
    links = matching.match_neighbours(spark.createDataFrame(cells, CELLS))
    assert sorted((r.a, r.b) for r in links.collect()) == brute_links(cells)


@pytest.mark.parametrize("n,crowded,chunk", [(60, False, 50), (120, True, 8)])
def test_links_of_large_cities_are_the_same(spark, n, crowded, chunk):
    cells = some_cells(n, crowded)
    links = matching.match_neighbours(
        spark.createDataFrame(cells, CELLS), max_group=0, max_cube=8, chunk=chunk)
    assert sorted((r.a, r.b) for r in links.collect()) == brute_links(cells)


def test_a_chain_of_waiting_links_takes_few_rounds(spark, monkeypatch):
    """Equal steps on a line: each link waits for the one before it."""
    cells = [(i, "A", 33.0, -97.0 + i / 1000, ["Band 29"], 1 + (i % 7 == 0)) for i in range(1000)]
    rounds, write = [], matching.materialize

    def counted(df, name):
        rounds.append(name)
        return write(df, name)

    monkeypatch.setattr(matching, "materialize", counted)
    df = spark.createDataFrame(cells, CELLS)
    links = matching.match_neighbours(df, max_group=0)
    got = {(r.a, r.b) for r in links.collect()}
    assert rounds.count("ring-links") <= 20
    want = {(r.a, r.b) for r in matching.match_neighbours(df).collect()}
    assert got == want


def test_many_bands(spark):
    cells = [(i, "A", 33.0 + i / 1000, -97.0, [f"own {i}", f"own {(i + 1) % 50}"], 2) for i in range(50)]
    df = spark.createDataFrame(cells, CELLS)
    want = brute_links(cells)
    for size in (2000, 0):
        links = matching.match_neighbours(df, max_group=size, max_cube=8)
        assert sorted((r.a, r.b) for r in links.collect()) == want


def test_links_are_symmetric_and_within_degree(spark):
    cells = views.cells(spark, SMALL)
    table = matching.adjacency(matching.match_neighbours(cells), cells)
    assert table.count() == cells.count()
    assert table.where(F.size("adjacent_cells") > F.col("wanted")).count() == 0
    audit = topology.audit_topology(table)
    assert audit.count() > 0 and audit.where("NOT is_ok").count() == 0
    stats = topology.degree_stats(table).first()
    assert stats.max_degree <= 3 and stats.cells == 150


def test_cells_without_city_or_partner_have_no_links(spark):
    cells = [(1, None, 33.0, -97.0, ["Band 29"], 2), (2, None, 33.0, -97.0, ["Band 29"], 2),
             (3, "A", 33.0, -97.0, ["Band 29"], 2), (4, "A", 33.0, -97.0, ["Band 26"], 2)]
    df = spark.createDataFrame(cells, CELLS)
    links = matching.match_neighbours(df)
    assert links.count() == 0
    assert [len(r.adjacent_cells) for r in matching.adjacency(links, df).collect()] == [0] * 4


@pytest.mark.parametrize("max_group", [2000, 0])
def test_nearest_links(spark, max_group):
    cells = some_cells(120, True)
    got = matching.nearest_links(
        spark.createDataFrame(cells, CELLS), 3, max_group=max_group, max_cube=8)
    want = set()
    for a in cells:
        mine = []
        for b in cells:
            shared = len(set(a[4]) & set(b[4]))
            if a[0] != b[0] and a[1] == b[1] and shared:
                p1, p2, dl = math.radians(a[2]), math.radians(b[2]), math.radians(b[3] - a[3])
                x = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
                mine.append((round(2 * 6371 * math.atan2(math.sqrt(x), math.sqrt(1 - x)), 9), -shared, b[0]))
        want |= {(a[0], b, r + 1) for r, (_, _, b) in enumerate(sorted(mine)[:3])}
    assert {(r.cell_id, r.other, r["rank"]) for r in got.collect()} == want


def test_candidate_counts(spark):
    cells = some_cells(80, True)
    df = spark.createDataFrame(cells, CELLS)
    want = {
        a[0]: sum(1 for b in cells if a[0] != b[0] and a[1] == b[1] and set(a[4]) & set(b[4]))
        for a in cells
    }
    got = topology.candidate_links(df)
    assert {r.cell_id: r.links for r in got.collect()} == want
    text = plan(got)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_audit_finds_every_fault(spark):
    df = spark.createDataFrame([
        (1, "A", 33.0, -97.0, ["x"], [2]), (2, "A", 33.0, -97.0, ["x"], [1, 3, 4, 5]),
        (3, "B", 33.0, -97.0, ["x"], [2]), (4, "A", 33.0, -97.0, ["y"], [2]),
        (5, "A", 33.0, -97.0, ["x"], []), (6, "A", 33.0, -97.0, ["x"], [99]),
    ], "cell_id long, city string, lat double, lon double, bands array<string>, adjacent_cells array<long>")
    got = {(r.cell_id, r.adjacent_cell): r for r in topology.audit_topology(df).collect()}
    assert not got[1, 2].neighbour_degree_ok and got[1, 2].is_mutual
    assert not got[2, 3].same_city and not got[2, 4].shares_band
    assert not got[2, 5].is_mutual and not got[2, 1].degree_ok
    assert not got[6, 99].is_known and got[6, 99].distance_km is None
    assert not any(r.is_ok for r in got.values())


def test_sentences_and_counts(spark):
    df = spark.createDataFrame([(1, "A", "rural", None, ["x", "y"])],
                               "cell_id long, city string, area_type string, max_capacity long, bands array<string>")
    row = topology.cell_sentences(df).first()
    assert row.page_content == "Cell 1 in city A is an rural area with capacity unknown and bands: x, y."
    assert row.metadata.city == "A"
    assert rows(topology.topology_counts(df)) == [
        ("area_type", "rural", 1), ("band", "x", 1), ("band", "y", 1), ("city", "A", 1)]


T = dt.datetime(2024, 1, 1)


def anomalies(spark, data):
    return spark.createDataFrame(
        data, "cell_id long, band int, anomaly_type string, anomaly string, source_id string, "
              "creation_date timestamp, item_no int")


def test_summary_first_wins_on_equal_dates(spark):
    df = anomalies(spark, [
        (1, 29, "Low SINR", "first", "7", T, 1), (1, 29, "Low RSRP", "second", "7", T, 2),
        (1, 29, "Low RSRP", "older", "6", T - dt.timedelta(1), 1)])
    row = rollups.anomaly_summary(df).first()
    assert (row.anomaly_count, row.types, row.latest_anomaly) == (3, ["Low RSRP", "Low SINR"], "first")
    assert rollups.get_anomaly(rollups.anomaly_summary(df), 2).count() == 0


def test_health_and_markers(spark):
    towers = spark.createDataFrame(
        [(1, "up"), (2, "down"), (3, "up"), (4, "up"), (5, "down")], "id long, status string")
    found = anomalies(spark, [(1, 29, "a", "b", "c", T, 1), (5, 29, "a", "b", "c", T, 1)] * 3)
    row = rollups.network_health(towers, found).first()
    assert tuple(row) == (5, 3, 2, 2, 40, "poor")
    activity = spark.createDataFrame([(3, 2.0), (4, 1.9)], "cell_id long, drop_rate double")
    marks = rollups.marker_status(towers, found, activity)
    assert rows(marks, "id", "marker") == [
        (1, "anomaly"), (2, "down"), (3, "drops"), (4, "ok"), (5, "anomaly")]
    empty = rollups.network_health(towers.where("false"), found).first()
    assert tuple(empty) == (0, 0, 0, 0, 0, "poor")


def test_feeds(spark):
    now = F.lit(dt.datetime(2024, 1, 2)).cast("timestamp")
    texts = spark.createDataFrame(
        [(1, 29, "t", "x", "s", "2024-01-01T00:00:00Z"), (1, 29, "t", "x", "s", "2025-01-01"),
         (2, 29, "t", "x", "s", "soon")],
        "cell_id long, band int, anomaly_type string, anomaly string, source_id string, creation_date string")
    feed = rollups.feed_anomalies(texts, now)
    assert [r.timestamp for r in feed.orderBy("timestamp").collect()] == [
        T, dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 2)]
    calls = spark.createDataFrame([(T, (1.0, 2.0), -80.0, True, None)],
                                  "timestamp timestamp, location struct<lat:double,lng:double>, "
                                  "signal_strength double, is_dropped boolean, cell_id long")
    both = rollups.feed(feed, rollups.feed_calls(calls))
    assert [r.type for r in both.collect()][-1] in ("call-dropped", "anomaly-detected")
    assert rollups.feed(feed, cell=2).count() == 1
    assert rows(rollups.feed_cells(both)) == [("1",), ("2",)]
    blank = spark.createDataFrame([(None, None, None, 3)],
                                  "event_type string, event_time timestamp, description string, cell_id long")
    row = rollups.feed_remediation(blank, now).first()
    assert (row.type, row.message, row.timestamp) == (
        "remediation-started", "Remediation event", dt.datetime(2024, 1, 2))


def test_calls(spark):
    data = [(T + dt.timedelta(minutes=i), i % 4 == 0, 1, i) for i in range(20)]
    calls = spark.createDataFrame(data, "timestamp timestamp, is_dropped boolean, cell_id long, call_id long")
    row = rollups.tower_activity(calls).first()
    assert (row.total_calls, row.dropped_calls, row.drop_rate, row.drop_severity) == (20, 5, 25.0, "critical")
    latest = rollups.latest_calls(calls, 3)
    assert [r.call_id for r in latest.collect()] == [19, 18, 17]
    assert "TakeOrderedAndProject" in plan(latest)
    end = F.lit(T + dt.timedelta(minutes=16)).cast("timestamp")
    assert rows(rollups.recent_dropped(calls, 10, end), "call_id") == [(12,), (16,), (8,)]


def test_recovery(spark):
    data = [("tower-down", 0), ("tower-down", 60), ("tower-up", 150), ("tower-up", 200),
            ("alert-triggered", 210), ("tower-down", 100_000), ("tower-up", 200_000)]
    feed = spark.createDataFrame(
        [(k, T + dt.timedelta(seconds=s), 1) for k, s in data] + [("tower-up", T, 2)],
        "type string, timestamp timestamp, tower_id long")
    row = rollups.avg_recovery(feed).first()
    assert (row.recoveries, row.avg_recovery_seconds) == (2, (90 + 100_000) / 2)
    none = rollups.avg_recovery(feed.where("false")).first()
    assert (none.avg_recovery_seconds, none.avg_recovery_text) == (0.0, "N/A")


def test_event_store(spark):
    events = spark.createDataFrame(
        [(1, 5, T, "a" * 60, "", 1), (2, 5, T + dt.timedelta(1), "b", "", 1), (3, 6, T, "c", "", 0),
         (4, 7, T, "d", "", 1)],
        "id long, cell_id long, creation_date timestamp, event string, data string, active int")
    assert rows(eventstore.active_cells(events)) == [(5,), (7,)]
    assert [r.id for r in eventstore.active_events(events).collect()] == [2, 4, 1]
    latest = eventstore.latest_events(events, 2)
    assert [r.id for r in latest.collect()] == [2, 4]
    assert "TakeOrderedAndProject" in plan(latest)
    at = F.lit(T + dt.timedelta(hours=1)).cast("timestamp")
    fives = spark.createDataFrame([(5,)], "cell_id long")
    resolved, closed = eventstore.resolve(events, fives, at)
    assert closed.first()[0] == 1
    now = eventstore.with_active(events, resolved)
    assert rows(now, "id", "active") == [(1, 0), (2, 1), (3, 0), (4, 1)]
    ranged, closed = eventstore.resolve_range(events, 5, 6, at)
    assert rows(ranged, "cell_id") == [(5,), (6,)] and closed.first()[0] == 1
    everything, closed = eventstore.resolve_all(events, at)
    assert closed.first()[0] == 2
    assert rows(eventstore.with_active(events, everything.union(resolved)), "id", "active")[0] == (1, 0)


def test_bands_outside_the_usual_list_count(spark):
    cells = spark.createDataFrame(
        [(i, "A", 33.0 + i / 100, -97.0, ["Band 12", f"own {i}"], 2) for i in range(4)],
        "cell_id long, city string, lat double, lon double, bands array<string>, wanted int")
    assert matching.match_neighbours(cells).count() == 4
    assert matching.nearest_links(cells, 3).count() == 12
    assert matching.match_neighbours(cells, bands=["Band 29"]).count() == 0
