"""The event table that is folded range by range."""

import pytest
from tests.conftest import plan, rows

from celltide.operators.eventstore import with_active
from celltide.session import scratch_path
from celltide.streaming.versions import EventTable

EVENTS = "id BIGINT, cell_id BIGINT, creation_date TIMESTAMP, event STRING, data STRING, active INT"


def events(spark, items):
    """(id, cell, hour, active) as events."""
    text = [(i, c, f"2024-01-01 {h:02d}:00:00", "e", None, a) for i, c, h, a in items]
    return spark.createDataFrame(text, EVENTS.replace("TIMESTAMP", "STRING")).selectExpr(
        "id", "cell_id", "timestamp(creation_date) creation_date", "event", "data", "active")


def resolved(spark, items):
    text = [(c, f"2024-01-01 {h:02d}:00:00") for c, h in items]
    return spark.createDataFrame(text, "cell_id BIGINT, resolved_at STRING").selectExpr(
        "cell_id", "timestamp(resolved_at) resolved_at")


FIRST = [(1, 1, 1, 1), (2, 1, 5, 1), (3, 25, 2, 1), (4, None, 3, 1), (5, -7, 1, 1), (6, 25, 9, 0), (6, 25, 9, 0)]
SECOND = [(7, 1, 2, 1), (8, 1, 9, 1), (9, 47, 1, 1), (10, -7, 8, 1)]


@pytest.fixture
def table(spark):
    made = EventTable(spark, scratch_path(spark, "versions"), span=10)
    made.append(0, events(spark, FIRST), resolved(spark, [(1, 3), (1, 2), (None, 23)]))
    return made


def want(spark, items, closed):
    return rows(with_active(events(spark, items), resolved(spark, closed)), "id", "cell_id", "active")


def got(df):
    return rows(df, "id", "cell_id", "active")


def test_folding_changes_no_row(spark, table):
    before = want(spark, FIRST, [(1, 3), (None, 23)])
    assert got(table.events()) == before
    table.fold()
    assert got(table.events()) == before
    assert got(table.active_events()) == [r for r in before if r[2] == 1]
    assert rows(table.resolutions(), "cell_id").count((1,)) == 1


def test_late_events_meet_folded_resolutions_and_the_other_way_round(spark, table):
    table.fold()
    table.append(1, events(spark, SECOND), resolved(spark, [(25, 4), (-7, 8)]))
    both = want(spark, FIRST + SECOND, [(1, 3), (25, 4), (-7, 8)])
    assert got(table.events()) == both
    table.fold(20, 29)
    assert got(table.events()) == both
    assert table.manifest().ranges["2"] == (1, 1) and table.manifest().ranges["0"] == (0, 0)
    table.fold()
    assert got(table.events()) == both and got(table.active_events()) == [r for r in both if r[2] == 1]


def test_readers_of_an_older_manifest_see_their_files(spark, table):
    old = table.fold()
    before = got(table.events(old))
    table.append(1, events(spark, SECOND), None)
    held = table.events(old)
    new = table.fold()
    assert table.vacuum(keep=2) > 0
    # The older manifest still has its folded files; the batch after it is kept for it as well.
    assert got(held) == got(table.events(new)) == got(table.events(old))
    assert len(before) < len(got(held))
    assert table.vacuum() > 0
    assert got(table.events()) == got(held.sparkSession.createDataFrame(
        [(i, c, a) for i, c, a in want(spark, FIRST + SECOND, [(1, 3)])], "id BIGINT, cell_id BIGINT, active INT"))


def test_a_fold_that_failed_comes_again(spark, table, monkeypatch):
    before = got(table.events())
    with monkeypatch.context() as m:
        m.setattr(spark, "createDataFrame", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.fold()
    assert table.manifest().number == -1 and got(table.events()) == before
    assert table.fold().number == 0 and got(table.events()) == before
    assert table.fold().number == 0  # nothing waits


def test_a_batch_that_comes_again_replaces_itself(spark, table):
    table.append(0, events(spark, FIRST), resolved(spark, [(1, 3)]))
    assert len(got(table.events())) == len(FIRST)


def test_empty_tables(spark):
    table = EventTable(spark, scratch_path(spark, "versions"))
    assert got(table.events()) == got(table.active_events()) == []
    assert table.fold().number == -1 and table.vacuum() == 0
    table.append(0, events(spark, []), resolved(spark, []))
    assert got(table.events()) == [] and table.fold().number == -1
    table.append(1, resolutions=resolved(spark, [(3, 1)]))
    table.fold()
    table.append(2, events(spark, [(1, 3, 1, 1), (2, 3, 2, 1)]))
    assert got(table.active_events()) == [(2, 3, 1)]


def test_open_events_leave_files_of_closed_ones_alone(spark, table):
    table.fold()
    text = plan(table.active_events())
    assert "open" in text and "PartitionFilters" in text
    files = table._stored(table.manifest(), open_only=True).inputFiles()
    assert files and any("open=0" in f for f in table._stored(table.manifest()).inputFiles())


def test_a_hot_cell_is_folded_by_several_tasks(spark):
    table = EventTable(spark, scratch_path(spark, "versions"), span=10)
    many = spark.range(20_000).selectExpr(
        "id", "bigint(if(id % 3 = 0, id % 500, 7)) cell_id", "timestamp_seconds(id) creation_date",
        "repeat(uuid(), 4) event", "string(null) data", "1 active")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200000")
    try:
        table.append(0, many, resolved(spark, []))
        table.fold()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert table.events().count() == 20_000
    hot = [f for f in table._stored(table.manifest()).inputFiles() if "range=0/" in f]
    assert len(hot) > 1


def test_files_do_not_grow_with_the_number_of_ranges(spark):
    table = EventTable(spark, scratch_path(spark, "versions"), span=1)
    wide = spark.range(2_000, numPartitions=4).selectExpr(
        "id", "id % 1000 cell_id", "timestamp_seconds(id) creation_date", "'e' event", "string(null) data",
        "int(id % 3 > 0) active")
    closed = spark.range(0, 1_000, 7).selectExpr("id cell_id", "timestamp_seconds(id + 500) resolved_at")
    table.append(0, wide, closed)
    assert len(table._stored(table.manifest()).inputFiles()) <= 64
    before = rows(with_active(wide, closed), "id", "cell_id", "active")
    assert got(table.events()) == before
    low = table.fold(990, 999)
    assert 0 < len(low.ranges) <= 10 and got(table.events()) == before
    assert len(table.fold().ranges) <= 64 and got(table.events()) == before
    assert table.vacuum() <= 2 * 64 * 3 and got(table.events()) == before
