"""Bounded runs over a log of numbered records."""

import json
import random

import pytest

from celltide.operators.retrieval import chunk_places
from celltide.sources.positions import KafkaLog, Positions, Run, TableLog, run_once, run_until_empty, shares

SCHEMA = "partition INT, offset BIGINT, value STRING"


def _log(spark, rows):
    return TableLog(spark.createDataFrame(rows, SCHEMA))


def _numbers(n, parts=3, first=0):
    return [(i % parts, first + i, f"r{i}") for i in range(n)]


def test_shares_add_up_and_leave_nobody_out():
    rng = random.Random(1)
    for _ in range(500):
        waiting = {p: rng.choice([0, 1, 5, 1000, rng.randrange(10**6)]) for p in range(rng.randrange(1, 9))}
        limit = rng.randrange(1, 2000)
        given = shares(waiting, limit, rng.randrange(9))
        assert sum(given.values()) == min(limit, sum(waiting.values()))
        assert all(0 <= given[p] <= n for p, n in waiting.items())
        asking = [p for p, n in waiting.items() if n]
        if limit >= len(asking):
            assert all(given[p] for p in asking)
    assert shares({0: 5, 1: 7}, None) == {0: 5, 1: 7}
    turns = [p for t in range(4) for p, n in shares(dict.fromkeys(range(4), 9), 1, t).items() if n]
    assert sorted(turns) == [0, 1, 2, 3]


def test_every_record_once_also_after_failed_runs(spark, tmp_path):
    rows, stored, fails = _numbers(100), {}, {1, 3}
    positions = Positions(spark, f"{tmp_path}/p")

    def work(records, number):
        stored[number] = [r.value for r in records.collect()]
        if number in fails:
            fails.discard(number)
            raise InterruptedError

    for _ in range(2):
        with pytest.raises(InterruptedError):
            run_until_empty(_log(spark, rows), positions, work, 30)
    before = dict(stored)
    rows += _numbers(20, 3, 100)  # what arrives meanwhile is not part of the failed run's range
    assert run_once(_log(spark, rows), positions, work, 30).number == 3 and stored[3] == before[3]
    run_until_empty(_log(spark, rows), positions, work, 30)
    assert sorted(v for n in stored for v in stored[n]) == sorted(r[2] for r in rows)
    assert [len(stored[n]) <= 30 for n in stored] == [True] * len(stored)
    assert run_once(_log(spark, rows), positions, work, 30) is None


def test_new_partitions_gaps_and_dropped_records(spark, tmp_path):
    positions, seen = Positions(spark, f"{tmp_path}/p"), []

    def work(records, number):
        seen.append(sorted(r.value for r in records.collect()))

    assert run_once(_log(spark, []), positions, work) is None
    run_once(_log(spark, [(0, 5, "a"), (0, 9, "b"), (None, 1, "no part"), (0, None, "no place")]), positions, work)
    # The log drops 10 and 11 before they are read, and has a new partition.
    run_once(_log(spark, [(0, 12, "c"), (4, 0, "d"), (4, 70, "e")]), positions, work)
    assert seen == [["a", "b"], ["c", "d", "e"]]
    assert positions.done() == {0: 13, 4: 71}
    with pytest.raises(ValueError):
        run_once(_log(spark, [(0, 13, "x")]), positions, work, 0)


def test_ranges_reach_the_scan(spark, tmp_path):
    _ = spark.createDataFrame(_numbers(50), SCHEMA).write.parquet(f"{tmp_path}/log")
    log = TableLog(spark.read.parquet(f"{tmp_path}/log"))
    run = Run(4, {0: 3, 1: 4, 2: 8}, {0: 9, 1: 4, 2: 20})
    text = log.read(run)._jdf.queryExecution().executedPlan().toString()
    pushed = text.split("PushedFilters: ")[1]  # Spark shortens long lists of filters
    assert "Equal(offset,3)),LessThan(offset,9)" in pushed and run.limit == 18
    assert {r.offset for r in log.read(run).collect()} == {3, 6, 8, 11, 14, 17}


def test_ranges_as_options_of_a_topic(spark):
    bounds = KafkaLog(spark, {}, "ran").bounds(Run(0, {0: 3, 1: 0}, {0: 9, 1: 4}))
    assert bounds["subscribe"] == "ran"
    assert json.loads(bounds["startingOffsets"]) == {"ran": {"0": 3, "1": 0}}
    assert json.loads(bounds["endingOffsets"]) == {"ran": {"0": 9, "1": 4}}


def test_places_of_chunks_show_what_is_lost_or_swapped(spark):
    text = "one two\n\nthree four  five"
    docs = spark.createDataFrame([(1, text)], "doc_id BIGINT, text STRING")

    def signs(*pieces):
        rows = [(1, n, p) for n, p in enumerate(pieces, 1)]
        chunks = spark.createDataFrame(rows, "doc_id BIGINT, chunk_no INT, chunk_text STRING")
        return "".join(r.fresh for r in chunk_places(docs, chunks).orderBy("chunk_no").collect())

    whole = "onetwothreefourfive"
    assert signs("one two", "three four", "five") == whole
    assert signs("one two", "two\n\nthree", "three four  five") == whole  # overlaps count once
    assert signs("one two", "five") != whole  # one is missing
    assert signs("three four", "one two", "five") != whole  # swapped
    assert chunk_places(docs, spark.createDataFrame([], "doc_id BIGINT, chunk_no INT, chunk_text STRING")).count() == 0


def test_a_table_in_one_row_group_is_read_by_several_tasks(spark, tmp_path):
    """The runs' lines are made and parsed by all tasks, however the table lies."""
    from celltide.plans import queries as q

    one = spark.range(6_000, numPartitions=1).selectExpr(
        "id event_id", "timestamp_seconds(id) ts", "id % 40 user_id", "'view' event_type", "double(id) value", "uuid() props")
    one.write.parquet(f"{tmp_path}/events.parquet")
    size = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(size, "10000")
    try:
        log = q._log(spark, str(tmp_path))
        run = Run(0, {p: 0 for p in range(4)}, {p: 30_000 for p in range(4)})
        told = log.read(run).selectExpr("spark_partition_id() p", "event_id").collect()
    finally:
        spark.conf.unset(size)
    assert sorted(r.event_id for r in told) == [r.id for r in spark.range(6_000).collect() if r.id * 3 + 50 < 30_000]
    assert len({r.p for r in told}) > 1
