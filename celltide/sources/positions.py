"""Bounded reads of a partitioned log of numbered records, with stored positions.

A log has partitions, and in each of them records with a rising place; places may have gaps. A run takes the
next records of every partition, up to a limit in all, and its range is stored before the work begins. Only
when the work is done is the range marked as done. A run that failed comes again with the same number and the
same range, so work that replaces what is stored under its run's number stores every record once.

    plans/run=…      part, start, until: the range of the run for each partition (end exclusive)
    done/run=…       written when the run's work is through

Plans hold one row for each partition of the log, so they are small enough for the driver. No records: no run.
Records without a partition or a place belong to no range; a log has none.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.session import drop_path, path_names

PLAN = "part INT, start BIGINT, until BIGINT"
KEPT = 20  # plans of finished runs that stay


@dataclass(frozen=True)
class Run:
    number: int
    start: dict[int, int]
    until: dict[int, int]

    @property
    def limit(self) -> int:
        return sum(self.until[p] - self.start[p] for p in self.until)


class TableLog:
    """A log kept as a table. Ranges are plain comparisons, so they reach the scan of the files."""

    def __init__(self, table: DataFrame, part="partition", place="offset"):
        self.table, self.part, self.place = table, part, place

    def after(self, start: dict[int, int]) -> DataFrame:
        """(part, place) of the records from the given places on; partitions not named are new ones."""
        part, place = F.col(self.part), F.col(self.place)
        wanted = F.lit(True) if not start else ~part.isin(list(start))
        for p, s in start.items():
            wanted = wanted | ((part == p) & (place >= s))
        return self.table.where(wanted & part.isNotNull() & place.isNotNull()).select(
            part.cast("int").alias("part"), place.cast("bigint").alias("place"))

    def read(self, run: Run) -> DataFrame:
        part, place = F.col(self.part), F.col(self.place)
        wanted = F.lit(False)
        for p, end in run.until.items():
            if end > run.start[p]:
                wanted = wanted | ((part == p) & (place >= run.start[p]) & (place < end))
        return self.table.where(wanted)


class KafkaLog:
    """A Kafka topic, read in batches between stored positions; `options` carries brokers and credentials."""

    def __init__(self, spark: SparkSession, options: dict, topic: str):
        self.spark, self.options, self.topic = spark, options, topic

    def bounds(self, run: Run) -> dict[str, str]:
        """The reader's options for the range of a run."""
        return {
            "subscribe": self.topic,
            "startingOffsets": json.dumps({self.topic: {str(p): s for p, s in run.start.items()}}),
            "endingOffsets": json.dumps({self.topic: {str(p): e for p, e in run.until.items()}}),
        }

    def after(self, start: dict[int, int]) -> DataFrame:
        reader = self.spark.read.format("kafka").options(**self.options).option("subscribe", self.topic)
        records = TableLog(reader.option("startingOffsets", "earliest").load())
        return records.after(start)

    def read(self, run: Run) -> DataFrame:
        return self.spark.read.format("kafka").options(**self.options).options(**self.bounds(run)).load()


def shares(waiting: dict[int, int], limit: int | None, turn=0) -> dict[int, int]:
    """How many places each partition may advance: all, or `limit` together, in proportion to what waits.

    Every partition that waits gets one at least, as far as the limit goes; which ones go first when it does
    not reach all of them changes with the turn. The shares add up to the limit or to all that waits.
    """
    total = sum(waiting.values())
    if limit is None or total <= limit:
        return dict(waiting)
    asking = sorted(p for p, n in waiting.items() if n > 0)
    first = turn * limit % len(asking)
    asking = asking[first:] + asking[:first]
    given = dict.fromkeys(waiting, 0)
    for p in asking[:limit]:
        given[p] = 1
    left, rest = limit - sum(given.values()), total - len(asking)
    if left <= 0:
        return given
    exact = {p: (waiting[p] - 1) * left for p in asking}
    for p in asking:
        given[p] += exact[p] // rest
    missing = limit - sum(given.values())
    for p in sorted(asking, key=lambda p: -(exact[p] % rest))[:missing]:
        given[p] += 1
    return given


class Positions:
    """Where the runs over one log stand, in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _runs(self, kind: str) -> list[int]:
        names = path_names(self.spark, f"{self.folder}/{kind}/run=*/_SUCCESS")
        return sorted(int(name.split("run=")[1].split("/")[0]) for name in names)

    def _write(self, kind: str, run: Run) -> None:
        rows = [(p, run.start[p], run.until[p]) for p in sorted(run.until)]
        self.spark.createDataFrame(rows, PLAN).coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/{kind}/run={run.number}")

    def _plan(self, number: int) -> Run:
        rows = self.spark.read.schema(PLAN).parquet(f"{self.folder}/plans/run={number}").collect()
        return Run(number, {r.part: r.start for r in rows}, {r.part: r.until for r in rows})

    def done(self) -> dict[int, int]:
        """The next place of each partition, as the last finished run left it."""
        finished = self._runs("done")
        return self._plan(finished[-1]).until if finished else {}

    def begin(self, log, limit: int | None = None) -> Run | None:
        """The run that failed, with its range; else a new one, stored before it is returned; None if nothing waits."""
        if limit is not None and limit < 1:
            raise ValueError("a run takes at least one record")
        planned, finished = self._runs("plans"), self._runs("done")
        if planned and (not finished or planned[-1] > finished[-1]):
            return self._plan(planned[-1])
        start = self._plan(finished[-1]).until if finished else {}
        ends = log.after(start).groupBy("part").agg(
            F.min("place").alias("first"), (F.max("place") + 1).alias("end")).collect()
        if not ends:
            return None
        # The log may have dropped its oldest records: a run starts with the first that is there.
        low = start | {r.part: max(r.first, start.get(r.part, r.first)) for r in ends}
        number = finished[-1] + 1 if finished else 0
        given = shares({r.part: r.end - low[r.part] for r in ends}, limit, number)
        run = Run(number, low, low | {p: low[p] + n for p, n in given.items()})
        self._write("plans", run)
        return run

    def commit(self, run: Run) -> None:
        """The run's work is through; older plans go."""
        self._write("done", run)
        for kind in ("plans", "done"):
            for old in self._runs(kind):
                if old <= run.number - KEPT:
                    drop_path(self.spark, f"{self.folder}/{kind}/run={old}")


def run_once(log, positions: Positions, work: Callable[[DataFrame, int], None], limit: int | None = None) -> Run | None:
    """One bounded run: `work` gets the records and the run's number; an error in it leaves the run open."""
    run = positions.begin(log, limit)
    if run is not None:
        work(log.read(run), run.number)
        positions.commit(run)
    return run


def run_until_empty(log, positions: Positions, work: Callable[[DataFrame, int], None], limit: int | None = None) -> list[Run]:
    """Bounded runs, one after another, until nothing waits."""
    runs = []
    while (run := run_once(log, positions, work, limit)) is not None:
        runs.append(run)
    return runs
