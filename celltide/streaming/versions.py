"""The event table at size: appended batches of events and resolutions, folded range by range into versions.

Events and resolutions are only ever appended, one folder for each batch, cut by ranges of `span` cell ids:

    events/batch_id=…/range=…                  events as they came
    resolutions/batch_id=…/range=…             (cell_id, resolved_at) as they came
    folded/version=…/range=…/open=…            a range's events with their state settled, open ones apart
    settled/version=…/range=…                  the newest resolution of each of its cells
    manifests/version=…                        which version holds each range, and up to which batch

A reader takes one manifest: the folded part of each range, and the batches that came after it. So folding never
changes what is read, only what reading costs: closed events of folded ranges lie in files of their own, which a
reader of the open ones does not touch, and of many resolutions of a cell one is left. A reader that holds an older
manifest goes on with the files it names until `vacuum` removes them.

A resolution closes every event of its cell that is not newer than it, whenever either arrives. A closed event stays
closed, so its state can be stored; the newest resolution is kept for events that arrive later.

A table laid out for another number of folders, or for none, has to be appended anew. One process writes at a time. A batch replaces only its own folders and a fold only those of its version, and the
manifest is written last: both can run again after a failure. A batch that has been folded may come again only with
the same rows. Batches are numbered in any order that rises. Events without a cell are never closed by a resolution;
they form the range `none`. A table without batches reads as empty.

Ranges are dealt to `FOLDERS` folders in turn, and a folder is what is folded, so files, manifest and the driver's
work stay the same however many cells there are. Ranges that share a folder are folded together. A batch is sorted
out by folder before it is written, not by every task into every folder. A folder is written and folded by Spark in
as many tasks as its rows need, hot cells included.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.functions.lookups import literal_map
from celltide.operators import eventstore
from celltide.schemas import EVENT_SCHEMA
from celltide.session import drop_path, path_names

RESOLUTION_SCHEMA = "cell_id BIGINT, resolved_at TIMESTAMP"
MANIFEST = "range STRING, held BIGINT, upto BIGINT"
NO_RANGE = "none"
FOLDERS = 64  # ranges are dealt to so many folders; all writers of a table use the same number
EVENTS = ("id", "cell_id", "creation_date", "event", "data", "active")
RESOLUTIONS = ("cell_id", "resolved_at")


@dataclass(frozen=True)
class Manifest:
    """A version: for each range the version that holds it and the last batch folded into that."""

    number: int
    ranges: dict[str, tuple[int, int]]

    def held(self) -> Column:
        return self._of({r: v for r, (v, _) in self.ranges.items()})

    def upto(self) -> Column:
        return self._of({r: b for r, (_, b) in self.ranges.items()})

    @staticmethod
    def _of(known: dict[str, int]) -> Column:
        if not known:
            return F.lit(-1)
        return F.coalesce(F.try_element_at(literal_map(known), F.col("range")), F.lit(-1))


class EventTable:
    """One event table in one folder; `span` must be the same for all its writers and readers."""

    def __init__(self, spark: SparkSession, folder: str, span=1000):
        self.spark, self.folder, self.span = spark, folder.rstrip("/"), span

    # Batches

    def append(self, batch_id: int, events: DataFrame | None = None, resolutions: DataFrame | None = None):
        """Store a batch of events, of resolutions, or of both."""
        for rows, part, columns in ((events, "events", EVENTS), (resolutions, "resolutions", RESOLUTIONS)):
            if rows is not None:
                ranged = self._ranged(rows.select(*columns)).hint("rebalance", "range")
                ranged.write.mode("overwrite").partitionBy("range").parquet(
                    f"{self.folder}/{part}/batch_id={batch_id}"
                )

    def _ranged(self, rows: DataFrame) -> DataFrame:
        of_cell = F.pmod(F.floor(F.col("cell_id") / self.span), F.lit(FOLDERS)).cast("string")
        return rows.withColumn("range", F.coalesce(of_cell, F.lit(NO_RANGE)))

    def _read(self, part: str, schema: str, cut: str) -> DataFrame:
        path, schema = f"{self.folder}/{part}", f"{schema}, {cut}"
        if path_names(self.spark, f"{path}/*"):
            return self.spark.read.schema(schema).parquet(path)
        return self.spark.createDataFrame([], schema)

    def _folders(self, part: str, key: str) -> list[tuple[str, int, str]]:
        """(path, number, range) of the folders of a part; no file is read."""
        paths = path_names(self.spark, f"{self.folder}/{part}/{key}=*/range=*")
        return [(p, int(p.split(f"{key}=")[1].split("/")[0]), p.split("range=")[1]) for p in paths]

    # Versions

    def manifest(self, number: int | None = None) -> Manifest:
        """The newest manifest, or that of a given number; before the first fold, one that names no range."""
        numbers = self._numbers()
        number = max(numbers, default=-1) if number is None else number
        if number < 0:
            return Manifest(-1, {})
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/manifests/version={number}")
        return Manifest(number, {r.range: (r.held, r.upto) for r in rows.collect()})

    def _numbers(self) -> list[int]:
        done = path_names(self.spark, f"{self.folder}/manifests/version=*/_SUCCESS")
        return sorted(int(p.split("version=")[1].split("/")[0]) for p in done)

    def _stored(self, at: Manifest, open_only=False) -> DataFrame:
        """Events of a manifest as they are stored: folded ones, then those of later batches."""
        folded = self._read("folded", EVENT_SCHEMA, "version BIGINT, range STRING, open INT").where(
            F.col("version") == at.held())
        later = self._read("events", EVENT_SCHEMA, "batch_id BIGINT, range STRING").where(
            F.col("batch_id") > at.upto())
        if open_only:
            folded, later = folded.where("open = 1"), later.where("active = 1")
        return folded.drop("version", "open").unionByName(later.drop("batch_id"))

    def resolutions(self, at: Manifest | None = None) -> DataFrame:
        """Resolutions that may still matter: (cell_id, resolved_at, range)."""
        at = at or self.manifest()
        settled = self._read("settled", RESOLUTION_SCHEMA, "version BIGINT, range STRING").where(
            F.col("version") == at.held())
        later = self._read("resolutions", RESOLUTION_SCHEMA, "batch_id BIGINT, range STRING").where(
            F.col("batch_id") > at.upto())
        return settled.drop("version").unionByName(later.drop("batch_id"))

    def events(self, at: Manifest | None = None) -> DataFrame:
        """All events with their state."""
        at = at or self.manifest()
        return eventstore.with_active(self._stored(at), self.resolutions(at)).select(*EVENTS)

    def active_events(self, at: Manifest | None = None) -> DataFrame:
        """Open events only; files of closed events in folded ranges are not read."""
        at = at or self.manifest()
        opened = eventstore.with_active(self._stored(at, open_only=True), self.resolutions(at))
        return opened.where("active = 1").select(*EVENTS)

    def fold(self, low: int | None = None, high: int | None = None) -> Manifest:
        """Fold the batches of all ranges, or of those that hold a cell id from `low` to `high`."""
        at = self.manifest()
        known, upto = at.ranges, {}
        for part in ("events", "resolutions"):
            for _, batch, name in self._folders(part, "batch_id"):
                if batch > known.get(name, (-1, -1))[1] and self._within(name, low, high):
                    upto[name] = max(batch, upto.get(name, -1))
        if not upto:
            return at
        number = at.number + 1
        chosen = F.col("range").isin(*upto)
        stored, resolved = self._stored(at).where(chosen), self.resolutions(at).where(chosen)
        state = eventstore.with_active(stored, resolved)
        # Tasks of about equal size: a hot range is split, small ones share a task.
        state.hint("rebalance", "range", "active").withColumn("open", F.col("active")).write.mode(
            "overwrite").partitionBy("range", "open").parquet(f"{self.folder}/folded/version={number}")
        newest_of_cell = self._ranged(eventstore.latest_resolutions(resolved))
        newest_of_cell.hint("rebalance", "range").write.mode("overwrite").partitionBy("range").parquet(
            f"{self.folder}/settled/version={number}")
        ranges = known | {name: (number, last) for name, last in upto.items()}
        rows = self.spark.createDataFrame([(k, v, b) for k, (v, b) in sorted(ranges.items())], MANIFEST)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifests/version={number}")
        return self.manifest(number)

    def _within(self, name: str, low, high) -> bool:
        if low is None and high is None:
            return True
        if name == NO_RANGE:
            return False
        if low is None or high is None:
            return True  # a half of all ids has ranges in every folder
        first, last = low // self.span, high // self.span
        return first <= last and (int(name) - first) % FOLDERS <= last - first

    def vacuum(self, keep=1) -> int:
        """Remove the files that none of the `keep` newest manifests needs; how many folders went."""
        numbers = self._numbers()
        if not numbers:
            return 0
        kept = [self.manifest(n) for n in numbers[-keep:]]
        needed = {(r, v) for m in kept for r, (v, _) in m.ranges.items()}
        gone: list[str] = []
        for part in ("folded", "settled"):
            gone += [p for p, version, name in self._folders(part, "version")
                     if version <= numbers[-1] and (name, version) not in needed]
        for part in ("events", "resolutions"):
            gone += [p for p, batch, name in self._folders(part, "batch_id")
                     if all(batch <= m.ranges.get(name, (-1, -1))[1] for m in kept)]
        gone += [f"{self.folder}/manifests/version={n}" for n in numbers[:-keep]]
        for path in gone:
            drop_path(self.spark, path)
        return len(gone)
