"""Roll-ups that are kept up to date: partial sums by day and cell, merged with what each batch brings.

A batch is summed up by day and cell, and only the days it touches are read, merged and written again, as new
versions. So a batch costs what it holds and the sums of its days, however long the archive is; late rows
touch the older days they belong to. Reading sums one row for each day and cell.

    days/day=…/batch_id=…       the day's sums by cell after that batch
    versions/batch_id=…         which version of each day holds after that batch

A batch replaces only its own folders and starts from the versions of the batch before it, so it can run again;
batches are numbered from 0 without gaps, and an empty one keeps all versions. Rows without a time are kept under
the day `none`, rows without a cell as a cell of their own. Every row is to come in one batch only: sums cannot
take back what was told before. Versions are one row for each day, so they are small enough for the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.operators import rollups
from celltide.session import drop_path

BY_DAY = ("day", "cell_id")
VERSIONS = "day STRING, version BIGINT"


@dataclass(frozen=True)
class Kind:
    """How rows are summed up, how sums are merged, what they are read as, and the time that gives the day."""

    parts: Callable[..., DataFrame]
    merge: Callable[..., DataFrame]
    read: Callable[[DataFrame], DataFrame]
    time: str


ANOMALIES = Kind(rollups.summary_parts, rollups.merge_summaries, rollups.summary_columns, "creation_date")
CALLS = Kind(rollups.activity_parts, rollups.merge_activities, rollups.activity_rates, "timestamp")


class KeptRollup:
    """One roll-up in one folder."""

    def __init__(self, spark: SparkSession, folder: str, kind: Kind):
        self.spark, self.folder, self.kind = spark, folder.rstrip("/"), kind

    def versions(self, batch_id: int) -> dict[str, int]:
        """day to version after a batch."""
        if batch_id < 0:
            return {}
        path = f"{self.folder}/versions/batch_id={batch_id}"
        return {r.day: r.version for r in self.spark.read.schema(VERSIONS).parquet(path).collect()}

    def _sums(self, versions: dict[str, int], schema) -> DataFrame:
        paths = [f"{self.folder}/days/day={d}/batch_id={b}" for d, b in sorted(versions.items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.folder}/days").parquet(*paths).select(
            *schema.names)

    def add(self, rows: DataFrame, batch_id: int) -> None:
        """Take in the rows of a batch."""
        day = F.coalesce(F.to_date(self.kind.time).cast("string"), F.lit("none"))
        # The batch's own sums are stored first, so the source is asked once.
        new = f"{self.folder}/new/batch_id={batch_id}"
        parts = self.kind.parts(rows.withColumn("day", day), BY_DAY)
        parts.write.mode("overwrite").parquet(new)
        parts = self.spark.read.schema(parts.schema).parquet(new)
        touched = [r.day for r in parts.select("day").distinct().collect()]
        before = self.versions(batch_id - 1)
        known = self._sums({d: before[d] for d in touched if d in before}, parts.schema)
        merged = self.kind.merge(known.unionByName(parts), BY_DAY).withColumn("batch_id", F.lit(batch_id))
        (merged.hint("rebalance", "day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("day", "batch_id").parquet(f"{self.folder}/days"))
        after = before | dict.fromkeys(touched, batch_id)
        self.spark.createDataFrame(sorted(after.items()), VERSIONS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/versions/batch_id={batch_id}")
        drop_path(self.spark, new)
        # A retry of this batch starts from the versions before it; what those replaced may go.
        oldest = self.versions(batch_id - 2)
        for d, old in oldest.items():
            if before[d] != old:
                drop_path(self.spark, f"{self.folder}/days/day={d}/batch_id={old}")

    def read(self, like: DataFrame, batch_id: int) -> DataFrame:
        """The roll-up as it stands after a batch; `like` has the columns of the rows that were added."""
        schema = self.kind.parts(like.withColumn("day", F.lit("")), BY_DAY).schema
        return self.kind.read(self.kind.merge(self._sums(self.versions(batch_id), schema)))
