"""What arriving batches need of the past: an archive by day and key bucket, and the last readings of each key.

A batch reads the last readings of the buckets its keys fall into, never the archive as a whole. Only keys
whose readings arrive late, that is not after all readings known of them, are looked up in the archive: the
days around the late ones, in the buckets concerned, and further days only until each late reading has as
many older and newer readings of its key as can matter. So what a batch reads depends on the batch and on how
late it is, not on the length of the archive.

    archive/event_date=…/batch_id=…           all readings, by bucket inside, so a read skips other buckets
    tails/bucket=…/batch_id=…                 last readings of the bucket's keys after that batch
    versions/batch_id=…                       which version of each bucket holds after that batch

Every batch replaces only its own folders and starts from the versions of the batch before it, so it can run
again. Readings without a cell, band or time have no history and are scored as they are.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.operators.history import recent_points
from celltide.operators.rules import Thresholds, apply_rules, with_history
from celltide.schemas import MARKS
from celltide.session import drop_path

KEYS = ["cell_id", "band"]
VALUES = ["ues_usage", "throughput_mbps"]
BUCKETS = 32


def history_values(df: DataFrame) -> list[str]:
    """What the rules look at in earlier readings; typed tables without marks have good numbers only."""
    return VALUES + [m for m in MARKS if m in df.columns]


def tail(points: DataFrame, n=3) -> DataFrame:
    """What later batches can need of each key: n readings of its newest second, n before it.

    Both rankings also run before the shuffle, so a hot key ships few rows per partition.
    """
    values = history_values(points)
    rows = recent_points(points, n, KEYS, "event_time", values).drop("_slice")
    newest = Window.partitionBy(*KEYS).orderBy(
        F.desc("event_time"), *[F.col(v).desc_nulls_last() for v in values]
    )
    return rows.withColumn("nth", F.row_number().over(newest)).where(
        F.col("nth") <= 2 * n
    ).drop("nth")


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


class ReadingStore:
    """The folders above; `looked_up` lists the (days, buckets) the last batch read from the archive."""

    def __init__(self, folder: str, n=3, buckets=BUCKETS):
        self.folder, self.n, self.buckets = folder.rstrip("/"), n, buckets
        self.looked_up: list[tuple[list, list]] = []

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*KEYS), F.lit(self.buckets)).cast("int")

    def receive(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Store the batch in the archive; the rows come back from storage, with their bucket and day."""
        spark, archive = batch.sparkSession, f"{self.folder}/archive"
        marked = batch.withColumns({"event_date": F.to_date("event_time"), "bucket": self._bucket()})
        # A rebalance, unlike a repartition, may cut a day that holds most rows.
        (marked.withColumn("batch_id", F.lit(batch_id).cast("bigint")).hint("rebalance", "event_date")
         .sortWithinPartitions("event_date", "bucket")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date", "batch_id").parquet(archive))
        own = f"{archive}/event_date=*/batch_id={batch_id}"
        target = spark._jvm.org.apache.hadoop.fs.Path(own)
        if not target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target):
            return spark.createDataFrame([], marked.schema)
        # From here on the batch is read back, so the source is asked once.
        rows = spark.read.schema(marked.schema).option("basePath", archive).parquet(own).select(*marked.columns)
        return rows

    def _versions(self, spark: SparkSession, batch_id: int) -> dict[int, int]:
        """bucket to version after a batch: one row for each bucket."""
        if batch_id < 0:
            return {}
        path = f"{self.folder}/versions/batch_id={batch_id}"
        return {r["bucket"]: r["version"] for r in spark.read.schema("bucket INT, version BIGINT").parquet(path).collect()}

    def tails(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Last readings, and time of the first one, of the keys in the batch's buckets, before the batch."""
        spark = rows.sparkSession
        values = history_values(rows)
        points = rows.select(*KEYS, "event_time", *values, F.col("event_time").alias("since"), "bucket")
        known = self._versions(spark, batch_id - 1)
        wanted = [r[0] for r in rows.select("bucket").distinct().collect() if r[0] in known]
        paths = [f"{self.folder}/tails/bucket={b}/batch_id={known[b]}" for b in sorted(wanted)]
        if not paths:
            return points.where("false")
        return spark.read.schema(points.schema).option("basePath", f"{self.folder}/tails").parquet(*paths).select(
            *points.columns)

    def advance(self, rows: DataFrame, tails: DataFrame, batch_id: int) -> None:
        """The last readings after the batch, as new versions of its buckets."""
        spark = rows.sparkSession
        values = history_values(rows)
        points = rows.select(*KEYS, "event_time", *values, F.col("event_time").alias("since")).unionByName(
            tails.drop("bucket")).dropna(subset=[*KEYS, "event_time"])
        first = points.groupBy(*KEYS).agg(F.min("since").alias("since"))
        kept = tail(points.drop("since"), self.n).join(first, KEYS).withColumns(
            {"bucket": self._bucket(), "batch_id": F.lit(batch_id).cast("bigint")})
        (kept.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "batch_id").parquet(f"{self.folder}/tails"))
        told = rows.dropna(subset=[*KEYS, "event_time"]).select("bucket").distinct().collect()
        before = self._versions(spark, batch_id - 1)
        after = before | {r[0]: batch_id for r in told}
        spark.createDataFrame(sorted(after.items()), "bucket INT, version BIGINT").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.folder}/versions/batch_id={batch_id}")
        # A retry starts from the versions before its batch; what the ones before those replaced may go.
        oldest = self._versions(spark, batch_id - 3)
        last = self._versions(spark, batch_id - 2) if oldest else {}
        for b, old in oldest.items():
            if last[b] != old:
                drop_path(spark, f"{self.folder}/tails/bucket={b}/batch_id={old}")

    def _days(self, like: DataFrame, days: list, buckets: list, batch_id: int) -> DataFrame:
        """Archived readings of earlier batches on some days and in some buckets."""
        spark = like.sparkSession
        self.looked_up.append((days, buckets))
        schema = T.StructType([*like.schema.fields, T.StructField("batch_id", T.LongType())])
        paths = [p for p in (f"{self.folder}/archive/event_date={d}" for d in days) if _exists(spark, p)]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).option("basePath", f"{self.folder}/archive").parquet(*paths).where(
            (F.col("batch_id") < batch_id) & F.col("bucket").isin(buckets))

    def around(self, rows: DataFrame, tails: DataFrame, batch_id: int) -> tuple[DataFrame, DataFrame, list]:
        """(late, found, days): per late key and day its times; the late keys' archived readings on those days.

        Days are added on both sides, twice as many each time, until every late day of a key has n older
        and n newer readings or the ends of what is known of the key.
        """
        self.looked_up = []
        known = tails.groupBy(*KEYS).agg(F.max("event_time").alias("newest"), F.min("since").alias("since"))
        times = rows.groupBy(*KEYS, "bucket", "event_date").agg(
            F.min("event_time").alias("low"), F.max("event_time").alias("high"))
        late = times.join(known, KEYS).where(F.col("low") <= F.col("newest")).withColumnRenamed("event_date", "day").persist()
        where = late.groupBy("day").agg(F.collect_set("bucket").alias("buckets")).collect()  # days and buckets, no keys
        if not where:
            return late, rows.where("false"), []
        buckets = sorted({b for r in where for b in r["buckets"]})
        span = 0
        while True:
            days = sorted({r["day"] + dt.timedelta(k) for r in where for k in range(-span, span + 1)})
            found = self._days(rows, days, buckets, batch_id).drop("batch_id")
            near = found.join(late.select(*KEYS, "day", "low", "high"), KEYS).where(
                F.abs(F.datediff("event_date", "day")) <= span)
            counts = near.groupBy(*KEYS, "day").agg(
                F.count_if(F.col("event_time") < F.col("low")).alias("older"),
                F.count_if(F.col("event_time") > F.col("high")).alias("newer"))
            open_ = late.join(counts, [*KEYS, "day"], "left").where(
                ((F.coalesce("older", F.lit(0)) < self.n) & (F.date_sub("day", span) > F.to_date("since")))
                | ((F.coalesce("newer", F.lit(0)) < self.n) & (F.date_add("day", span) < F.to_date("newest"))))
            if open_.isEmpty():
                return late, found.join(late.select(*KEYS).distinct(), KEYS, "left_semi"), days
            span = 2 * span + 1


def score_arrivals(
    batch: DataFrame, batch_id: int, store: ReadingStore, t: Thresholds = Thresholds(), amend=True,
) -> DataFrame:
    """The batch with flags and anomalies, each reading against all that has arrived of its key's past.

    With `amend`, earlier readings whose history a late one changes come again, and so do the others of the
    same key and second as any reading of the batch: for every key and second the newest batch that has it
    tells all. Without, only the batch's rows come.
    """
    columns = batch.columns
    rows = store.receive(batch, batch_id)
    tails = store.tails(rows, batch_id)
    late, found, days = store.around(rows, tails, batch_id)
    older = tails.select(*KEYS, "event_time", *history_values(rows))
    again = F.lit(False)
    if days:
        # Of late keys all readings of these days are there; of other days the last ones count, as for keys in time.
        keys = late.select(*KEYS).distinct().withColumn("_late", F.lit(True))
        older = older.join(keys, KEYS, "left").where(
            F.col("_late").isNull() | ~F.to_date("event_time").isin(days)).drop("_late")
    if days and amend:
        later = found.select(*KEYS, "event_time").join(late.select(*KEYS, "day", "low", "high"), KEYS).where("event_time > high")
        nth = Window.partitionBy(*KEYS, "day").orderBy("event_time")
        last = later.withColumn("nth", F.row_number().over(nth)).where(F.col("nth") <= store.n).groupBy(*KEYS, "day").agg(
            F.max("event_time").alias("last"))
        spans = late.join(last, [*KEYS, "day"], "left").select(
            *KEYS, F.struct("low", F.greatest("high", "last").alias("last")).alias("span")).groupBy(*KEYS).agg(
            F.collect_list("span").alias("_spans"))  # one for each late day of the key
        found = found.join(spans, KEYS, "left")
        again = F.exists("_spans", lambda s: F.col("event_time").between(s["low"], s["last"]))
    found = found.withColumn("_told", again).select(*columns, "_told")
    readings = rows.select(*columns).withColumn("_told", F.lit(True)).unionByName(found).unionByName(
        older.withColumn("_told", F.lit(False)), allowMissingColumns=True)
    scored = apply_rules(with_history(readings, t).where("_told").drop("_told"), t)
    store.advance(rows, tails, batch_id)
    return scored


def current(results: DataFrame) -> DataFrame:
    """The valid rows of amended results: of every key and second those of its newest batch."""
    of = Window.partitionBy(*KEYS, "event_time")
    newest = F.max("batch_id").over(of)
    whole = F.col("cell_id").isNotNull() & F.col("band").isNotNull() & F.col("event_time").isNotNull()
    return results.withColumn("_newest", newest).where(~whole | (F.col("batch_id") == F.col("_newest"))).drop("_newest")
