"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


BATCH_BYTES = 4 << 20  # of a batch of rows on its way to Python

_made: list[str] = []  # intermediate tables of this process


def build_session(app="celltide", master=None, partitions=None, **conf) -> SparkSession:
    """A session with the settings the library relies on; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Local reads of a shuffle would put all rows of a table of one file into one task.
        "spark.sql.adaptive.localShuffleReader.enabled": "false",
        # Call-site capture costs more than building the plans themselves.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin(spark: SparkSession) -> SparkSession:
    """All times in the data model are UTC; a session in another zone would shift them."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def small_batches(spark: SparkSession) -> SparkSession:
    """Batches of a few MB go to Python, unless the session says how large they are to be.

    The JVM and the worker of each task hold a batch more than once, outside the heap; 10,000 whole texts
    can be much.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local master may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        used = sc._jsc.sc().getCheckpointDir()
        folder = used.get() if used.isDefined() else None
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="celltide-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that no retry can ask for any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def path_names(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern; none where the folder is not there yet."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [f.getPath().toString() for f in found or []]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder; never reused, so a rerun cannot see old files."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _made.append(path)
    return path


def drop_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Remove intermediate tables of this process: all, for the end, when all results are read; or some."""
    for made in list(_made) if paths is None else [p for p in paths if p in _made]:
        _made.remove(made)
        drop_path(spark, made)


def scratch_paths() -> list[str]:
    """The intermediate tables of this process that are still there."""
    return list(_made)


def materialize(df: DataFrame, name="stage") -> DataFrame:
    """Cut lineage by writing to the shared folder, so lost executors do not recompute the past."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
