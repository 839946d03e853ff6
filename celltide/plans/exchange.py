"""Queries that write files with the library's writers and read them again with its readers."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from celltide.operators import clean
from celltide.operators.rules import anomalies_long
from celltide.plans import views as v
from celltide.schemas import KPI_COLUMNS, KPI_SOURCE_NAMES
from celltide.session import scratch_path
from celltide.sinks.files import (
    ANOMALY_CSV_COLUMNS,
    text_columns,
    write_anomalies,
    write_archive,
    write_results,
    write_topology,
)
from celltide.sources.events import read_events_json
from celltide.sources.telemetry import newest_first, normalize_names, read_archive, strip_names, type_kpi
from celltide.sources.topology import normalize_towers, read_topology

TOPOLOGY = ("cell_id", "max_capacity", "lat", "lon", "bands", "area_type", "city", "adjacent_cells")


def joined(*lists):
    return [F.array_join(F.col(c).cast("array<string>"), ",").alias(n) for c, n in lists]


def quoted_archive(spark, sf):
    """Readings whose texts hold quotes and commas."""
    path = scratch_path(spark, "ran-combined-metrics")
    city = F.concat(F.lit('The "'), F.col("city"), F.lit('", '), F.col("cell_id").cast("string"))
    write_archive(v.kpi(spark, sf).withColumn("city", city).select(*KPI_COLUMNS), path)
    return type_kpi(read_archive(spark, path))


def loose_archive(spark, sf):
    """Files with blanks before the fields, without quotes, and with the header again between the rows."""
    path = scratch_path(spark, "ran-combined-metrics")
    rows = v.kpi(spark, sf)
    fields = [
        c if n == "adjacent_cells" else F.concat(F.lit(" "), c)
        for c, n in zip(text_columns(rows), KPI_COLUMNS)
    ]
    names = [F.lit(n) for n in KPI_SOURCE_NAMES]
    lines = F.when(F.col("event_id") % 50 == 0, F.array(F.array(*names), F.array(*fields))).otherwise(
        F.array(F.array(*fields)))
    split = rows.select(F.explode(lines).alias("line"))
    split.select(*[F.col("line")[i].alias(n) for i, n in enumerate(KPI_SOURCE_NAMES)]).write.option(
        "header", True).option("ignoreLeadingWhiteSpace", False).option("escape", '"').csv(path)
    return type_kpi(read_archive(spark, path))


def files_newest_first(spark, sf):
    """Three batches of files, as the reader that wants the newest first meets them."""
    path, rows = scratch_path(spark, "ran-combined-metrics"), v.kpi(spark, sf)
    for batch in range(3):
        write_archive(rows.where(F.col("event_id") % 3 == batch).select(*KPI_COLUMNS), f"{path}/batch={batch}")
    read = read_archive(spark, path)
    files = newest_first(read.groupBy("file_path", "file_time").agg(F.count("*").alias("n")))
    placed = files.withColumn("place", F.monotonically_increasing_id()).withColumn(
        "batch", F.regexp_extract("file_path", r"batch=(\d)", 1).cast("int"))
    batches = placed.groupBy("batch").agg(
        F.min("place").alias("first"), F.max("place").alias("last"), F.sum("n").alias("readings"))
    order = Window.orderBy("first")  # three rows
    before = F.lag("last").over(order)
    return batches.select(
        "batch", "readings", F.row_number().over(order).alias("nth"),
        (before.isNull() | (before < F.col("first"))).alias("apart"),
    )


def topology_csv(spark, sf):
    path = scratch_path(spark, "topology-csv")
    write_topology(v.cells(spark, sf).select(*TOPOLOGY), path, "csv")
    return read_topology(spark, path, "csv").select(
        "cell_id", "max_capacity", "lat", "lon", "area_type", "city",
        *joined(("bands", "bands"), ("adjacent_cells", "adjacent")),
    )


def towers_json(spark, sf):
    path = scratch_path(spark, "topology-json")
    write_topology(v.cells(spark, sf).drop("wanted"), path)
    return normalize_towers(read_topology(spark, path, "ndjson")).select(
        "id", "name", "lat", "lng", "status", "city", "area_type", "max_capacity", *joined(("bands", "bands")),
    )


def events_json(spark, sf):
    """Items under either spelling; every eleventh has no text and is left out."""
    path, e = scratch_path(spark, "events-json"), F.col("id")
    rows = v.event_store(spark, sf).withColumn("made", F.date_format("creation_date", "yyyy-MM-dd HH:mm:ss"))
    plain = F.struct("id", "cell_id", "event", "data", F.col("made").alias("creation_date"), "active")
    other = F.struct("id", "cell_id", F.col("event").alias("Event"), "data", F.col("made").alias("date"))
    bare = F.struct("id", "cell_id", "data")
    line = F.when(e % 11 == 0, F.to_json(bare)).when(e % 4 == 0, F.to_json(other)).otherwise(F.to_json(plain))
    rows.select(line.alias("value")).write.text(path)
    return read_events_json(spark, path, ndjson=True)


def results_csv(spark, sf):
    """Scored rows with quotes and commas in their texts."""
    path = scratch_path(spark, "results")
    rows = anomalies_long(v.detected(spark, sf), ("event_id", "cell_id")).select(
        "event_id", "cell_id", "rule_no", F.concat(F.lit('say "'), "text", F.lit('", then')).alias("text"))
    write_results(rows, path)
    schema = "event_id BIGINT, cell_id BIGINT, rule_no INT, text STRING"
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path)


def anomalies_csv(spark, sf):
    path = scratch_path(spark, "anomalies-csv")
    write_anomalies(v.anomaly_rows(spark, sf), path, "csv")
    schema = ", ".join(f"{c} STRING" for c in ANOMALY_CSV_COLUMNS)
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(path).select(
        "cell_id", "band", "anomaly_type", "anomaly", "source_id", "creation_date",
        F.col("recommended_fix").isNull().alias("no_fix"),
    )


def anomalies_json(spark, sf):
    path = scratch_path(spark, "anomalies-json")
    rows = v.anomaly_rows(spark, sf)
    write_anomalies(rows, path)
    return spark.read.schema(rows.schema).json(path).select(
        "cell_id", "band", "anomaly_type", "anomaly", "source_id", "item_no",
        F.unix_timestamp("creation_date").alias("created_ts"), F.col("recommended_fix").isNull().alias("no_fix"),
    )


def named_metrics(spark, sf):
    """Host metrics under loose names, as texts with separators and two digits; some cannot be read."""
    e = F.col("event_id")
    rows = v.du(spark, sf).select(
        e.alias(' "Event ID"'), F.col("cell_id").alias("Cell ID "),
        F.when(e % 10 == 3, "n/a").otherwise(F.format_number("memory_mb", 0)).alias('"Memory (MB)"'),
        F.format_number("power_w", 2).alias("Power [W] "),
    )
    plain = normalize_names(strip_names(rows))
    return clean.numbers_without_commas(plain, ["memorymb", "powerw"])


EXCHANGED = {f.__name__: f for f in (
    files_newest_first, topology_csv, towers_json, events_json, results_csv, anomalies_csv, anomalies_json,
    named_metrics,
)}
