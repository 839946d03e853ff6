"""Telemetry views over the given tables, so every query grows with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.functions.lookups import band_frequency, literal_map
from celltide.operators.clean import filter_valid_bands
from celltide.operators.reports import END, NONE_FOUND, START, reconcile, render_report
from celltide.operators.rules import anomalies_long, detect
from celltide.schemas import DU_COLUMNS, KPI_COLUMNS
from celltide.session import pin
from celltide.sinks.files import text_columns
from celltide.sinks.messages import csv_line, encode_kpi_lines
from celltide.sources.documents import mark_whole
from celltide.sources.topology import normalize_towers

BAND_OF_TYPE = {
    "view": "Band 29", "click": "Band 26", "signup": "Band 71", "purchase": "Band 66",
    "error": "Band 99",
}
AREAS = ["industrial", "commercial", "rural", "residential"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The same table as a file stream; it may be one file or a folder of files."""
    path = f"{sf_dir}/{name}.parquet"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    if system.getFileStatus(target).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def kpi_of(events: DataFrame) -> DataFrame:
    """Telemetry from events; also used on a stream of them."""
    e, u = F.col("event_id"), F.col("user_id")
    outage = e % 97 == 0

    def unless_outage(value, c):
        return F.when(outage, F.lit(float(value))).otherwise(c)

    band = F.try_element_at(literal_map(BAND_OF_TYPE), F.col("event_type"))
    return events.select(
        e.alias("event_id"),
        u.alias("cell_id"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("event_time"),
        band.alias("band"),
        band_frequency(band).alias("frequency"),
        unless_outage(0, ((e * 19) % (F.lit(51) + u % 51)).cast("double")).alias("ues_usage"),
        F.element_at(F.array(*map(F.lit, AREAS)), (u % 4 + 1).cast("int")).alias("area_type"),
        (F.lit(33.0) + ((u * 37) % 400 - 200) / 10000.0).alias("lat"),
        (F.lit(-97.0) + ((u * 53) % 400 - 200) / 10000.0).alias("lon"),
        F.concat(F.lit("CITY_"), (u % 25).cast("string")).alias("city"),
        F.array((u * 3) % 17, (u * 5) % 17).alias("adjacent_cells"),
        unless_outage(-120, F.lit(-80.0) - ((e * 7) % 4000) / 100.0).alias("rsrp"),
        unless_outage(-20, F.lit(-3.0) - ((e * 13) % 1700) / 100.0).alias("rsrq"),
        unless_outage(-10, ((e * 11) % 4000) / 100.0 - 10.0).alias("sinr"),
        unless_outage(0, F.col("value")).alias("throughput_mbps"),
        (F.lit(10.0) + ((e * 17) % 9000) / 100.0).alias("latency_ms"),
        (F.lit(50) + u % 51).cast("double").alias("max_capacity"),
    )


def kpi(spark, sf_dir) -> DataFrame:
    return kpi_of(table(spark, sf_dir, "events"))


def spread(spark, sf_dir, name: str, key: str) -> DataFrame:
    """The same table dealt to all tasks by a key; as it lies, one row group is one task's."""
    return table(spark, sf_dir, name).repartition(key)


def cells(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    nation = F.col("c_nationkey").cast("bigint")
    bands = F.array_compact(F.array(
        F.when(k % 2 == 0, "Band 29"), F.when(k % 3 == 0, "Band 26"),
        F.when(k % 5 == 0, "Band 71"), F.when(k % 2 == 1, "Band 66"),
    ))
    return table(spark, sf_dir, "customer").select(
        k.alias("cell_id"),
        (F.lit(50) + k % 51).cast("bigint").alias("max_capacity"),
        (F.lit(33.0) + nation * 0.05 + ((k * 37) % 400 - 200) / 10000.0).alias("lat"),
        (F.lit(-97.0) + ((k * 53) % 400 - 200) / 10000.0).alias("lon"),
        bands.alias("bands"),
        F.element_at(F.array(*map(F.lit, AREAS)), (k % 4 + 1).cast("int")).alias("area_type"),
        F.concat(F.lit("CITY_"), nation.cast("string")).alias("city"),
        F.when(k % 29 == 0, "down").otherwise("up").alias("status"),
        (F.lit(1) + k % 3).cast("int").alias("wanted"),
        F.array((k * 3) % 17, (k * 5) % 17).alias("adjacent_cells"),
    )


def event_store(spark, sf_dir) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        e.alias("id"),
        F.col("user_id").alias("cell_id"),
        F.col("ts").cast("timestamp").alias("creation_date"),
        F.col("event_type").alias("event"),
        F.col("props").alias("data"),
        F.when(e % 3 != 0, 1).otherwise(0).alias("active"),
    )


def calls(spark, sf_dir) -> DataFrame:
    e, u = F.col("event_id"), F.col("user_id")
    return table(spark, sf_dir, "events").where(F.col("event_type").isin("view", "click")).select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.struct(
            (F.lit(33.0) + ((u * 37) % 400 - 200) / 10000.0).alias("lat"),
            (F.lit(-97.0) + ((u * 53) % 400 - 200) / 10000.0).alias("lng"),
        ).alias("location"),
        (F.lit(-80.0) - ((e * 7) % 4000) / 100.0).alias("signal_strength"),
        (F.col("value") > 100).alias("is_dropped"),
        u.alias("cell_id"),
        e.alias("call_id"),
    )


def du(spark, sf_dir) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf_dir, "events").where(e % 4 != 0).select(
        e.alias("event_id"),
        F.col("user_id").alias("cell_id"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("event_time"),
        (F.lit(10.0) + ((e * 23) % 8000) / 100.0).alias("cpu_pct"),
        (F.lit(1000) + (e * 29) % 7001).cast("bigint").alias("memory_mb"),
        (F.lit(10.0) + ((e * 31) % 9000) / 100.0).alias("disk_gb"),
        (F.lit(1.0) + ((e * 37) % 900) / 100.0).alias("rtt_ms"),
        (F.lit(30.0) + ((e * 41) % 6000) / 100.0).alias("temperature_c"),
        (F.lit(100.0) + ((e * 43) % 40000) / 100.0).alias("power_w"),
    )


def valid_kpi(spark, sf_dir) -> DataFrame:
    return filter_valid_bands(kpi(spark, sf_dir))


def detected(spark, sf_dir) -> DataFrame:
    return detect(valid_kpi(spark, sf_dir))


def with_capacities(rows: DataFrame) -> DataFrame:
    """Capacities of every kind: none, zero, negative, a fraction, and as they are."""
    e = F.col("event_id") % 10
    return rows.withColumn(
        "max_capacity", F.when(e == 0, 0.0).when(e == 1, -5.0).when(e == 2, 0.4).when(
            e != 3, F.col("max_capacity")))


def defective_lines(spark, sf_dir) -> DataFrame:
    """Lines with capacities of every kind, and with text where a number belongs."""
    e = F.col("event_id")
    text = text_columns(with_capacities(kpi(spark, sf_dir)))
    rows = with_capacities(kpi(spark, sf_dir)).select("event_id", *text).withColumns({
        "ues_usage": F.when(e % 19 == 0, "bad").when(e % 23 == 0, "nan").otherwise(F.col("ues_usage")),
        "throughput_mbps": F.when(e % 29 == 0, "abc").otherwise(F.col("throughput_mbps")),
        "max_capacity": F.coalesce("max_capacity", F.lit("none")),
    })
    return rows.select("event_id", csv_line([F.col(c).alias(c) for c in KPI_COLUMNS]).alias("value"))


def anomalous(spark, sf_dir) -> DataFrame:
    """The cell of every anomalous row; texts are not needed to know it."""
    return detected(spark, sf_dir).where("is_anomaly").select("cell_id")


def answered(spark, sf_dir) -> DataFrame:
    """Detected rows with an answer of each kind: none, loose text, unnamed block, good block."""
    rows = render_report(detected(spark, sf_dir))
    kind = F.col("event_id") % 5
    unnamed = F.concat(
        F.lit(f"{START}\n1. Cell ID "), F.col("cell_id").cast("string"),
        F.lit(", "), F.col("band"), F.lit(f"\n{END}"),
    )
    anomalous = (
        F.when(kind == 1, "The cell looks degraded.")
        .when(kind == 2, unnamed)
        .when(kind >= 3, F.col("report_text"))
    )
    quiet = F.when(F.col("event_id") % 7 == 0, "All figures are fine.").otherwise(NONE_FOUND)
    return rows.withColumn(
        "raw_response", F.when(F.col("is_anomaly"), anomalous).otherwise(quiet)
    )


def event_texts(spark, sf_dir) -> DataFrame:
    """(id, event, creation_date) of every anomalous row, as the event store holds them."""
    return reconcile(answered(spark, sf_dir)).where("is_anomaly").select(
        F.col("event_id").alias("id"), F.col("event_text").alias("event"),
        F.col("event_time").alias("creation_date"),
    )


def anomaly_rows(spark, sf_dir) -> DataFrame:
    """Anomalies in the parsed form, straight from the rules."""
    long = anomalies_long(detected(spark, sf_dir), ("event_id", "cell_id", "band", "event_time"))
    return long.select(
        "cell_id",
        F.regexp_extract("band", r"(\d+)", 1).cast("int").alias("band"),
        "anomaly_type",
        F.col("text").alias("anomaly"),
        F.lit(None).cast("string").alias("recommended_fix"),
        F.col("event_id").cast("string").alias("source_id"),
        F.col("event_time").alias("creation_date"),
        F.col("rule_no").alias("item_no"),
    )


def kpi_text(spark, sf_dir) -> DataFrame:
    """Telemetry as raw text with every kind of defect the cleaning step handles."""
    e = F.col("event_id")
    rows = kpi(spark, sf_dir)
    text = rows.select("event_id", *text_columns(rows))
    return text.withColumns({
        "cell_id": F.when(e % 50 == 1, "abc").otherwise(F.col("cell_id")),
        "event_time": F.when(e % 60 == 3, "not a time").otherwise(F.col("event_time")),
        "ues_usage": F.when(e % 40 == 2, "bad").when(e % 40 == 7, "nan").otherwise(
            F.col("ues_usage")
        ),
        "band": F.when(e % 30 != 4, F.col("band")),
        "area_type": F.when(e % 35 != 5, F.col("area_type")),
        "max_capacity": F.when(e % 45 == 6, "none").otherwise(
            (F.col("max_capacity").cast("double") + 0.5).cast("string")
        ),
    })


def payloads(spark, sf_dir) -> DataFrame:
    return payloads_of(table(spark, sf_dir, "events"))


def payloads_of(events: DataFrame) -> DataFrame:
    """One message per reading: its line as bytes between blank lines.

    Every tenth line lacks its last field, and every tenth has one too many.
    """
    e = F.col("event_id")
    lines = encode_kpi_lines(kpi_of(events), ("event_id",))
    short = F.regexp_replace("value", ',"[^"]*"$', "")
    line = F.when(e % 10 == 0, short).when(
        e % 10 == 5, F.concat("value", F.lit(',"more"'))
    ).otherwise(F.col("value"))
    return lines.select(
        "event_id",
        F.concat(F.lit("\r\n"), line, F.lit(" \n\n")).cast("binary").alias("value"),
    )


def du_payloads(spark, sf_dir) -> DataFrame:
    rows = du(spark, sf_dir)
    return rows.select("event_id", csv_line(text_columns(rows, DU_COLUMNS)).alias("value"))


def towers(spark, sf_dir) -> DataFrame:
    return normalize_towers(cells(spark, sf_dir))


def remediations(spark, sf_dir) -> DataFrame:
    """Remediation records from sign-ups, with gaps."""
    e = F.col("event_id")
    return table(spark, sf_dir, "events").where("event_type = 'signup'").select(
        F.when(e % 3 == 0, "remediation-completed").alias("event_type"),
        F.when(e % 5 != 0, F.col("ts").cast("timestamp")).alias("event_time"),
        F.when(e % 2 == 0, F.concat(F.lit("Step "), e.cast("string"))).alias("description"),
        F.col("user_id").alias("cell_id"),
    )


def updown(spark, sf_dir) -> DataFrame:
    """Tower feed: errors take a tower down, purchases bring it up."""
    kind = F.when(F.col("event_type") == "error", "tower-down").when(
        F.col("event_type") == "purchase", "tower-up"
    )
    return table(spark, sf_dir, "events").select(
        kind.alias("type"), F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").alias("tower_id"),
    )


def resolutions(spark, sf_dir) -> DataFrame:
    """A sign-up resolves its cell at that time."""
    return table(spark, sf_dir, "events").where("event_type = 'signup'").select(
        F.col("user_id").alias("cell_id"), F.col("ts").cast("timestamp").alias("resolved_at")
    )


def marked_documents(spark, sf_dir) -> DataFrame:
    """Documents; the sources of every ninth one end as those of JSON files do."""
    source = F.when(F.col("doc_id") % 9 == 0, F.concat("source", F.lit(".JSON"))).otherwise(F.col("source"))
    return mark_whole(table(spark, sf_dir, "documents").withColumn("source", source))


def as_of():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def requests(spark, sf_dir) -> DataFrame:
    """Request texts of every shape, one per conversation turn."""
    cell = F.col("conv_id").cast("string")
    item = F.concat(
        F.lit("{'Cell ID': '"), cell, F.lit("', 'Datetime_ts': '2024-01-31T12:00:00'}")
    )
    kind = F.col("turn") % 4
    second = F.when(F.col("conv_id") % 5 == 0, F.replace(item, F.lit("01-31"), F.lit("02-30"))).otherwise(item)
    text = (
        F.when(kind == 0, F.concat(F.lit("Call ["), item, F.lit(", "), second, F.lit("] now")))
        .when(kind == 1, F.concat(
            F.lit("["), F.array_join(F.array_repeat(item, 7), ", "), F.lit("]")
        ))
        .when(kind == 2, F.concat(F.lit("cell "), cell))
        .otherwise(F.concat(F.lit("[{'Cell ID': "), item, F.lit("]")))
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.alias("text"))
