"""The registered queries: (session, table folder) -> DataFrame, over whole tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from celltide.functions import times
from celltide.functions.geo import haversine
from celltide.functions.lookups import band_frequency
from celltide.functions.numbers import frequency_mid
from celltide.operators import clean, eventstore, features, forecast, matching, reports
from celltide.operators import logparse, retrieval, rollups, rules, sequences, topology
from celltide.operators.history import prior_n, with_prior_means
from celltide.plans import views as v
from celltide.plans.exchange import EXCHANGED, loose_archive, quoted_archive
from celltide.schemas import KPI_COLUMNS
from celltide.session import materialize, scratch_path
from celltide.sinks.files import text_columns, write_archive
from celltide.sinks.messages import csv_line, encode_kpi_lines
from celltide.sources.positions import Positions, TableLog, run_until_empty
from celltide.sources.telemetry import (
    latest_batch,
    parse_du_lines,
    parse_kpi_lines,
    read_archive,
    split_payload,
    type_du,
    type_kpi,
)
from celltide.sources.topology import explode_cells
from celltide.streaming.detect import current, detect_stream, detect_with_tail
from celltide.streaming.ingest import ingest
from celltide.streaming.kept import ANOMALIES, CALLS, KeptRollup
from celltide.streaming.versions import EventTable

QUERIES = {}

def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def epoch(c, name="event_ts"):
    return F.unix_timestamp(c).alias(name)


def micros(c, name):
    return F.unix_micros(c).alias(name)


def r(c, digits=4, name=None):
    return F.round(c, digits).alias(name or c)


# Ingest

@query
def encode_lines(spark, sf):
    return encode_kpi_lines(v.kpi(spark, sf), ("event_id",))


@query
def ingest_lines(spark, sf):
    return split_payload(v.payloads(spark, sf))


def _readings(df: DataFrame, *keep):
    return df.select(
        *keep, "cell_id", epoch("event_time"), "band", "frequency", "ues_usage", "area_type",
        "lat", "lon", "city", F.array_join(F.col("adjacent_cells").cast("array<string>"), ",").alias(
            "adjacent"
        ), "rsrp", "rsrq", "sinr", "throughput_mbps", "latency_ms", "max_capacity",
    )


@query
def ingest_parse(spark, sf):
    good, _ = parse_kpi_lines(split_payload(v.payloads(spark, sf)))
    return _readings(type_kpi(good), "event_id")


@query
def ingest_quarantine(spark, sf):
    _, bad = parse_kpi_lines(split_payload(v.payloads(spark, sf)))
    return bad.select("event_id", "field_count", "line")


@query
def du_parse(spark, sf):
    good, _ = parse_du_lines(split_payload(v.du_payloads(spark, sf)))
    return type_du(good).withColumn("event_ts", F.unix_timestamp("event_time")).drop("event_time")


@query
def archive_scan(spark, sf):
    path = scratch_path(spark, "ran-combined-metrics")
    write_archive(v.kpi(spark, sf).select(*KPI_COLUMNS), path)
    return _readings(type_kpi(read_archive(spark, path)))


@query
def latest_batch_rows(spark, sf):
    batches = v.kpi(spark, sf).withColumn("batch_day", F.to_date("event_time"))
    return latest_batch(batches, "batch_day").select("event_id", "cell_id", epoch("event_time"))


@query
def stream_ingest(spark, sf):
    folder = scratch_path(spark, "ingest")
    events = v.stream(spark, sf, "events")
    lines = v.kpi_of(events).select(csv_line(text_columns(v.kpi_of(events))).alias("value"))
    ingest(lines, f"{folder}/archive", f"{folder}/bad", f"{folder}/checkpoint").awaitTermination()
    return _readings(spark.read.parquet(f"{folder}/archive"))


@query
def stream_detect(spark, sf):
    return _streamed(spark, sf, detect_stream, "archive")


@query
def stream_detect_tail(spark, sf):
    return _streamed(spark, sf, detect_with_tail, "state")


def _streamed(spark, sf, start, store):
    folder = scratch_path(spark, "detect")
    events = v.stream(spark, sf, "events")
    readings = clean.filter_valid_bands(v.kpi_of(events))
    start(
        readings, f"{folder}/{store}", f"{folder}/out", f"{folder}/checkpoint"
    ).awaitTermination()
    return _flags(spark.read.parquet(f"{folder}/out"))


@query
def stream_detect_late(spark, sf):
    """Six files, one a batch: five days each, a fifth of the readings one file late and some two or four."""
    folder = scratch_path(spark, "late")
    kpi = v.valid_kpi(spark, sf)
    e = F.col("event_id")
    delay = F.when(e % 5 == 0, 1).when(e % 31 == 0, 2).when(e % 37 == 0, 4).otherwise(0)
    turn = F.least(F.floor(F.dayofmonth("event_time") / 6) + delay, F.lit(5))
    dealt = materialize(kpi.withColumn("turn", turn), "dealt")
    for k in range(6):
        dealt.where(F.col("turn") == k).drop("turn").coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(kpi.schema).parquet(f"{folder}/in")
        detect_stream(stream, f"{folder}/store", f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return _flags(current(spark.read.parquet(f"{folder}/out")))


def _log(spark, sf):
    """The lines as a log of four partitions, one with five eighths of them; places start anywhere and have gaps."""
    e = F.col("event_id")
    part = F.element_at(F.array(*map(F.lit, (0, 0, 0, 0, 0, 1, 2, 3))), (e % 8 + 1).cast("int"))
    lines = v.payloads_of(v.spread(spark, sf, "events", "event_id"))
    return TableLog(lines.select("event_id", "value", part.alias("partition"), (e * 3 + 50).alias("offset")))


def _bounded(spark, sf, part):
    """Runs of a limited number of places until the log is read; the second run fails first, after it has stored."""
    folder = scratch_path(spark, "bounded")
    positions, failed = Positions(spark, f"{folder}/positions"), []

    def work(records, number):
        good, bad = parse_kpi_lines(split_payload(records))
        for name, rows in (("good", type_kpi(good)), ("bad", bad)):
            rows.write.mode("overwrite").parquet(f"{folder}/{name}/run={number}")
        if number == 1 and not failed:
            failed.append(number)
            raise InterruptedError("the consumer went away")

    log = _log(spark, sf)
    span = log.table.agg((F.max("offset") - F.min("offset")).alias("s")).first()["s"] or 0
    limit = span * 4 // 3 + 1
    try:
        run_until_empty(log, positions, work, limit)
    except InterruptedError:
        run_until_empty(log, positions, work, limit)
    return spark.read.parquet(f"{folder}/{part}")


@query
def bounded_ingest(spark, sf):
    return _readings(_bounded(spark, sf, "good"), "event_id")


@query
def bounded_quarantine(spark, sf):
    return _bounded(spark, sf, "bad").select("event_id", "line", "field_count")


# Cleaning and classes

@query
def clean_kpi(spark, sf):
    return clean.clean_kpi(v.kpi_text(spark, sf)).select(
        "event_id", "cell_id", epoch("event_time"), "band", "area_type", "ues_usage",
        "max_capacity", "rsrp",
    )


@query
def valid_bands(spark, sf):
    return v.valid_kpi(spark, sf).select(
        "event_id", "cell_id", epoch("event_time"), "band", "ues_usage"
    )


@query
def band_profile(spark, sf):
    return clean.band_profile(v.kpi(spark, sf))


@query
def cell_band_map(spark, sf):
    return clean.cell_band_map(v.kpi(spark, sf))


@query
def band_frequency_rows(spark, sf):
    rows = v.kpi(spark, sf).select("event_id", "band")
    return rows.withColumn("frequency", band_frequency(F.col("band")))


@query
def frequency_mid_rows(spark, sf):
    rows = v.kpi(spark, sf).select("event_id", "frequency")
    return rows.withColumn("mid", frequency_mid(F.col("frequency")))


@query
def daypart(spark, sf):
    return clean.with_daypart(v.kpi(spark, sf)).select("event_id", "daypart", "daytype")


@query
def usage_vs_profile(spark, sf):
    return clean.usage_vs_profile(v.kpi(spark, sf)).select(
        "event_id", r("usage_share", 6), "low", "high", "outside"
    )


# Features

@query
def temporal_features(spark, sf):
    return features.temporal_features(v.kpi(spark, sf)).select(
        "event_id", "hour", "day", "month", "weekday", "weekend", "day_name", "date", "event_ts"
    )


@query
def traffic_grouped(spark, sf):
    return features.traffic_grouped(v.kpi(spark, sf)).select(
        "cell_id", "event_ts", "frequency", "ues_usage", "day_name", "weekend"
    )


@query
def traffic_class(spark, sf):
    return features.traffic_class(features.traffic_grouped(v.kpi(spark, sf))).select(
        "cell_id", "event_ts", "frequency", "ues_usage", "traffic_class"
    )


@query
def onehot_dow(spark, sf):
    table = features.onehot_dow(features.traffic_grouped(v.kpi(spark, sf)))
    return table.select(
        "cell_id", "event_ts", "frequency", *[c for c in table.columns if c.startswith("dow_")]
    )


@query
def onehot_freq(spark, sf):
    table = features.onehot_freq(features.traffic_grouped(v.kpi(spark, sf)))
    return table.select(
        "cell_id", "event_ts", "frequency", *[c for c in table.columns if c.startswith("freq_")]
    )


@query
def traffic_hourly(spark, sf):
    return features.traffic_hourly(v.kpi(spark, sf)).withColumn(
        "date", F.col("date").cast("string")
    )


@query
def topn_adjacent(spark, sf):
    return features.topn_adjacent(v.kpi(spark, sf))


@query
def adj_flags(spark, sf):
    table = features.traffic_grouped(v.kpi(spark, sf), top_n=10)
    return table.select(
        "cell_id", "event_ts", "frequency", *[c for c in table.columns if c.startswith("adj_top")]
    )


@query
def feature_matrix(spark, sf):
    table = features.traffic_features(v.kpi(spark, sf), wide=True)
    matrix = forecast.feature_matrix(table, wide=True)
    return matrix.select(
        "cell_id", "event_ts", "frequency", "ues_usage", "traffic_class",
        F.array_join(
            vector_to_array("features").cast("array<bigint>").cast("array<string>"), ","
        ).alias("features"),
    )


@query
def split_counts(spark, sf):
    table = features.with_part(features.traffic_features(v.kpi(spark, sf)))
    return table.groupBy("part").agg(F.count("*").alias("n"))


def _parts(spark, sf):
    """Train and test parts of a stored table: training goes over it many times, so rows are stored with their part."""
    marked = features.with_part(features.traffic_features(v.kpi(spark, sf)))
    return features.parts(materialize(marked, "traffic"))


def _ends(train):
    """The labels a forest has seen; a mean of them lies between the least and the greatest."""
    return train.agg(F.min("ues_usage").alias("low"), F.max("ues_usage").alias("high"))


@query
def rf_regressor(spark, sf):
    train, test = _parts(spark, sf)
    scored = forecast.predict_usage(test, forecast.train_regressor(train))
    low, high = (_ends(train).select(c).scalar() for c in ("low", "high"))
    return scored.select(
        "cell_id", "event_ts", "frequency", "ues_usage",
        F.col("predicted_usage").between(low - 1e-9, high + 1e-9).alias("in_range"),
    )


@query
def rf_classifier(spark, sf):
    train, test = _parts(spark, sf)
    scored = forecast.predict_class(test, forecast.train_classifier(train))
    likely = F.when(F.col("confidence") > 0.5, 1).otherwise(0)
    return scored.select(
        "cell_id", "event_ts", "frequency", "traffic_class",
        (F.col("confidence").between(0, 1) & (F.col("predicted_class") == likely)).alias("consistent"),
    )


@query
def rf_metrics(spark, sf):
    """What must hold for the held-out figures. User counts of the view are noise, so no forest can
    do better than their mean; classes follow from the counts, so it must beat the commoner class."""
    train, test = _parts(spark, sf)
    found = forecast.evaluate(*forecast.train_traffic(train), test)
    label = test.agg(
        F.stddev_pop("ues_usage").alias("spread"),
        F.greatest(F.avg("traffic_class"), 1 - F.avg("traffic_class")).alias("common"),
    )
    spread, common = (label.select(c).scalar() for c in ("spread", "common"))
    value = F.col("value")
    holds = (
        F.when(F.col("metric").isin("mae", "rmse"), value.between(0, 1.25 * spread))
        .when(F.col("metric") == "r2", value.between(1 - 1.25**2, 1))
        .when(F.col("metric") == "accuracy", value.between(common, 1))
        .otherwise(value.between(0, 1))
    )
    return found.select("model", "metric", holds.alias("holds"))


# A small forest of each kind, so that every engine can tell what it predicts.
USAGE_TREES = [
    ("hour", 11.5, ("cell_id", 60.0, 21.25, ("weekend", 0.5, 27.5, 33.125)), ("day", 15.5, 30.0, ("weekday", 2.5, 18.75, 41.0))),
    ("cell_id", 99.5, ("dow_monday", 0.5, 22.1, 35.3), ("hour", 17.5, 29.9, 12.7)),
    ("month", 1.5, ("event_ts", 1704900000.0, 19.6, 26.4), 50.2),
]
CLASS_TREES = [
    ("ues_usage", 39.5, ("hour", 6.5, 0.05, 0.1), ("cell_id", 75.5, 0.9, 0.8)),
    ("ues_usage", 45.5, ("dow_sunday", 0.5, 0.2, 0.45), 0.95),
    ("weekend", 0.5, ("ues_usage", 30.5, 0.15, 0.7), ("ues_usage", 35.5, 0.3, 0.85)),
]


@query
def given_forest(spark, sf):
    """Held-out rows scored by forests given as trees."""
    _, test = features.split(features.traffic_features(v.kpi(spark, sf)))
    scored = forecast.predict_class(forecast.predict_usage(test, USAGE_TREES), CLASS_TREES)
    return scored.select(
        "cell_id", "event_ts", "frequency", F.round("predicted_usage", 6).alias("predicted_usage"),
        "predicted_class", F.round("confidence", 6).alias("confidence"))


@query
def given_metrics(spark, sf):
    """Held-out figures of the same forests."""
    _, test = features.split(features.traffic_features(v.kpi(spark, sf)))
    found = forecast.evaluate(USAGE_TREES, CLASS_TREES, test)
    return found.select("model", "metric", F.round("value", 6).alias("value"))


@query
def given_forecast(spark, sf):
    """Forecasts of the same forests for every cell and time of the telemetry."""
    asked = v.kpi(spark, sf).select("cell_id", "event_time").distinct()
    return forecast.forecast(asked, USAGE_TREES, CLASS_TREES, threshold=28.0).select(
        "cell_id", epoch("event_time"), "cell_busy", "confidence", "predicted_ues_usage", "threshold", "over_threshold")


@query
def forecast_rows(spark, sf):
    train, _ = _parts(spark, sf)
    models = forecast.train_traffic(train)
    asked = v.kpi(spark, sf).select("cell_id", "event_time").distinct()
    low, high = (_ends(train).select(c).scalar() for c in ("low", "high"))
    usage = F.col("predicted_ues_usage")
    return forecast.forecast(asked, *models).select(
        "cell_id", epoch("event_time"), "threshold",
        (usage.between(low - 0.01, high + 0.01) & F.col("confidence").between(0, 1)).alias("in_range"),
    )


# History and rules

def _flags(df):
    return df.select(
        "event_id", *rules.FLAGS.values(),
        F.concat_ws(";", *[F.when(F.col(f), k) for k, f in rules.FLAGS.items()]).alias(
            "anomaly_types"
        ),
        sum(F.col(f).cast("int") for f in rules.FLAGS.values()).alias("n_anomalies"),
    )


@query
def prior3(spark, sf):
    rows = v.valid_kpi(spark, sf)
    told = with_prior_means(prior_n(rows))
    return told.select(
        "event_id", "prior_count", r("avg_prior_throughput", 6), r("avg_prior_ues", 6),
        F.array_join(F.transform("prior", lambda p: p["throughput_mbps"].cast("string")), ",").alias(
            "prior_throughputs"
        ),
    )


def _single(spark, sf):
    return rules.flag(rules.without_history(v.valid_kpi(spark, sf)))


@query
def rule_prb(spark, sf):
    rows = rules.without_history(v.with_capacities(v.valid_kpi(spark, sf)))
    return rules.flag(rows).select("event_id", r("prb_percent"), "is_prb", "is_prb_error")


@query
def rules_from_text(spark, sf):
    good, _ = parse_kpi_lines(split_payload(v.defective_lines(spark, sf)))
    return _flags(rules.detect(clean.filter_valid_bands(type_kpi(good))))


@query
def rule_rsrp(spark, sf):
    return _single(spark, sf).select("event_id", "rsrp", "is_rsrp")


@query
def rule_sinr(spark, sf):
    return _single(spark, sf).select("event_id", "sinr", "is_sinr")


@query
def rule_outage(spark, sf):
    return _single(spark, sf).select("event_id", "is_outage")


@query
def rule_throughput(spark, sf):
    return v.detected(spark, sf).select("event_id", r("avg_prior_throughput", 6), "is_throughput")


@query
def rule_ues(spark, sf):
    return v.detected(spark, sf).select("event_id", r("avg_prior_ues", 6), "is_ues")


@query
def anomaly_flags(spark, sf):
    return _flags(v.detected(spark, sf))


@query
def anomalies_long(spark, sf):
    long = rules.anomalies_long(v.detected(spark, sf))
    return long.select(
        "cell_id", "band", epoch("event_time"), "rule_no", "anomaly_type", r("value"),
        r("threshold"),
    )


@query
def anomaly_text(spark, sf):
    return rules.anomalies_long(v.detected(spark, sf), ("event_id",)).select(
        "event_id", "rule_no", "text"
    )


@query
def minmax(spark, sf):
    scaled = sequences.minmax(v.kpi(spark, sf))
    return scaled.select(
        "event_id", *[r(f"{c}_scaled", 6) for c in sequences.KPI_SCALED]
    )


@query
def prior3_split(spark, sf):
    return with_prior_means(prior_n(v.valid_kpi(spark, sf))).select(
        "event_id", "prior_count", r("avg_prior_throughput", 6), r("avg_prior_ues", 6)
    )


def _sequences(spark, sf):
    return sequences.sequences(v.valid_kpi(spark, sf))


@query
def sequence_rows(spark, sf):
    return _sequences(spark, sf).select(
        "event_id",
        F.size("sequence").alias("steps"),
        epoch(F.get("sequence", F.lit(0))["event_time"], "oldest_ts"),
        F.array_join(
            F.transform("sequence", lambda s: s["throughput_mbps"].cast("string")), ","
        ).alias("throughputs"),
    )


@query
def sequence_score(spark, sf):
    scored = sequences.sequence_score(_sequences(spark, sf))
    return scored.select("event_id", r("baseline_throughput_mbps"), r("score"))


# Reports

@query
def report_text(spark, sf):
    return reports.render_report(v.detected(spark, sf)).select("event_id", "report_text")


@query
def request_text(spark, sf):
    return reports.request_text(v.detected(spark, sf)).select("event_id", "request_text")


@query
def extract_block(spark, sf):
    rows = v.answered(spark, sf)
    return rows.select(
        "event_id", reports.extract_block(F.col("raw_response")).alias("block"),
        reports.block_body(F.col("raw_response")).alias("body"),
    )


@query
def reconcile(spark, sf):
    return reports.reconcile(v.answered(spark, sf)).select(
        "event_id", "is_anomaly", "outcome", "reason", "event_text"
    )


@query
def verify_text(spark, sf):
    rows = reports.verify_text(_failed_calls(v.answered(spark, sf)))
    return rows.select("event_id", "verdict", "is_verified")


@query
def verify_row(spark, sf):
    rows = reports.verify_row(_failed_calls(v.answered(spark, sf)))
    return rows.select("event_id", "verdict", "is_verified", "verified_reason")


def _failed_calls(df):
    return df.withColumn("raw_response", F.coalesce("raw_response", F.lit(reports.CALL_FAILED)))


@query
def batch_report(spark, sf):
    report = reports.batch_report(reports.reconcile(v.answered(spark, sf)))
    return report.select("cell_id", "band", epoch("event_time"), "report_text")


@query
def remediation_json(spark, sf):
    return reports.remediation(reports.reconcile(v.answered(spark, sf))).select(
        "cell_id", "band", epoch("event_time"), "anomaly_type", "anomaly_value",
        "threshold_value", "action", "azimuth_change", "downtilt_change", "value",
    )


# Log parser

def _report_events(spark, sf):
    rows = reports.render_report(v.detected(spark, sf)).where("is_anomaly")
    return rows.select(
        F.col("event_id").alias("id"), F.col("report_text").alias("event"),
        F.col("event_time").alias("creation_date"),
    )


@query
def parse_lines(spark, sf):
    return logparse.parse_lines(_report_events(spark, sf))


@query
def parse_blocks(spark, sf):
    return logparse.parse_blocks(_report_events(spark, sf))


@query
def parse_fixes(spark, sf):
    return logparse.parse_fixes(_report_events(spark, sf))


@query
def parse_anomalies(spark, sf):
    return logparse.parse_anomalies(v.event_texts(spark, sf)).select(
        "source_id", "cell_id", "band", "anomaly_type", "anomaly", "recommended_fix",
        r("measured_value"), epoch("creation_date", "created_ts"),
    )


@query
def parse_dedupe(spark, sf):
    twice = _report_events(spark, sf).withColumn(
        "event", F.concat("event", F.lit("\n"), "event")
    )
    return logparse.parse_anomalies(twice).select(
        "source_id", "cell_id", "band", "anomaly_type", "anomaly", "recommended_fix"
    )


# Topology

@query
def topology_explode(spark, sf):
    nested = v.cells(spark, sf).select(F.array(F.struct("*")).alias("cells"))
    return explode_cells(nested).select(
        "cell_id", "city", "area_type", "max_capacity", F.array_join("bands", ",").alias("bands")
    )


@query
def cell_bands(spark, sf):
    return topology.cell_bands(v.cells(spark, sf))


@query
def haversine_rows(spark, sf):
    centre = 33.0 + F.regexp_extract("city", r"(\d+)", 1).cast("bigint") * 0.05
    return v.cells(spark, sf).select(
        "cell_id", F.round(haversine(F.col("lat"), F.col("lon"), centre, F.lit(-97.0)), 6).alias(
            "distance_km"
        )
    )


@query
def candidate_links(spark, sf):
    return topology.candidate_links(v.cells(spark, sf))


@query
def nearest_links(spark, sf):
    return matching.nearest_links(v.cells(spark, sf)).withColumn(
        "distance_km", F.round("distance_km", 6)
    )


@query
def neighbour_links(spark, sf):
    links = matching.match_neighbours(v.cells(spark, sf))
    return links.select("city", "a", "b", r("distance_km", 6), "shared")


@query
def links_by_rings(spark, sf):
    """Every city matched as the largest ones are."""
    links = matching.match_neighbours(v.cells(spark, sf), max_group=0)
    return links.select("city", "a", "b", r("distance_km", 6), "shared")


@query
def nearest_by_rings(spark, sf):
    return matching.nearest_links(v.cells(spark, sf), max_group=0).withColumn(
        "distance_km", F.round("distance_km", 6)
    )


@query
def adjacency(spark, sf):
    cells = v.cells(spark, sf)
    table = matching.adjacency(matching.match_neighbours(cells), cells)
    return table.select(
        "cell_id", "city", "wanted", F.size("adjacent_cells").alias("degree"),
        F.array_join(F.col("adjacent_cells").cast("array<string>"), ",").alias("adjacent"),
    )


@query
def topology_audit(spark, sf):
    return topology.audit_topology(v.cells(spark, sf)).withColumn(
        "distance_km", F.round("distance_km", 6)
    )


@query
def degree_stats(spark, sf):
    return topology.degree_stats(v.cells(spark, sf)).withColumn(
        "avg_degree", F.round("avg_degree", 6)
    )


@query
def topology_counts(spark, sf):
    return topology.topology_counts(v.cells(spark, sf))


@query
def topology_edges(spark, sf):
    return topology.edges(v.cells(spark, sf))


@query
def cell_sentences(spark, sf):
    return topology.cell_sentences(v.cells(spark, sf)).select("cell_id", "page_content")


# Roll-ups and feeds

@query
def towers(spark, sf):
    return v.towers(spark, sf).select(
        "id", "name", "lat", "lng", "status", F.array_join("bands", ",").alias("bands"), "city",
        "area_type", "max_capacity",
    )


@query
def anomaly_summary(spark, sf):
    return rollups.anomaly_summary(v.anomaly_rows(spark, sf)).select(
        "cell_id", "anomaly_count", F.array_join("types", ";").alias("types"), "latest_anomaly",
        epoch("latest_date", "latest_ts"),
    )


@query
def network_health(spark, sf):
    return rollups.network_health(v.towers(spark, sf), v.anomalous(spark, sf))


@query
def marker_status(spark, sf):
    activity = rollups.tower_activity(v.calls(spark, sf))
    marked = rollups.marker_status(v.towers(spark, sf), v.anomalous(spark, sf), activity)
    return marked.select("id", "status", "has_anomaly", r("drop_rate"), "marker")


def _kept(spark, sf, rows, kind, time):
    """The roll-up of rows that come in four batches, each with rows of all weeks, the second of them twice."""
    dealt = rows.withColumn("turn", F.pmod(F.dayofmonth(time) * 7 + F.col("cell_id"), F.lit(4)))
    dealt = materialize(dealt, "dealt")
    kept = KeptRollup(spark, scratch_path(spark, "kept"), kind)
    for number in (0, 1, 1, 2, 3):
        kept.add(dealt.where(F.col("turn") == (number * 3 + 2) % 4).drop("turn"), number)
    return kept.read(rows, 3)


@query
def kept_summary(spark, sf):
    kept = _kept(spark, sf, v.anomaly_rows(spark, sf), ANOMALIES, "creation_date")
    return kept.select(
        "cell_id", "anomaly_count", F.array_join("types", ";").alias("types"), "latest_anomaly",
        epoch("latest_date", "latest_ts"),
    )


@query
def kept_health(spark, sf):
    kept = _kept(spark, sf, v.anomaly_rows(spark, sf), ANOMALIES, "creation_date")
    return rollups.network_health(v.towers(spark, sf), kept)


@query
def kept_activity(spark, sf):
    return _kept(spark, sf, v.calls(spark, sf), CALLS, "timestamp").select(
        "cell_id", "total_calls", "dropped_calls", micros("last_activity", "last_ts"),
        r("drop_rate"), "drop_severity",
    )


def _feed_columns(df):
    return df.withColumn("feed_ts", F.unix_micros("timestamp")).drop("timestamp")


@query
def feed_anomalies(spark, sf):
    return _feed_columns(rollups.feed_anomalies(v.anomaly_rows(spark, sf), v.as_of()))


@query
def feed_calls(spark, sf):
    feed = _feed_columns(rollups.feed_calls(v.calls(spark, sf)))
    return feed.select("*", "location.lat", "location.lng").drop("location")


@query
def feed_remediation(spark, sf):
    return _feed_columns(rollups.feed_remediation(v.remediations(spark, sf), v.as_of()))


def _whole_feed(spark, sf):
    return rollups.feed(
        rollups.feed_anomalies(v.anomaly_rows(spark, sf), v.as_of()),
        rollups.feed_remediation(v.remediations(spark, sf), v.as_of()),
        rollups.feed_calls(v.calls(spark, sf)),
    )


@query
def feed(spark, sf):
    return _whole_feed(spark, sf).select(
        "type", micros("timestamp", "feed_ts"), "message", "tower_id", "cell_id",
        "signal_strength", "anomaly_type", "band", "source_id",
    )


@query
def feed_cells(spark, sf):
    return rollups.feed_cells(_whole_feed(spark, sf))


@query
def feed_labels(spark, sf):
    labelled = rollups.feed_labels(_whole_feed(spark, sf))
    return labelled.groupBy("type", "title", "badge").agg(F.count("*").alias("n"))


@query
def tower_activity(spark, sf):
    return rollups.tower_activity(v.calls(spark, sf)).select(
        "cell_id", "total_calls", "dropped_calls", micros("last_activity", "last_ts"),
        r("drop_rate"), "drop_severity",
    )


@query
def latest_calls(spark, sf):
    return rollups.latest_calls(v.calls(spark, sf)).select(
        "call_id", "cell_id", micros("timestamp", "call_ts"), "is_dropped", "signal_strength"
    )


@query
def recent_dropped(spark, sf):
    week = rollups.recent_dropped(v.calls(spark, sf), 7 * 24 * 60, v.as_of())
    return week.select("call_id", "cell_id", micros("timestamp", "call_ts"))


@query
def avg_recovery(spark, sf):
    return rollups.avg_recovery(v.updown(spark, sf)).select(
        "recoveries", r("avg_recovery_seconds"), "avg_recovery_text"
    )


@query
def duration_text(spark, sf):
    seconds = (F.col("event_id") * 37) % 20000
    return v.kpi(spark, sf).select("event_id", seconds.alias("seconds")).withColumn(
        "duration", times.duration_text(F.col("seconds"))
    )


# Event store

@query
def events_scan(spark, sf):
    return v.event_store(spark, sf).select(
        "id", "cell_id", micros("creation_date", "created_ts"), "event", "data", "active"
    )


@query
def event_rows(spark, sf):
    return eventstore.to_events(reports.reconcile(v.answered(spark, sf))).select(
        "cell_id", epoch("creation_date", "created_ts"), "event", "data", "active"
    )


@query
def active_cells(spark, sf):
    return eventstore.active_cells(v.event_store(spark, sf))


@query
def active_events(spark, sf):
    return eventstore.active_events(v.event_store(spark, sf)).select(
        "id", "cell_id", micros("creation_date", "created_ts"), "event"
    )


@query
def latest_events(spark, sf):
    texts = v.event_texts(spark, sf)
    return eventstore.latest_events(texts).select(
        "id", epoch("creation_date", "created_ts"), "snippet"
    )


@query
def event_details(spark, sf):
    rows = v.kpi(spark, sf)
    stored = rows.select(
        F.col("event_id").alias("id"), "cell_id", F.col("event_time").alias("creation_date"),
        F.lit(eventstore.DETECTED_EVENT).alias("event"), F.lit(1).alias("active"),
        csv_line(text_columns(rows)).alias("data"),
    )
    return _readings(eventstore.event_details(stored), "id", "event", "active")


@query
def resolve_cell(spark, sf):
    events = eventstore.with_active(v.event_store(spark, sf), v.resolutions(spark, sf))
    return events.select("id", "cell_id", "active")


@query
def resolve_range(spark, sf):
    events = v.event_store(spark, sf)
    rows, _ = eventstore.resolve_range(events, 30, 39, v.as_of())
    return eventstore.with_active(events, rows).groupBy("cell_id").agg(
        F.count("*").alias("events"), F.sum("active").alias("active_events")
    )


@query
def resolve_all(spark, sf):
    """Every cell is resolved as of a time; what is newer stays open."""
    events = v.event_store(spark, sf)
    rows, _ = eventstore.resolve_all(events, v.as_of())
    return eventstore.with_active(events, rows).select("id", "cell_id", "active")


def _folded(spark, sf):
    """Events and resolutions in four mixed batches; ranges are folded between them, and the last batch is not."""
    table = EventTable(spark, scratch_path(spark, "event-table"), span=20)
    events, resolutions = v.event_store(spark, sf), v.resolutions(spark, sf)
    second = F.unix_timestamp("resolved_at") % 4
    for batch in range(4):
        table.append(batch, events.where(F.col("id") % 4 == (batch * 3 + 1) % 4),
                     resolutions.where(second == batch))
        if batch == 0:
            table.fold(0, 59)
        if batch == 2:
            table.fold()
            table.vacuum()
    return table


@query
def folded_events(spark, sf):
    return _folded(spark, sf).events().select("id", "cell_id", "active")


@query
def folded_open(spark, sf):
    return _folded(spark, sf).active_events().select(
        "id", "cell_id", micros("creation_date", "created_ts"), "event", "data"
    )


@query
def resolved_count(spark, sf):
    _, closed = eventstore.resolve_range(v.event_store(spark, sf), 30, 39, v.as_of())
    return closed


# Retrieval and requests

@query
def doc_source(spark, sf):
    return v.marked_documents(spark, sf).select(
        "doc_id", "source", "whole", F.length("text").alias("chars")
    )


def _chunks(df):
    return df.select(
        "doc_id", "chunk_no", F.length("chunk_text").alias("chars"),
        F.md5(F.col("chunk_text").cast("binary")).alias("digest"),
    )


@query
def chunk_documents(spark, sf):
    documents = v.marked_documents(spark, sf)
    return _chunks(retrieval.chunk_documents(documents, whole=F.col("whole")))


@query
def chunk_at_separators(spark, sf):
    """Each document's words, put together again from its chunks, and how the chunks are numbered and sized.

    A chunk goes on where the last one ended or repeats its end: as many signs as both share there are taken
    once. What remains after white space is left out must be the text's own signs, all of them and in order.
    """
    documents = v.marked_documents(spark, sf)
    chunks = retrieval.chunk_at_separators(documents, whole=F.col("whole"))
    whole = F.coalesce(F.col("whole"), F.lit(False))
    placed = retrieval.chunk_places(documents, chunks)
    return placed.join(documents.select("doc_id", whole.alias("whole")), "doc_id").groupBy("doc_id", "whole").agg(
        F.min((F.col("stop") - F.col("start") <= 1500) | F.col("whole")).alias("fits"),
        (F.max("chunk_no") == F.count("*")).alias("counted"),
        F.md5(F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("chunk_no", "fresh"))), lambda c: c["fresh"]), "").cast("binary")
        ).alias("signs_digest"),
    )


@query
def vector_topk(spark, sf):
    vectors = v.table(spark, sf, "embeddings")
    asked = retrieval.label_centroids(vectors).withColumnRenamed("label", "query_id")
    return retrieval.nearest(vectors, asked).select(
        "query_id", "vec_id", "rank", r("distance")
    )


@query
def route(spark, sf):
    rows = v.table(spark, sf, "conversations")
    label = F.when(F.col("turn") % 3 == 0, "prediction please").when(
        F.col("turn") % 3 == 1, "Upgrade"
    ).otherwise("GENERAL")
    asked = F.when(F.col("conv_id") % 4 == 0, F.concat(F.lit("Yaml? "), "text")).otherwise(
        F.col("text")
    )
    routed = retrieval.route(rows.withColumns({"label": label, "query": asked}))
    return routed.select("conv_id", "turn", "route")


@query
def parse_request(spark, sf):
    parsed = retrieval.parse_request(v.requests(spark, sf))
    return parsed.select(
        "conv_id", "turn", F.size("requests").alias("items"),
        F.get("requests", F.lit(0)).getField("Cell ID").alias("first_cell"), "error",
    )


def _outer(spark, sf):
    rows = v.kpi(spark, sf)
    scores = rows.where("event_id % 3 <> 0").select(
        "cell_id", "event_time", (F.abs("rsrq") / 20).alias("anomaly_score")
    )
    traffic = rows.where("event_id % 5 <> 0").select(
        "cell_id", "event_time", F.col("ues_usage").alias("predicted_traffic")
    )
    return retrieval.join_kpi_du(scores, traffic, v.du(spark, sf).drop("event_id"))


@query
def kpi_du_outer(spark, sf):
    return _outer(spark, sf).select(
        "cell_id", epoch("event_time"), r("anomaly_score"), "predicted_traffic", "cpu_pct",
        "memory_mb", "power_w",
    )


@query
def status_text(spark, sf):
    return retrieval.status_text(_outer(spark, sf)).select(
        "cell_id", epoch("event_time"), "status_text"
    )


RENAMED = {
    "latest_batch_rows": "latest_batch",
    "band_frequency_rows": "band_frequency",
    "frequency_mid_rows": "frequency_mid",
    "forecast_rows": "forecast",
    "sequence_rows": "sequences",
    "haversine_rows": "haversine",
}
QUERIES = {RENAMED.get(k, k): fn for k, fn in QUERIES.items()}


# Files written and read again

QUERIES.update(EXCHANGED)


@query
def archive_quotes(spark, sf):
    return _readings(quoted_archive(spark, sf))


@query
def archive_headers(spark, sf):
    return _readings(loose_archive(spark, sf))
