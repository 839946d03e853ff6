"""Per-cell roll-ups, network figures and the merged feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.lookups import event_badge, event_title
from celltide.functions.times import as_utc, duration_text
from celltide.operators.history import prior_n


def summary_parts(df: DataFrame, by=("cell_id",), order="item_no") -> DataFrame:
    """Count, kinds and newest anomaly of each group, in a form that `merge_summaries` can put together."""
    first = F.col(order) if order in df.columns else F.lit(0)
    rank = F.struct(
        F.col("creation_date"), (-first).alias("_first"),
        F.col("source_id") if "source_id" in df.columns else F.lit(None).alias("source_id"),
        F.col("anomaly"),
    )
    return df.groupBy(*by).agg(
        F.count("*").alias("anomaly_count"),
        F.array_sort(F.collect_set("anomaly_type")).alias("types"),
        F.max(rank).alias("_newest"),
    )


def merge_summaries(parts: DataFrame, by=("cell_id",)) -> DataFrame:
    """Parts of the same groups as one. There are few kinds, so few different sets of them."""
    return parts.groupBy(*by).agg(
        F.sum("anomaly_count").alias("anomaly_count"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("types")))).alias("types"),
        F.max("_newest").alias("_newest"),
    )


def summary_columns(parts: DataFrame) -> DataFrame:
    return parts.select(
        "cell_id", "anomaly_count", "types",
        F.col("_newest.anomaly").alias("latest_anomaly"),
        F.col("_newest.creation_date").alias("latest_date"),
    )


def anomaly_summary(df: DataFrame, order="item_no") -> DataFrame:
    """Per cell: count, kinds, newest anomaly and its date; the first wins on equal dates.

    All parts combine before the shuffle, so a cell with a third of the anomalies is no problem.
    """
    return summary_columns(summary_parts(df, order=order))


def anomalous_cells(anomalies: DataFrame) -> DataFrame:
    return anomalies.select("cell_id").where("cell_id IS NOT NULL").distinct()


def with_anomaly(towers: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Towers with `has_anomaly`. The anomaly side is one row per cell before the join."""
    marked = anomalous_cells(anomalies).select(
        F.col("cell_id").alias("id"), F.lit(True).alias("_hit")
    )
    return towers.join(marked, "id", "left").withColumn(
        "has_anomaly", F.coalesce("_hit", F.lit(False))
    ).drop("_hit")


def get_anomaly(summary: DataFrame, cell) -> DataFrame:
    return summary.where(F.col("cell_id") == cell)


def health_band(percent: Column) -> Column:
    return F.when(percent >= 90, "good").when(percent >= 70, "fair").otherwise("poor")


def network_health(towers: DataFrame, anomalies: DataFrame) -> DataFrame:
    """One row: towers, up, with anomalies, healthy, health percent and its band."""
    up = F.col("status") == "up"

    def total(test):
        return F.coalesce(F.sum(test.cast("bigint")), F.lit(0))

    row = with_anomaly(towers, anomalies).agg(
        F.count("*").alias("total_towers"),
        total(up).alias("active_towers"),
        total(F.col("has_anomaly")).alias("towers_with_anomalies"),
        total(up & ~F.col("has_anomaly")).alias("healthy_towers"),
    )
    percent = F.floor(F.try_divide(F.col("healthy_towers") * 100, F.col("total_towers")))
    return row.withColumn("health_percent", F.coalesce(percent, F.lit(0))).withColumn(
        "health_band", health_band(F.col("health_percent"))
    )


def marker_status(towers: DataFrame, anomalies: DataFrame, activity: DataFrame | None = None):
    """Marker of each tower: anomaly before down before drop rate of 2 or more before ok."""
    out = with_anomaly(towers, anomalies)
    if activity is not None:
        rates = activity.select(F.col("cell_id").alias("id"), "drop_rate")
        out = out.join(rates, "id", "left")
    elif "drop_rate" not in out.columns:
        out = out.withColumn("drop_rate", F.lit(None).cast("double"))
    return out.withColumn(
        "marker",
        F.when(F.col("has_anomaly"), "anomaly")
        .when(F.col("status") == "down", "down")
        .when(F.col("drop_rate") >= 2, "drops")
        .otherwise("ok"),
    )


def drop_severity(rate: Column) -> Column:
    return F.when(rate >= 10, "critical").when(rate >= 5, "warn").otherwise("normal")


def activity_parts(calls: DataFrame, by=("cell_id",)) -> DataFrame:
    """Calls, drops and last activity of each group."""
    dropped = F.coalesce(F.col("is_dropped"), F.lit(False)).cast("bigint")
    return calls.groupBy(*by).agg(
        F.count("*").alias("total_calls"),
        F.sum(dropped).alias("dropped_calls"),
        F.max("timestamp").alias("last_activity"),
    )


def merge_activities(parts: DataFrame, by=("cell_id",)) -> DataFrame:
    return parts.groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("total_calls", "dropped_calls")],
        F.max("last_activity").alias("last_activity"),
    )


def activity_rates(parts: DataFrame) -> DataFrame:
    rate = F.col("dropped_calls") * 100.0 / F.col("total_calls")
    return parts.withColumn("drop_rate", rate).withColumn(
        "drop_severity", drop_severity(F.col("drop_rate"))
    )


def tower_activity(calls: DataFrame) -> DataFrame:
    """Per cell: calls, drops, last activity, drop rate in percent and its severity."""
    return activity_rates(activity_parts(calls))


def latest_calls(calls: DataFrame, n=100, tie="call_id") -> DataFrame:
    ties = [tie] if tie in calls.columns else []
    return calls.orderBy(F.desc("timestamp"), *ties).limit(n)


def recent_dropped(calls: DataFrame, minutes=30, as_of: Column | None = None) -> DataFrame:
    """Dropped calls of the last `minutes` before `as_of`."""
    end = F.current_timestamp() if as_of is None else as_of
    start = end - F.make_interval(mins=F.lit(minutes))
    return calls.where(
        F.col("is_dropped") & (F.col("timestamp") >= start) & (F.col("timestamp") <= end)
    )


def _feed(df: DataFrame, **columns) -> DataFrame:
    return df.select(*[c.alias(n) for n, c in columns.items()])


def feed_anomalies(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Anomalies as feed rows. Times are UTC; unreadable and future ones become `as_of`."""
    now = F.current_timestamp() if as_of is None else as_of
    when = F.col("creation_date")
    if dict(df.dtypes)["creation_date"] == "string":
        when = as_utc(when)
    has_fix = "recommended_fix" in df.columns
    return _feed(
        df,
        type=F.lit("anomaly-detected"),
        timestamp=F.least(F.coalesce(when, now), now),
        message=F.concat(F.col("anomaly_type"), F.lit(": "), F.col("anomaly")),
        tower_id=F.col("cell_id").cast("bigint"),
        cell_id=F.col("cell_id").cast("string"),
        anomaly_type=F.col("anomaly_type"),
        band=F.col("band").cast("string"),
        source_id=F.col("source_id").cast("string"),
        recommended_fix=F.col("recommended_fix") if has_fix else F.lit(None).cast("string"),
    )


def feed_calls(df: DataFrame) -> DataFrame:
    """Calls as feed rows; a call without a cell stays without one."""
    return _feed(
        df,
        type=F.when(F.col("is_dropped"), "call-dropped").otherwise("call-placed"),
        timestamp=F.col("timestamp"),
        message=F.lit(""),
        tower_id=F.col("cell_id").cast("bigint"),
        cell_id=F.col("cell_id").cast("string"),
        location=F.col("location"),
        signal_strength=F.col("signal_strength"),
    )


def feed_remediation(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Remediation records as feed rows, with defaults for what is missing."""
    now = F.current_timestamp() if as_of is None else as_of
    return _feed(
        df,
        type=F.coalesce("event_type", F.lit("remediation-started")),
        timestamp=F.coalesce(F.col("event_time"), now),
        message=F.coalesce("description", F.lit("Remediation event")),
        tower_id=F.col("cell_id").cast("bigint"),
        cell_id=F.col("cell_id").cast("string"),
    )


def feed(*parts: DataFrame, cell=None, ordered=True) -> DataFrame:
    """All feeds in one, newest first; optionally of one cell."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    if cell is not None:
        out = out.where(F.col("cell_id") == str(cell))
    # Ties are ordered too, so that rows of one instant spread over the sort's ranges.
    return out.orderBy(F.desc("timestamp"), "cell_id", "type", "message") if ordered else out


def feed_cells(df: DataFrame) -> DataFrame:
    return df.select("cell_id").where("cell_id IS NOT NULL").distinct().orderBy("cell_id")


def feed_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({"title": event_title(F.col("type")), "badge": event_badge(F.col("type"))})


def recoveries(feed_df: DataFrame) -> DataFrame:
    """Tower-up rows whose previous up/down event was a down: `recovery_seconds`.

    The previous event comes from the sliced history, so a tower with very many events is split.
    """
    updown = feed_df.where(F.col("type").isin("tower-up", "tower-down")).select(
        "tower_id", "timestamp", "type"
    )
    told = prior_n(updown, 1, ("tower_id",), "timestamp", ("type",), name="_before")
    before = F.get("_before", F.lit(0))
    return told.where((F.col("type") == "tower-up") & (before["type"] == "tower-down")).select(
        "tower_id",
        "timestamp",
        (F.unix_timestamp("timestamp") - F.unix_timestamp(before["timestamp"])).alias(
            "recovery_seconds"
        ),
    )


def avg_recovery(feed_df: DataFrame) -> DataFrame:
    """One row: recoveries, mean seconds (0 when there are none) and its text."""
    row = recoveries(feed_df).agg(
        F.count("*").alias("recoveries"),
        F.coalesce(F.avg("recovery_seconds"), F.lit(0.0)).alias("avg_recovery_seconds"),
    )
    return row.withColumn("avg_recovery_text", duration_text(F.col("avg_recovery_seconds")))
