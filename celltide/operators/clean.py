"""Cleaning, band filters and per-row classes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltide.functions.lookups import VALID_BANDS, usage_range
from celltide.functions.numbers import drop_nan, to_number
from celltide.functions.text import int_list
from celltide.functions.times import daypart, daytype, parse_time


def clean_kpi(df: DataFrame) -> DataFrame:
    """Training-path cleaning of text or typed telemetry.

    Rows without a numeric cell id or a readable time are dropped; a bad user count becomes 0;
    capacity is rounded half-even; missing band and area get a name.
    """
    kinds = dict(df.dtypes)

    def number(c):
        return to_number(F.col(c)) if kinds[c] == "string" else drop_nan(
            F.col(c).cast("double")
        )

    columns = {
        "cell_id": number("cell_id").cast("bigint"),
        "event_time": parse_time(F.col("event_time")),
        "ues_usage": F.coalesce(number("ues_usage"), F.lit(0.0)),
        "max_capacity": F.bround(number("max_capacity")).cast("bigint"),
        "band": F.coalesce("band", F.lit("Unknown Band")),
        "area_type": F.coalesce("area_type", F.lit("Unknown Area")),
    }
    for c in ("rsrp", "rsrq", "sinr", "throughput_mbps", "latency_ms", "lat", "lon"):
        if c in kinds:
            columns[c] = number(c)
    if kinds.get("adjacent_cells") == "string":
        columns["adjacent_cells"] = int_list(F.col("adjacent_cells"))
    return df.withColumns(columns).where("cell_id IS NOT NULL AND event_time IS NOT NULL")


def numbers_without_commas(df: DataFrame, columns) -> DataFrame:
    """'1,234.5' -> 1234.5 in the given columns; rows missing any of them are dropped."""
    typed = {c: to_number(F.regexp_replace(F.col(c).cast("string"), ",", "")) for c in columns}
    return df.withColumns(typed).dropna(subset=list(columns))


def filter_valid_bands(df: DataFrame, bands=tuple(VALID_BANDS)) -> DataFrame:
    return df.where(F.col("band").isin(*bands))


def band_profile(df: DataFrame, bands=tuple(VALID_BANDS)) -> DataFrame:
    """Rows per band, and whether the band is scored."""
    return df.groupBy("band").agg(F.count("*").alias("n")).withColumn(
        "is_valid", F.coalesce(F.col("band").isin(*bands), F.lit(False))
    )


def cell_band_map(df: DataFrame, n=100) -> DataFrame:
    """The first n (cell, band) pairs."""
    return df.select("cell_id", "band").distinct().orderBy("cell_id", "band").limit(n)


def with_daypart(df: DataFrame, ts="event_time") -> DataFrame:
    return df.withColumns({"daypart": daypart(F.col(ts)), "daytype": daytype(F.col(ts))})


def usage_vs_profile(df: DataFrame) -> DataFrame:
    """Share of capacity in use against the range expected for the area at that time."""
    share = F.try_divide(F.col("ues_usage"), F.col("max_capacity").cast("double"))
    return (
        with_daypart(df)
        .withColumn("usage_share", share)
        .withColumn("_range", usage_range(F.col("area_type"), F.col("daytype"), F.col("daypart")))
        .withColumn("low", F.col("_range.low"))
        .withColumn("high", F.col("_range.high"))
        .withColumn("outside", ~F.col("usage_share").between(F.col("low"), F.col("high")))
        .drop("_range")
    )
