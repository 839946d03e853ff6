"""Cell topology files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.functions.numbers import drop_nan
from celltide.functions.text import int_list, text_list
from celltide.schemas import CELL_SCHEMA


def read_topology(spark: SparkSession, path: str, fmt="json") -> DataFrame:
    """One row per cell from {"cells": [...]}, a bare JSON array, JSON lines ('ndjson') or CSV."""
    if fmt == "csv":
        text = (
            "cell_id BIGINT, max_capacity BIGINT, lat DOUBLE, lon DOUBLE, bands STRING, "
            "area_type STRING, city STRING, adjacent_cells STRING"
        )
        return (
            spark.read.schema(text).option("header", True).option("escape", '"').csv(path)
            .withColumn("bands", text_list(F.col("bands")))
            .withColumn("adjacent_cells", int_list(F.col("adjacent_cells")))
        )
    cell = f"STRUCT<{_colon(CELL_SCHEMA)}>"
    df = (
        spark.read.schema(f"cells ARRAY<{cell}>, {CELL_SCHEMA}")
        .option("multiLine", fmt != "ndjson")
        .json(path)
    )
    flat = [c for c in df.columns if c != "cells"]
    return explode_cells(df.select(
        F.coalesce("cells", F.array(F.struct(*flat))).alias("cells")
    ))


def _colon(ddl: str) -> str:
    fields = [f.strip() for f in ddl.strip().split(",")]
    return ", ".join(f.replace(" ", ": ", 1) for f in fields)


def explode_cells(df: DataFrame, column="cells") -> DataFrame:
    """One row per element of the cell array."""
    return df.select(F.explode(column).alias("cell")).select("cell.*")


def normalize_towers(df: DataFrame) -> DataFrame:
    """Map view of the cells: one id and name, an up/down status, finite places only."""
    def has(name, kind):
        return F.col(name) if name in df.columns else F.lit(None).cast(kind)

    number = F.coalesce(has("cell_id", "bigint"), has("id", "bigint"))
    down = (has("status", "string") == "down") | (F.col("max_capacity") == 0)
    towers = df.select(
        number.alias("id"),
        F.coalesce(
            has("name", "string"), F.concat(F.lit("Cell "), number.cast("string"))
        ).alias("name"),
        drop_nan(F.col("lat")).alias("lat"),
        drop_nan(F.coalesce(has("lon", "double"), has("lng", "double"))).alias("lng"),
        F.when(down, "down").otherwise("up").alias("status"),
        F.coalesce("bands", F.array().cast("array<string>")).alias("bands"),
        "city",
        "area_type",
        "max_capacity",
        F.coalesce(has("adjacent_cells", "array<bigint>"), F.array().cast("array<bigint>")).alias(
            "adjacent_cells"
        ),
    )
    limit = float("inf")
    return towers.where((F.abs("lat") < limit) & (F.abs("lng") < limit))
