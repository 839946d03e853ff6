"""File sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.times import TIME_FORMAT
from celltide.schemas import KPI_COLUMNS, KPI_SOURCE_NAMES

ANOMALY_CSV_COLUMNS = [
    "cell_id", "band", "anomaly_type", "anomaly", "recommended_fix", "source_id",
    "creation_date",
]  # fixed values: field order of the parsed-anomaly CSV


def text_columns(df: DataFrame, columns=KPI_COLUMNS) -> list[Column]:
    """Every telemetry field as the text a line carries; lists are joined by commas."""
    kinds = dict(df.dtypes)
    out = []
    for c in columns:
        if kinds[c].startswith("array"):
            col = F.array_join(F.col(c).cast("array<string>"), ",")
        elif kinds[c].startswith("timestamp"):
            col = F.date_format(c, TIME_FORMAT)
        else:
            col = F.col(c).cast("string")
        out.append(col.alias(c))
    return out


def write_archive(df: DataFrame, path: str, partition_by=None, mode="append") -> None:
    """Telemetry as CSV with a header and every field quoted; inner quotes are doubled once."""
    keep = [partition_by] if partition_by else []
    named = df.select(
        *[c.alias(n) for c, n in zip(text_columns(df), KPI_SOURCE_NAMES)], *keep
    )
    writer = named.write.mode(mode).option("header", True).option("quoteAll", True)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.option("escape", '"').csv(path)


def write_results(df: DataFrame, path: str, mode="overwrite") -> None:
    """Scored rows as CSV."""
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_anomalies(df: DataFrame, path: str, fmt="json", mode="overwrite") -> None:
    """Parsed anomalies as JSON lines, or as the seven-column CSV with blanks for missing."""
    if fmt == "json":
        df.write.mode(mode).json(path)
        return
    blank = [
        (F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c)
        for c in ANOMALY_CSV_COLUMNS
    ]
    writer = df.select(*blank).write.mode(mode).option("header", True).option("escape", '"')
    writer.option("emptyValue", "").csv(path)


def write_topology(df: DataFrame, path: str, fmt="json", mode="overwrite") -> None:
    """Cells as JSON lines, or as CSV with lists joined by commas."""
    if fmt == "json":
        df.write.mode(mode).json(path)
        return
    joined = df.withColumns({
        c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("bands", "adjacent_cells")
    })
    joined.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_report(blocks: DataFrame, path: str, text="report_text", mode="overwrite") -> None:
    """Report blocks in order, a blank line between them; files are written in parallel."""
    blocks.select(text).write.mode(mode).option("lineSep", "\n\n").text(path)
