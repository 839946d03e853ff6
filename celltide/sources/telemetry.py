"""Telemetry lines and archives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.functions.numbers import is_bad_number, to_number
from celltide.functions.text import decode_utf8, int_list, lines_of, strip
from celltide.functions.times import parse_time
from celltide.schemas import DU_COLUMNS, KPI_COLUMNS, KPI_SOURCE_NAMES, string_schema

LINE_OPTIONS = {
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "true",
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_corrupt_record",
}


def read_kpi_stream(
    spark: SparkSession, options: dict, topic: str, max_records: int | None = None
) -> DataFrame:
    """Bounded reads of a Kafka topic; the query's checkpoint holds the position (all partitions).

    `options` carries the brokers and credentials; nothing is built in.
    """
    reader = (
        spark.readStream.format("kafka")
        .options(**options)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_records is not None:
        reader = reader.option("maxOffsetsPerTrigger", str(max_records))
    return reader.load()


def split_payload(df: DataFrame, value="value") -> DataFrame:
    """One row per non-blank line of each message; the other columns stay.

    Lines are stripped before the explode: a filter on a computed line would be pushed below and
    compute it twice. The outer explode keeps the planner from filtering on the array likewise.
    """
    rest = [c for c in df.columns if c != value]
    lines = lines_of(decode_utf8(F.col(value)))
    return df.select(*rest, F.explode_outer(lines).alias("line")).where("line <> ''")


def _parse(df: DataFrame, columns) -> tuple[DataFrame, DataFrame]:
    schema = string_schema(columns) + ", `_corrupt_record` STRING"
    rest = [c for c in df.columns if c != "line"]
    # The one-element explode is a barrier: the filter below would parse every line a second time.
    fields = F.array(F.from_csv("line", schema, LINE_OPTIONS))
    parsed = df.select(*rest, "line", F.explode_outer(fields).alias("f"))
    good = parsed.where(F.col("f._corrupt_record").isNull()).select(
        *rest, *[F.col(f"f.`{c}`").alias(c) for c in columns]
    )
    bad = parsed.where(F.col("f._corrupt_record").isNotNull()).select(
        *rest, "line", field_count(F.col("line")).alias("field_count")
    )
    return good, bad


def parse_kpi_lines(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split `line` into the 16 telemetry fields, as text; lines of any other arity go to `bad`."""
    return _parse(df, KPI_COLUMNS)


def parse_du_lines(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split `line` into the 8 host-resource fields, as text; other arities go to `bad`."""
    return _parse(df, DU_COLUMNS)


def field_count(line: Column) -> Column:
    """Number of CSV fields: separators outside quotes, plus one."""
    bare = F.regexp_replace(line, '"(?:[^"]|"")*"', "")
    return F.length(F.regexp_replace(bare, "[^,]", "")) + 1


def type_kpi(df: DataFrame) -> DataFrame:
    """Text fields to their types. Bad values become NULL here; what to do with them is up to

    the caller: the scoring path skips the rules concerned, the training path cleans (clean_kpi),
    which also rounds the capacity. `bad_ues` and `bad_throughput` mark text that was no number.
    """
    number = {c: to_number(F.col(c)) for c in KPI_COLUMNS}
    typed = {
        **number,
        "cell_id": number["cell_id"].cast("bigint"),
        "event_time": parse_time(F.col("event_time")),
        "adjacent_cells": int_list(F.col("adjacent_cells")),
        "bad_ues": is_bad_number(F.col("ues_usage")),
        "bad_throughput": is_bad_number(F.col("throughput_mbps")),
    }
    for c in ("band", "frequency", "area_type", "city"):
        typed[c] = F.col(c)
    return df.withColumns(typed)


def type_du(df: DataFrame) -> DataFrame:
    number = {c: to_number(F.col(c)) for c in DU_COLUMNS}
    return df.withColumns({
        **number,
        "cell_id": number["cell_id"].cast("bigint"),
        "event_time": parse_time(F.col("event_time")),
        "memory_mb": number["memory_mb"].cast("bigint"),
    })


def read_archive(
    spark: SparkSession, path: str, name="ran-combined-metrics", glob="*.csv",
    columns=tuple(KPI_COLUMNS),
) -> DataFrame:
    """Every archived CSV below `path` with `name` somewhere in its path, as text columns.

    Adds the file and its age, drops header rows repeated inside a file, and fills columns that an
    older format lacks. Files of other names are pruned by their path, not read.
    """
    df = (
        spark.read.schema(string_schema(columns))
        .option("header", True)
        .option("enforceSchema", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .csv(path)
    )
    df = df.where(
        F.col("cell_id").isNull() | (strip(F.col("cell_id")) != KPI_SOURCE_NAMES[0])
    )
    if name:
        df = df.where(F.contains(F.col("_metadata.file_path"), F.lit(name)))
    missing = [c for c in KPI_COLUMNS if c not in columns]
    return df.select(
        *[F.lit(None).cast("string").alias(c) if c in missing else F.col(c) for c in KPI_COLUMNS],
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_time"),
    )


def newest_first(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("file_time"), F.desc("file_path"))


def latest_batch(df: DataFrame, by="file_time") -> DataFrame:
    """Rows of the newest batch only; the newest mark is a scalar subquery of one value."""
    newest = df.select(F.max(by).alias("newest")).scalar()
    return df.where(F.col(by) == newest)


def normalize_names(df: DataFrame) -> DataFrame:
    """Column names without blanks, signs or capitals: 'Disk Space (GB)' -> 'diskspacegb'."""
    return df.toDF(*["".join(ch for ch in c if ch.isascii() and ch.isalnum()).lower()
                     for c in df.columns])


def strip_names(df: DataFrame) -> DataFrame:
    """Column names without blanks and quotes around them."""
    return df.toDF(*[c.strip().strip('"').strip() for c in df.columns])
