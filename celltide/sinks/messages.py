"""Message and table sinks."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.sinks.files import text_columns

log = logging.getLogger(__name__)

LINE_WRITE_OPTIONS = {"quoteAll": "true", "escape": '"', "quote": '"', "sep": ","}


def encode_kpi_lines(df: DataFrame, keep=()) -> DataFrame:
    """One fully quoted CSV line per row, as `value`; `keep` columns ride along."""
    return df.select(*keep, csv_line(text_columns(df)).alias("value"))


def csv_line(fields: list[Column]) -> Column:
    return F.to_csv(F.struct(*fields), LINE_WRITE_OPTIONS)


def send(df: DataFrame, options: dict, topic: str, value="value", strict=False) -> bool:
    """Publish `value` to a Kafka topic. A failure is logged and the run goes on, unless `strict`."""
    messages = df.select(F.col(value).cast("string").alias("value"))
    try:
        messages.write.format("kafka").options(**options).option("topic", topic).save()
    except Exception:
        if strict:
            raise
        log.exception("publishing to %s failed", topic)
        return False
    return True


def append_events(df: DataFrame, options: dict, table="events") -> None:
    """Append event rows over JDBC; the store numbers them."""
    df.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()
