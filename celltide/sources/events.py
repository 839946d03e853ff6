"""The event store and event files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events_json(spark: SparkSession, path: str, ndjson=False) -> DataFrame:
    """Events from a JSON array, a single object, or one object per line.

    Items without a text `event` (or `Event`) are left out; the date may come as `creation_date`
    or `date`. Items are read as variants, whose keys keep their case.
    """
    documents = (
        spark.read.option("singleVariantColumn", "doc").option("multiLine", not ndjson).json(path)
    )
    several = F.try_variant_get("doc", "$", "array<variant>")
    items = documents.select(F.explode(
        F.when(F.schema_of_variant("doc").startswith("ARRAY"), several).otherwise(F.array("doc"))
    ).alias("item"))

    def part(name, kind="string"):
        return F.try_variant_get("item", f"$.{name}", kind)

    def text(name):
        is_text = F.schema_of_variant(part(name, "variant")) == "STRING"
        return F.when(is_text & (part(name) != ""), part(name))

    return items.select(
        part("id").alias("id"),
        part("cell_id", "bigint").alias("cell_id"),
        F.coalesce(text("event"), text("Event")).alias("event"),
        part("data").alias("data"),
        F.coalesce(part("creation_date"), part("date")).alias("creation_date"),
        part("active", "int").alias("active"),
    ).where(F.col("event").isNotNull())


def read_event_store(
    spark: SparkSession, options: dict, table="events", lower=0, upper=None, partitions=None
) -> DataFrame:
    """Scan of the events table over JDBC, split by id range when the range is given."""
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if upper is not None and partitions:
        reader = (
            reader.option("partitionColumn", "id")
            .option("lowerBound", str(lower))
            .option("upperBound", str(upper))
            .option("numPartitions", str(partitions))
        )
    return reader.load()


def read_event_table(spark: SparkSession, path: str) -> DataFrame:
    """The same table kept as parquet."""
    return spark.read.parquet(path)
