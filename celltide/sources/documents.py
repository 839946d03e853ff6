"""Documents for retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as (source, text, whole); JSON files are marked to stay in one piece."""
    df = (
        spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("text"))
    )
    return mark_whole(df)


def mark_whole(df: DataFrame) -> DataFrame:
    """`whole` is true for JSON documents, told by the ending of their source."""
    return df.withColumn("whole", F.lower("source").endswith(".json"))
