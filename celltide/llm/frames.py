"""Small helpers shared by the operators: columns, intermediate tables, bounded look-up arrays."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from celltide.session import materialize, scratch_path

__all__ = ["as_text", "bucketed", "filter_bits", "load", "materialize", "packed", "passing", "scratch_path", "shuffles"]


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def as_text(df: DataFrame, name: str) -> Column:
    """The column as text with null as empty; bytes are read as UTF-8."""
    c = F.col(name)
    if isinstance(df.schema[name].dataType, T.BinaryType):
        c = F.decode(c, "UTF-8")
    return F.coalesce(c.cast("string"), F.lit(""))


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row in one column `row`, beside new columns, so that no names can clash."""
    return df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        *[c.alias(k) for k, c in columns.items()],
    )


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, column: str, name="stage") -> DataFrame:
    """As `materialize`, in buckets by a column: a join on that column alone moves only the other side."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.write.bucketBy(shuffles(spark), column).option("compression", "zstd")
    writer.option("path", scratch_path(spark, name)).saveAsTable(table)
    rows = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the name only: files in a path of their own stay
    return rows


def filter_bits(keys: DataFrame, column: str, bits: int) -> np.ndarray:
    """One bit for each value of `bits` hash bits that some key has: a filter of 2**bits / 8 bytes.

    Its size is fixed, whatever the number of keys; it lets through all keys and some others.
    `column` is a long that is already well mixed. Spark gathers the bits by words of 60, so at most
    2**bits / 60 rows reach the driver.
    """
    slot = f"shiftrightunsigned({column}, {64 - bits})"
    words = keys.select(
        F.expr(f"{slot} div 60").alias("w"),
        F.expr(f"shiftleft(1L, cast({slot} % 60 AS INT))").alias("b"),
    ).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros((1 << bits) // 60 + 1, np.int64)
    got = words.toPandas()
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out


def _in_filter(column, name, bits, keep):
    def fn(batches):
        words = keep.value
        for batch in batches:
            h = batch.column(batch.schema.get_field_index(column)).to_numpy().view(np.uint64)
            slot = (h >> np.uint64(64 - bits)).astype(np.int64)
            hit = pa.array((words[slot // 60] >> (slot % 60)) & 1 > 0)
            yield batch.append_column(name, hit) if name else batch.filter(hit)

    return fn


def passing(df: DataFrame, column: str, words, bits: int, name: str | None = None) -> DataFrame:
    """Rows whose hash in `column` passes the broadcast filter; with `name`, all rows and the answer."""
    schema = T.StructType(df.schema.fields + ([T.StructField(name, T.BooleanType())] if name else []))
    return df.mapInArrow(_in_filter(column, name, bits, words), schema)
