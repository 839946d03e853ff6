"""Time, traffic and neighbour features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.lookups import BAND_FREQUENCY
from celltide.functions.times import DAY_NAMES, day_name, is_weekend

FREQUENCIES = [*BAND_FREQUENCY.values(), "Unknown"]
GROUP_KEYS = ["cell_id", "event_time", "frequency"]


def time_columns(ts: Column) -> dict[str, Column]:
    return {
        "hour": F.hour(ts),
        "day": F.day(ts),
        "month": F.month(ts),
        "weekday": F.weekday(ts),
        "weekend": is_weekend(ts),
        "day_name": day_name(ts),
        "date": F.date_format(ts, "MM-dd-yyyy"),
        "event_ts": F.unix_timestamp(ts),
    }


def temporal_features(df: DataFrame, ts="event_time") -> DataFrame:
    """Hour, day, month, weekday (Monday = 0), weekend, day name, date text, epoch seconds."""
    return df.withColumns(time_columns(F.col(ts)))


def one_hot(df: DataFrame, source: str, values, prefix: str) -> DataFrame:
    """A fixed set of 0/1 columns, so that training and serving see the same ones."""
    return df.withColumns({
        f"{prefix}_{v}".lower().replace("-", "_"): F.coalesce(
            (F.col(source) == v).cast("int"), F.lit(0)
        )
        for v in values
    })


def onehot_dow(df: DataFrame) -> DataFrame:
    return one_hot(df, "day_name", DAY_NAMES, "dow")


def onehot_freq(df: DataFrame) -> DataFrame:
    return one_hot(df, "frequency", FREQUENCIES, "freq")


def topn_adjacent(df: DataFrame, n=10) -> DataFrame:
    """The n cells named most often as neighbours; equal counts go by id.

    Counts are combined before the shuffle, and the top n is kept per partition.
    """
    named = df.select(F.explode("adjacent_cells").alias("adjacent_cell"))
    return (
        named.groupBy("adjacent_cell").agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "adjacent_cell").limit(n)
    )


def with_adjacency_flags(df: DataFrame, n=10) -> DataFrame:
    """0/1 columns `adj_top_i`: does the row name the i-th most frequent neighbour?

    The n ids are one small array, read once as a scalar subquery.
    """
    ids = topn_adjacent(df, n).agg(F.transform(
        F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), "adjacent_cell"))),
        lambda s: s["adjacent_cell"],
    ).alias("ids")).scalar()
    return df.withColumn("_ids", ids).withColumns({
        f"adj_top_{i + 1}": F.coalesce(
            F.array_contains("adjacent_cells", F.get("_ids", F.lit(i))).cast("int"), F.lit(0)
        )
        for i in range(n)
    }).drop("_ids")


def traffic_grouped(df: DataFrame, top_n=None) -> DataFrame:
    """Users per (cell, time, frequency), with the neighbour flags from the same shuffle.

    Rows without a full key are left out. Day name and weekend depend on time alone, so any
    aggregate of them is exact; they are recomputed after grouping instead.
    """
    rows = with_adjacency_flags(df, top_n) if top_n else df
    flags = [f"adj_top_{i + 1}" for i in range(top_n or 0)]
    grouped = rows.dropna(subset=GROUP_KEYS).groupBy(*GROUP_KEYS).agg(
        F.sum("ues_usage").alias("ues_usage"), *[F.max(f).alias(f) for f in flags]
    )
    return temporal_features(grouped)


def traffic_class(df: DataFrame, cut=40) -> DataFrame:
    return df.withColumn("traffic_class", (F.col("ues_usage") >= cut).cast("int"))


def traffic_hourly(df: DataFrame) -> DataFrame:
    """Users per cell, frequency, hour and date."""
    ts = F.col("event_time")
    return (
        df.dropna(subset=GROUP_KEYS)
        .groupBy("cell_id", "frequency", F.hour(ts).alias("hour"), F.to_date(ts).alias("date"))
        .agg(F.sum("ues_usage").alias("ues_usage"))
        .withColumns({
            "day_name": day_name(F.col("date")),
            "weekend": is_weekend(F.col("date")),
        })
    )


def traffic_features(df: DataFrame, top_n=10, cut=40, leaky=False, wide=False) -> DataFrame:
    """The training table: grouped users, label, time features and one-hots.

    `wide` adds frequency one-hots and the neighbour flags to the features; `leaky` leaves the
    regression target among them.
    """
    table = traffic_class(traffic_grouped(df, top_n if wide else None), cut)
    table = onehot_dow(table)
    return onehot_freq(table) if wide else table


def feature_columns(top_n=10, leaky=False, wide=False) -> list[str]:
    names = ["cell_id", "event_ts", "hour", "weekend", "day", "month", "weekday"]
    if leaky:
        names.append("ues_usage")
    names += [f"dow_{d}".lower() for d in DAY_NAMES]
    if wide:
        names += [f"freq_{f}".lower().replace("-", "_") for f in FREQUENCIES]
        names += [f"adj_top_{i + 1}" for i in range(top_n)]
    return names


def split(df: DataFrame, test=0.2, keys=tuple(GROUP_KEYS), seed=42) -> tuple[DataFrame, DataFrame]:
    """Train and test parts by a hash of the keys: the same rows whatever the partitioning."""
    return parts(with_part(df, test, keys, seed))


def parts(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The train and test rows of a table of `with_part`."""
    return (
        marked.where("part = 'train'").drop("part"),
        marked.where("part = 'test'").drop("part"),
    )


def with_part(df: DataFrame, test=0.2, keys=tuple(GROUP_KEYS), seed=42) -> DataFrame:
    """`part`: 'test' or 'train', by the first 32 bits of md5 of seed and keys, which any engine has."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10_000
    return df.withColumn("part", F.when(bucket < int(test * 10_000), "test").otherwise("train"))
