"""Prior-N history of each reading, safe for keys of any size.

A window over (cell, band) would put a hot key's whole life into one task, so the key's time
line is cut into slices of one day:

1. Readings that share a key and second are first reduced to the n that can matter. The ranking
   filter also runs before the shuffle, so a second with any number of copies ships at most n rows
   per input partition.
2. Inside a slice a window looks back n readings. At second resolution a slice has at most 86,400
   instants of n readings: a bound that does not grow with the data.
3. Each slice's last n readings are carried to the slices after it: one small row per slice and
   key, so the window over a key is as long as its number of days.
4. The history, one row per key and second, is joined to the full rows. A hot second is on the
   row side of a left join, which adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_SECONDS = 86_400


def last_n(array: Column, n: int) -> Column:
    return F.slice(array, F.greatest(F.size(array) - (n - 1), F.lit(1)), n)


def _slice_of(ts: Column, seconds: int) -> Column:
    return F.floor(F.unix_timestamp(ts.cast("timestamp")) / seconds)


def recent_points(df: DataFrame, n, keys, ts, values, slice_seconds=SLICE_SECONDS) -> DataFrame:
    """Keys, time, values and `_slice`: at most the n greatest readings of a key and time."""
    points = (
        df.select(*keys, F.col(ts), *values)
        .dropna(subset=[*keys, ts])
        .withColumn("_slice", _slice_of(F.col(ts), slice_seconds))
    )
    ties = Window.partitionBy(*keys, "_slice", ts).orderBy(
        *[F.col(v).desc_nulls_last() for v in values]
    )
    return points.withColumn("_rank", F.row_number().over(ties)).where(
        F.col("_rank") <= n
    ).drop("_rank")


def history_table(
    df: DataFrame, n=3, keys=("cell_id", "band"), ts="event_time",
    values=("ues_usage", "throughput_mbps"), name="prior", slice_seconds=SLICE_SECONDS,
) -> DataFrame:
    """(keys, ts, `name`): the up to n readings strictly before each time of each key."""
    keys = list(keys)
    reading = F.struct(F.col(ts), *[F.col(v) for v in values])
    # The readings are built before the windows, so both uses below share one shuffle.
    points = recent_points(df, n, keys, ts, values, slice_seconds).withColumn("_reading", reading)
    in_slice = Window.partitionBy(*keys, "_slice").orderBy(
        ts, *[F.col(v).asc_nulls_first() for v in values]
    )
    told = points.select(
        *keys, "_slice", ts, "_reading",
        F.array(*[F.lag("_reading", k).over(in_slice) for k in range(n, 0, -1)]).alias("_lags"),
        F.lag(ts).over(in_slice).alias("_before"),
        F.lead(ts).over(in_slice).isNull().alias("_closes"),
    )
    # The first reading of an instant sees strictly older ones only; the others share its history.
    opening = told.where(F.col("_before").isNull() | (F.col("_before") < F.col(ts))).select(
        *keys, "_slice", ts, F.array_compact("_lags").alias("_within")
    )
    tails = told.where("_closes").select(
        *keys, "_slice",
        last_n(F.concat(F.array_compact("_lags"), F.array("_reading")), n).alias("_tail"),
    )
    by_slice = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(-n, -1)
    carried = tails.select(
        *keys, "_slice", F.flatten(F.collect_list("_tail").over(by_slice)).alias("_carried")
    )
    return opening.join(carried, [*keys, "_slice"], "left").select(
        *keys, ts, last_n(F.concat("_carried", "_within"), n).alias(name)
    )


def prior_n(
    df: DataFrame, n=3, keys=("cell_id", "band"), ts="event_time",
    values=("ues_usage", "throughput_mbps"), name="prior", slice_seconds=SLICE_SECONDS,
) -> DataFrame:
    """Each row with `name`: the up to n newest readings of its key that are strictly older.

    Newest last; every row counts, with missing values too.
    """
    table = history_table(df, n, keys, ts, values, name, slice_seconds)
    joined = join_history(df, table, keys, ts)
    empty = F.array().cast(table.schema[name].dataType)
    return joined.withColumn(name, F.coalesce(name, empty))


def join_history(df: DataFrame, table: DataFrame, keys, ts) -> DataFrame:
    """Rows with what is known about their key and time. Summarize the table before, not after."""
    added = [c for c in table.columns if c not in (*keys, ts)]
    kept = [c for c in df.columns if c not in added]
    return df.select(*kept).join(table, [*keys, ts], "left").select(*kept, *added)


def prior_mean(prior: Column, field: str) -> Column:
    """Mean of one field over the history; missing values are left out."""
    known = F.filter(F.transform(prior, lambda r: r[field]), lambda v: v.isNotNull())
    total = F.aggregate(known, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(known) > 0, total / F.size(known))


def with_prior_means(df: DataFrame, prior="prior") -> DataFrame:
    return df.withColumns({
        "prior_count": F.size(prior),
        "avg_prior_throughput": prior_mean(F.col(prior), "throughput_mbps"),
        "avg_prior_ues": prior_mean(F.col(prior), "ues_usage"),
    })
