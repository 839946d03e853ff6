"""Scaling and sliding sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celltide.operators.history import prior_n

KPI_SCALED = ["rsrp", "rsrq", "sinr", "throughput_mbps", "latency_ms", "ues_usage"]


def minmax(df: DataFrame, columns=tuple(KPI_SCALED)) -> DataFrame:
    """Each column scaled to 0..1 over the whole table; a constant column becomes 0.

    The bounds are one row from one aggregate, read as a scalar subquery: no join.
    """
    low_high = df.agg(F.struct(
        *[F.min(c).alias(f"{c}_low") for c in columns],
        *[F.max(c).alias(f"{c}_high") for c in columns],
    ).alias("b")).scalar()
    out = df.withColumn("_b", low_high)
    span = {c: F.col(f"_b.{c}_high") - F.col(f"_b.{c}_low") for c in columns}
    scaled = {
        f"{c}_scaled": F.when(F.col(c).isNotNull(), F.coalesce(
            F.try_divide(F.col(c) - F.col(f"_b.{c}_low"), span[c]), F.lit(0.0)
        ))
        for c in columns
    }
    return out.withColumns(scaled).drop("_b")


def sequences(
    df: DataFrame, steps=10, keys=("cell_id", "band"), ts="event_time",
    values=("throughput_mbps", "ues_usage"), own_row=True,
) -> DataFrame:
    """Rows with `sequence`: `steps` readings of the key, oldest first.

    The last one is the row itself, or with `own_row=False` the newest strictly older one, so that
    a sequence is scored against the row that follows it. Rows with a shorter past have none and
    are left out, as a sliding frame does.
    """
    older = steps - 1 if own_row else steps
    reading = F.struct(F.col(ts), *[F.col(v) for v in values])
    past = prior_n(df, older, keys, ts, values, name="_past").where(
        F.size("_past") == older
    )
    whole = F.concat("_past", F.array(reading)) if own_row else F.col("_past")
    return past.withColumn("sequence", whole).drop("_past")


def _known(field: str):
    return F.filter(F.transform("sequence", lambda s: s[field]), lambda x: x.isNotNull())


def _errors(array: str, baseline: str):
    return F.transform(array, lambda x: F.abs(x - F.col(baseline)))


def _mean(array: str):
    total = F.aggregate(array, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(array) > 0, total / F.size(array))


def sequence_score(df: DataFrame, fields=("throughput_mbps",), cut=None) -> DataFrame:
    """`score`: mean absolute error of each sequence against its own mean, over all `fields`.

    With `cut`, also whether the score lies above it.
    """
    out, scores = df, []
    for f in fields:
        out = out.withColumn(f"_v_{f}", _known(f))
        out = out.withColumn(f"baseline_{f}", _mean(f"_v_{f}"))
        out = out.withColumn(f"_e_{f}", _errors(f"_v_{f}", f"baseline_{f}"))
        scores.append(_mean(f"_e_{f}"))
    total = scores[0]
    for s in scores[1:]:
        total = total + s
    out = out.withColumn("score", total / len(scores))
    out = out.drop(*[f"_{k}_{f}" for k in "ve" for f in fields])
    return out if cut is None else out.withColumn("is_anomaly", F.col("score") > cut)
