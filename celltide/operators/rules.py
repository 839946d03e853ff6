"""Threshold rules over a reading and its three prior readings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from celltide.functions.numbers import drop_nan, fixed2, shown
from celltide.operators.history import (
    history_table,
    join_history,
    with_prior_means,
)


@dataclass(frozen=True)
class Thresholds:
    """The limits of the rules."""

    prb_percent: float = 95.0
    rsrp_dbm: float = -110.0
    sinr_db: float = 0.0
    throughput_drop: float = 0.5
    ues_change: float = 0.5
    history: int = 3
    outage_sinr: float = -10.0
    outage_rsrp: float = -120.0
    outage_rsrq: float = -20.0


# Rule names, in rule order.
PRB = "High PRB Utilization"
PRB_ERROR = "PRB Utilization Error"
RSRP = "Low RSRP"
SINR = "Low SINR"
THROUGHPUT = "Throughput Drop"
UES = "UEs Spike/Drop"
OUTAGE = "Cell Outage"
RULES = [PRB, PRB_ERROR, RSRP, SINR, THROUGHPUT, UES, OUTAGE]

FLAGS = {
    PRB: "is_prb", PRB_ERROR: "is_prb_error", RSRP: "is_rsrp", SINR: "is_sinr",
    THROUGHPUT: "is_throughput", UES: "is_ues", OUTAGE: "is_outage",
}

HISTORY_KEYS = ("cell_id", "band")
KPIS = ("ues_usage", "rsrp", "sinr", "throughput_mbps", "rsrq")


def with_history(df: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Rows with the count and means of their prior readings.

    The readings are summarized once per key and time, before they meet the rows.
    Optional boolean columns `bad_ues` and `bad_throughput` mark readings whose text was no number;
    a history with one of them has no mean.
    """
    marks = [c for c in ("bad_ues", "bad_throughput") if c in df.columns]
    values = ("ues_usage", "throughput_mbps", *marks)

    def summary(told):
        return with_prior_means(told).withColumns(
            {f"prior_{m}": _any_bad(m) for m in marks}
        ).drop("prior")

    table = summary(history_table(df, t.history, values=values))
    out = join_history(df, table, HISTORY_KEYS, "event_time")
    return out.withColumns({
        "prior_count": F.coalesce("prior_count", F.lit(0)),
        **{
            f"prior_{m}": F.coalesce(f"prior_{m}", F.lit(False)) if m in marks else F.lit(False)
            for m in ("bad_ues", "bad_throughput")
        },
    })


def _any_bad(mark: str) -> Column:
    return F.exists("prior", lambda reading: F.coalesce(reading[mark], F.lit(False)))


def without_history(df: DataFrame) -> DataFrame:
    """Rows as if nothing came before them: for the rules that look at one reading only."""
    return df.withColumns({
        "prior_count": F.lit(0),
        "avg_prior_throughput": F.lit(None).cast("double"),
        "avg_prior_ues": F.lit(None).cast("double"),
        "prior_bad_ues": F.lit(False),
        "prior_bad_throughput": F.lit(False),
    })


def flag(df: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Add `prb_percent` and one boolean per rule. Missing values never violate a rule.

    A missing capacity is no anomaly; a capacity of zero or less with users is a PRB error.
    """
    ues, capacity = F.col("ues_usage"), F.col("max_capacity").cast("double")
    prb = F.try_divide(ues, F.when(capacity > 0, capacity)) * 100
    enough = F.col("prior_count") >= t.history
    tput_mean = F.when(~F.col("prior_bad_throughput"), F.col("avg_prior_throughput"))
    ues_mean = F.when(~F.col("prior_bad_ues"), F.col("avg_prior_ues"))
    tests = {
        PRB: prb > t.prb_percent,
        PRB_ERROR: (capacity <= 0) & (ues > 0),
        RSRP: F.col("rsrp") < t.rsrp_dbm,
        SINR: F.col("sinr") < t.sinr_db,
        THROUGHPUT: enough & (tput_mean > 0)
        & (F.col("throughput_mbps") < F.lit(t.throughput_drop) * tput_mean),
        UES: enough & (ues_mean > 0)
        & (F.try_divide(F.abs(ues - ues_mean), ues_mean) > t.ues_change),
        OUTAGE: (ues == 0) & (F.col("throughput_mbps") == 0)
        & (F.col("sinr") <= t.outage_sinr) & (F.col("rsrp") <= t.outage_rsrp)
        & (F.col("rsrq") <= t.outage_rsrq),
    }
    known = {
        c: drop_nan(F.col(c).cast("double"))
        for c in (*KPIS, "avg_prior_throughput", "avg_prior_ues")
    }
    out = df.withColumns(known).withColumn("prb_percent", prb)
    return out.withColumns({FLAGS[r]: F.coalesce(tests[r], F.lit(False)) for r in RULES})


def rule_text(rule: str, t: Thresholds = Thresholds()) -> Column:
    """The sentence of one rule. The wording of these texts."""
    parts = {
        PRB: [f"{PRB}: ", fixed2("prb_percent"), f"% > {t.prb_percent}%"],
        PRB_ERROR: [f"{PRB_ERROR}: UEs Usage (", shown("ues_usage"), ") with Zero Max Capacity (0)."],
        RSRP: [f"{RSRP}: ", shown("rsrp"), f" dBm < {t.rsrp_dbm:g} dBm"],
        SINR: [f"{SINR}: ", shown("sinr"), f" dB < {t.sinr_db:g} dB"],
        THROUGHPUT: [
            f"{THROUGHPUT}: ", fixed2("throughput_mbps"), " Mbps (Current) vs. ",
            fixed2("avg_prior_throughput"),
            f" Mbps (Avg Prior {t.history}) - drop > {t.throughput_drop * 100:g}%",
        ],
        UES: [
            f"{UES}: ", shown("ues_usage"), " UEs (Current) vs. ", fixed2("avg_prior_ues"),
            f" UEs (Avg Prior {t.history}) - change > {t.ues_change * 100:g}%",
        ],
        OUTAGE: [
            f"{OUTAGE}: UEs=0, Tput=0, SINR<={t.outage_sinr:g} (", shown("sinr"),
            f"), RSRP<={t.outage_rsrp:g} (", shown("rsrp"),
            f"), RSRQ<={t.outage_rsrq:g} (", shown("rsrq"), ")",
        ],
    }[rule]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def violation(rule: str, t: Thresholds = Thresholds()) -> Column:
    value = {
        PRB: F.col("prb_percent"), PRB_ERROR: F.col("ues_usage"), RSRP: F.col("rsrp"),
        SINR: F.col("sinr"), THROUGHPUT: F.col("throughput_mbps"), UES: F.col("ues_usage"),
        OUTAGE: F.col("sinr"),
    }[rule]
    limit = {
        PRB: F.lit(t.prb_percent), PRB_ERROR: F.lit(0.0), RSRP: F.lit(t.rsrp_dbm),
        SINR: F.lit(t.sinr_db), THROUGHPUT: F.col("avg_prior_throughput") * t.throughput_drop,
        UES: F.col("avg_prior_ues") * t.ues_change, OUTAGE: F.lit(t.outage_sinr),
    }[rule]
    return F.when(
        F.col(FLAGS[rule]),
        F.struct(
            F.lit(RULES.index(rule) + 1).alias("rule_no"),
            F.lit(rule).alias("anomaly_type"),
            value.alias("value"),
            limit.alias("threshold"),
            rule_text(rule, t).alias("text"),
        ),
    )


def apply_rules(df: DataFrame, t: Thresholds = Thresholds()) -> DataFrame:
    """Flags, `is_anomaly`, and `anomalies`: the violated rules in rule order as structs."""
    hit = F.lit(False)
    for r in RULES:
        hit = hit | F.col(FLAGS[r])
    return flag(df, t).withColumn("is_anomaly", hit).withColumn(
        "anomalies", F.array_compact(F.array(*[violation(r, t) for r in RULES]))
    )


def detect(df: DataFrame, thresholds: Thresholds = Thresholds()) -> DataFrame:
    """History, rules, flags and texts of every row."""
    return apply_rules(with_history(df, thresholds), thresholds)


def anomalies_long(detected: DataFrame, keep=("cell_id", "band", "event_time")) -> DataFrame:
    """One row per violation.

    Rows are chosen by flag; the outer explode then needs no filter on the array, which would be
    pushed down and compute every text twice.
    """
    rows = detected.where("is_anomaly").select(*keep, F.explode_outer("anomalies").alias("a"))
    return rows.select(*keep, "a.*")
