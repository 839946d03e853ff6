"""Fixed lookup tables of the data model, as literals in the plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Carrier frequency of each band.
BAND_FREQUENCY = {
    "Band 29": "700",
    "Band 26": "850",
    "Band 71": "600",
    "Band 66": "1700-2100",
}

# Bands that are scored.
VALID_BANDS = ["Band 29", "Band 26", "Band 71", "Band 66"]

# Expected share of capacity in use, (low, high), by area, day type and daypart.
USAGE_PATTERNS = {
    "industrial": {"weekdays": {"day": (0.7, 0.9), "night": (0.1, 0.3)},
                   "weekends": {"day": (0.4, 0.6), "night": (0.1, 0.3)}},
    "commercial": {"weekdays": {"day": (0.3, 0.5), "night": (0.6, 0.9)},
                   "weekends": {"day": (0.4, 0.6), "night": (0.7, 0.9)}},
    "rural": {"weekdays": {"day": (0.1, 0.2), "night": (0.1, 0.2)},
              "weekends": {"day": (0.1, 0.2), "night": (0.1, 0.2)}},
    "residential": {"weekdays": {"day": (0.3, 0.2), "night": (0.7, 0.9)},
                    "weekends": {"day": (0.4, 0.6), "night": (0.5, 0.8)}},
}

# Feed event types with title and badge.
EVENT_LABELS = {
    "call-placed": ("Call Placed", "secondary"),
    "call-dropped": ("Call Dropped", "destructive"),
    "tower-up": ("Tower Online", "default"),
    "tower-down": ("Tower Offline", "destructive"),
    "alert-triggered": ("Alert Triggered", "destructive"),
    "alert-resolved": ("Alert Resolved", "default"),
    "remediation-started": ("Remediation Started", "secondary"),
    "remediation-completed": ("Remediation Completed", "default"),
    "anomaly-detected": ("Anomaly Detected", "destructive"),
}


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in pairs.items() for x in pair])


def band_frequency(band: Column) -> Column:
    return F.coalesce(F.try_element_at(literal_map(BAND_FREQUENCY), band), F.lit("Unknown"))


def event_title(kind: Column) -> Column:
    titles = literal_map({k: v[0] for k, v in EVENT_LABELS.items()})
    return F.coalesce(F.try_element_at(titles, kind), F.lit("Unknown Event"))


def event_badge(kind: Column) -> Column:
    badges = literal_map({k: v[1] for k, v in EVENT_LABELS.items()})
    return F.coalesce(F.try_element_at(badges, kind), F.lit("outline"))


def usage_range(area: Column, daytype: Column, daypart: Column) -> Column:
    """Struct (low, high) from USAGE_PATTERNS; one pair is stored high-first, so both are ordered.

    Sixteen entries live in the plan as a literal map: no join, no broadcast.
    """
    entries = []
    for name, by_type in USAGE_PATTERNS.items():
        for kind, by_part in by_type.items():
            for part, ends in by_part.items():
                entries.append(F.lit(f"{name}|{kind}|{part}"))
                entries.append(
                    F.struct(F.lit(min(ends)).alias("low"), F.lit(max(ends)).alias("high"))
                )
    key = F.concat_ws("|", F.lower(area), daytype, daypart)
    return F.try_element_at(F.create_map(*entries), key)
