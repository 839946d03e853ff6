"""Calendar columns and durations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_NAMES = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_time(c: Column) -> Column:
    """Text to timestamp at second resolution; bad text becomes NULL."""
    return F.date_trunc("second", c.try_cast("timestamp"))


def day_name(c: Column) -> Column:
    return F.date_format(c, "EEEE")


def is_weekend(c: Column) -> Column:
    return F.weekday(c) >= 5


def daypart(c: Column) -> Column:
    """'day' from 06:00 to before 18:00, else 'night'."""
    return F.when(F.hour(c).between(6, 17), "day").otherwise("night")


def daytype(c: Column) -> Column:
    return F.when(is_weekend(c), "weekends").otherwise("weekdays")


def as_utc(c: Column) -> Column:
    """Text with or without a trailing Z, read as UTC."""
    text = F.regexp_replace(c.cast("string"), "[Zz]$", "")
    return F.concat(text, F.lit("Z")).try_cast("timestamp")


def duration_text(seconds: Column) -> Column:
    """0 -> 'N/A', 45 -> '45 seconds', 90 -> '1m 30s', 3600 -> '1 hour', 5400 -> '1h 30m'."""
    s = seconds.cast("double")
    whole_minutes = F.floor(s / 60).cast("string")
    rest_seconds = F.floor(s % 60 + 0.5)
    hours = F.floor(s / 3600).cast("string")
    rest_minutes = F.floor((s / 60) % 60 + 0.5)
    minutes = (
        F.when((rest_seconds == 0) & (whole_minutes == "1"), "1 minute")
        .when(rest_seconds == 0, F.concat(whole_minutes, F.lit(" minutes")))
        .otherwise(F.concat(whole_minutes, F.lit("m "), rest_seconds.cast("string"), F.lit("s")))
    )
    long = (
        F.when((rest_minutes == 0) & (hours == "1"), "1 hour")
        .when(rest_minutes == 0, F.concat(hours, F.lit(" hours")))
        .otherwise(F.concat(hours, F.lit("h "), rest_minutes.cast("string"), F.lit("m")))
    )
    return (
        F.when(s == 0, "N/A")
        .when(s < 60, F.concat(F.floor(s + 0.5).cast("string"), F.lit(" seconds")))
        .when(s < 3600, minutes)
        .otherwise(long)
    )
