"""Calendar parts of a date or timestamp."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def week_of_year(day: Column) -> Column:
    """Week number 0-53 with weeks starting on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("bigint")


def weekday_name(day: Column) -> Column:
    """Full English weekday name."""
    return F.date_format(day, "EEEE")


def month_name(day: Column) -> Column:
    """Three-letter English month name."""
    return F.date_format(day, "MMM")


def epoch_timestamp(seconds: Column, zone: str = "UTC") -> Column:
    """Epoch seconds as the wall-clock timestamp of ``zone``."""
    instant = F.timestamp_seconds(seconds)
    return instant if zone == "UTC" else F.from_utc_timestamp(instant, zone)


def day_suffix(day: Column) -> Column:
    """Day as ``yyyymmdd``, the suffix of per-day tables."""
    return F.date_format(day, "yyyyMMdd")
