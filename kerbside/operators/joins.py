"""Joins of counts with weather and holidays, and the union of both cities.

No join here carries a hint: Spark broadcasts a side only when its size estimate is
below ``spark.sql.autoBroadcastJoinThreshold`` and sorts and merges otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

WEATHER_MEASURES = ["temp", "pressure", "humidity", "clouds", "wind", "rain", "snow"]


def footfall_complete(leeds: DataFrame, york: DataFrame) -> DataFrame:
    """Both cities below each other, by position, each without repeated rows.

    Rows that occur in both inputs stay twice. Both move at once, by city and hour, which
    serves the removal of copies and the join with hourly weather after it.
    """
    rows = leeds.withColumn("_of", F.lit(0)).union(york.withColumn("_of", F.lit(1)))
    return rows.repartition("city", "timestamp").distinct().drop("_of")


def with_hourly_weather(footfall: DataFrame, weather: DataFrame) -> DataFrame:
    """Counts of the hours that have weather."""
    hours = weather.select("city", F.col("date").alias("timestamp"), *WEATHER_MEASURES)
    return footfall.join(hours, ["city", "timestamp"], "inner")


def with_holidays(rows: DataFrame, holidays: DataFrame, day: str = "date") -> DataFrame:
    """Every row of a day with each holiday of that day, or with a null name."""
    named = holidays.select(F.col("date").alias(day), F.col("name").alias("holiday_name"))
    return rows.join(named, day, "left")


def with_features(footfall: DataFrame, features: DataFrame) -> DataFrame:
    """Counts left-joined to trailing features computed apart from them.

    The views carry features along instead; this is for features stored as a table.
    """
    return footfall.join(features, ["city", "footfall_location", "timestamp"], "left")
