"""Nested JSON documents of the weather and holiday services, as tables.

Each function takes a text column ``body`` with one service response per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions.calendar import epoch_timestamp
from kerbside.functions.numeric import kelvin_to_celsius
from kerbside.schemas import FORECASTS, HOLIDAYS, WEATHER_HISTORY, conform

FORECAST_TYPE = (
    "map<string, struct<list: array<struct<dt: bigint, temp: struct<min: double, max: double>, "
    "pressure: bigint, humidity: bigint, clouds: bigint, speed: double, rain: double, snow: double>>>>"
)
HISTORY_TYPE = (
    "map<string, struct<list: array<struct<dt: bigint, "
    "main: struct<temp: double, pressure: bigint, humidity: bigint>, clouds: struct<`all`: bigint>, "
    "wind: struct<speed: double>, rain: struct<`1h`: double>, snow: struct<`1h`: double>>>>>"
)
HOLIDAY_TYPE = "array<array<struct<date: string, name: string, localName: string, counties: array<string>>>>"

# The holidays kept are those of the whole country, of this region, or of this name.
HOLIDAY_REGION = "GB-ENG"
HOLIDAY_NAME = "Saint Patrick's Day"


def _per_entry(docs: DataFrame, doc_type: str) -> DataFrame:
    """One row per city and list entry."""
    cities = docs.select(F.explode(F.from_json("body", doc_type, {"mode": "FAILFAST"})).alias("city", "answer"))
    return cities.select("city", F.explode("answer.list").alias("e"))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def flatten_forecast(docs: DataFrame, zone: str = "UTC") -> DataFrame:
    """City × day forecasts in Celsius; missing rain or snow is 0."""
    rows = _per_entry(docs, FORECAST_TYPE).select(
        "city",
        F.to_date(epoch_timestamp(F.col("e.dt"), zone)).alias("date"),
        kelvin_to_celsius(F.col("e.temp.min")).alias("min_temp"),
        kelvin_to_celsius(F.col("e.temp.max")).alias("max_temp"),
        F.col("e.pressure").alias("pressure"),
        F.col("e.humidity").alias("humidity"),
        F.col("e.clouds").alias("clouds"),
        F.col("e.speed").alias("wind"),
        _or_zero(F.col("e.rain")).alias("rain"),
        _or_zero(F.col("e.snow")).alias("snow"),
    )
    return conform(rows, FORECASTS)


def flatten_history(docs: DataFrame, zone: str = "UTC") -> DataFrame:
    """City × hour history in Celsius to one place; missing rain or snow is 0."""
    rows = _per_entry(docs, HISTORY_TYPE).select(
        "city",
        epoch_timestamp(F.col("e.dt"), zone).alias("date"),
        # the service's own clients round ties to even here
        F.bround(kelvin_to_celsius(F.col("e.main.temp")), 1).alias("temp"),
        F.col("e.main.pressure").alias("pressure"),
        F.col("e.main.humidity").alias("humidity"),
        F.col("e.clouds").getField("all").alias("clouds"),
        F.col("e.wind.speed").alias("wind"),
        _or_zero(F.col("e.rain").getField("1h")).alias("rain"),
        _or_zero(F.col("e.snow").getField("1h")).alias("snow"),
    )
    return conform(rows, WEATHER_HISTORY)


def flatten_holidays(docs: DataFrame) -> DataFrame:
    """Public holidays kept in England, by local name."""
    days = docs.select(F.explode(F.from_json("body", HOLIDAY_TYPE, {"mode": "FAILFAST"})).alias("year"))
    days = days.select(F.explode("year").alias("d"))
    kept = (
        F.col("d.counties").isNull()
        | F.array_contains("d.counties", HOLIDAY_REGION)
        | (F.col("d.name") == HOLIDAY_NAME)
    )
    rows = days.filter(kept).select(F.col("d.date").alias("date"), F.col("d.localName").alias("name"))
    return conform(rows, HOLIDAYS)
