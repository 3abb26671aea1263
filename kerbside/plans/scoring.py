"""Feature rows for the forecast days."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.functions.calendar import month_name, weekday_name
from kerbside.functions.numeric import round_half_up
from kerbside.operators.trailing import SERIES

LOOK_BACK_DAYS = 90
# Parts that the locations of a city are dealt to; the few forecast days go to each.
CITY_PARTS = 64


def _as_of(as_of: dt.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def daily_totals(footfall: DataFrame) -> DataFrame:
    """Total count by city, location and day."""
    return footfall.groupBy(*SERIES, F.to_date("timestamp").alias("date")).agg(
        F.sum("total_footfall").alias("total_footfall")
    )


def last_days(footfall: DataFrame, as_of: dt.date | str | None = None, days: int = LOOK_BACK_DAYS) -> DataFrame:
    """Rows of the ``days`` days before ``as_of`` (today if not given).

    The test is on the bare timestamp, so the scan can skip files by their bounds.
    """
    end = _as_of(as_of)
    moment = F.col("timestamp")
    return footfall.filter(
        (moment >= F.date_sub(end, days).cast("timestamp")) & (moment < end.cast("timestamp"))
    )


def trailing_level(footfall: DataFrame, as_of: dt.date | str | None = None) -> DataFrame:
    """Mean daily total of each location over the look-back; days without rows do not count."""
    totals = daily_totals(last_days(footfall, as_of))
    return totals.groupBy(*SERIES).agg(round_half_up(F.avg("total_footfall")).alias("rolling_footfall"))


def weather_carry(forecasts: DataFrame, weather: DataFrame) -> DataFrame:
    """Rain and snow of the day before each forecast day.

    That is the previous forecast row of the city or, for its first, the observed sum
    of the day before. History is cut to the days some forecast follows and summed by
    day before the join. A repeated forecast row weighs that sum, as joining hourly
    rows to it would.
    """
    days = forecasts.groupBy("date", "city", "rain", "snow").agg(F.count(F.lit(1)).alias("repeats"))
    wanted = forecasts.select("city", F.date_sub("date", 1).alias("day")).distinct()
    observed = (
        weather.select("city", F.to_date("date").alias("day"), "rain", "snow")
        .join(wanted, ["city", "day"], "left_semi")
        .groupBy("city", "day")
        .agg(F.sum("rain").alias("day_rain"), F.sum("snow").alias("day_snow"))
    )
    joined = days.withColumn("day", F.date_sub("date", 1)).join(observed, ["city", "day"], "left")
    # a forecast has one short run of days per city, so this window stays small
    by_city = Window.partitionBy("city").orderBy("date", "rain", "snow")

    def before(name: str) -> Column:
        seen = F.col(f"day_{name}") * F.col("repeats")
        return F.coalesce(F.lag(name).over(by_city), seen)

    return joined.select(
        "date",
        "city",
        "rain",
        "snow",
        before("rain").alias("rain_24_hour"),
        before("snow").alias("snow_24_hour"),
    )


def forecast_days(forecasts: DataFrame, weather: DataFrame, holidays: DataFrame) -> DataFrame:
    """All features of the forecast days that do not depend on the location."""
    carry = weather_carry(forecasts, weather).select("date", "city", "rain_24_hour", "snow_24_hour")
    named = holidays.select("date", F.col("name").alias("holiday_name"))
    return forecasts.join(carry, ["date", "city"], "left").join(named, "date", "left").select(
        "city",
        "date",
        weekday_name(F.col("date")).alias("weekday"),
        month_name(F.col("date")).alias("month"),
        F.col("holiday_name").isNotNull().cast("int").alias("holiday"),
        round_half_up((F.col("min_temp") + F.col("max_temp")) / 2, 2).alias("temp"),
        "pressure",
        "humidity",
        "clouds",
        "wind",
        F.col("rain").alias("current_rain"),
        round_half_up(F.col("rain_24_hour"), 2).alias("rain_24_hour"),
        F.col("snow").alias("current_snow"),
        "snow_24_hour",
    )


def scoring_input(
    footfall: DataFrame,
    forecasts: DataFrame,
    weather: DataFrame,
    holidays: DataFrame,
    as_of: dt.date | str | None = None,
) -> DataFrame:
    """Each location with every forecast day of its city.

    The few forecast days are completed first, so the many locations take part in one
    join only. There are few cities: if the days are not broadcast, a city's locations
    go to ``CITY_PARTS`` parts and its days to each of them, so no task holds a city.
    """
    level = trailing_level(footfall, as_of).withColumn("_part", F.pmod(F.xxhash64("footfall_location"), F.lit(CITY_PARTS)).cast("int"))
    days = forecast_days(forecasts, weather, holidays).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(CITY_PARTS - 1))))
    rows = level.join(days, ["city", "_part"], "left")
    return rows.select(
        *SERIES,
        "date",
        "weekday",
        "month",
        F.coalesce("holiday", F.lit(0)).alias("bank_holiday"),
        "rolling_footfall",
        "temp",
        "pressure",
        "humidity",
        "clouds",
        "wind",
        "current_rain",
        "rain_24_hour",
        "current_snow",
        "snow_24_hour",
    )
