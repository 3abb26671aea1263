"""Daily reporting view and model training view.

Both views, as stated in SQL, join the counts to their own trailing features and to
weather a second time. Here the features ride along the rows they belong to. Days
are added up inside the partitions the windows already made, and holidays, which
hold for whole days, meet the daily rows instead of the hourly ones.

A row that shares its city, location and timestamp with others would pair with each
of them in the self-join. Its ``copies`` count gives it that weight, so the results
are those of the self-join for such data too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions.calendar import month_name, week_of_year, weekday_name
from kerbside.functions.numeric import mean_of, round_half_up
from kerbside.operators.joins import footfall_complete, with_hourly_weather
from kerbside.operators.trailing import SERIES, SPAN_DAYS, with_trailing_features

PLAIN_MEANS = ["temp", "pressure", "humidity", "clouds", "wind"]
RAIN_SNOW_MEANS = ["current_rain", "rain_24_hour", "current_snow", "snow_24_hour"]
MEANS = PLAIN_MEANS + RAIN_SNOW_MEANS


def rolling_features(footfall: DataFrame, weather: DataFrame, span_days: int = SPAN_DAYS) -> DataFrame:
    """Trailing features by city, location and timestamp."""
    rows = with_trailing_features(with_hourly_weather(footfall, weather), span_days)
    return rows.select(
        *SERIES, "timestamp", "footfall_90_day_average", "snow_24_hour_total", "rain_24_hour_total"
    )


def weighted_hours(footfall: DataFrame, weather: DataFrame, span_days: int = SPAN_DAYS) -> tuple[DataFrame, DataFrame]:
    """Hourly rows with and without a location, with features and the weight each has in the views.

    A row without a location matches no features in the self-join, not even its own.
    Such rows go round the windows, so they never meet in one task, however many there are.
    """
    hours = with_hourly_weather(footfall, weather)
    zero = F.lit(0.0)

    def row(rolling: Column, rain: Column, snow: Column, weight: Column) -> list[Column | str]:
        return [
            *SERIES,
            "timestamp",
            "total_footfall",
            *PLAIN_MEANS,
            rolling.alias("rolling"),
            F.coalesce("rain", zero).alias("current_rain"),
            F.coalesce(rain, zero).alias("rain_24_hour"),
            F.coalesce("snow", zero).alias("current_snow"),
            F.coalesce(snow, zero).alias("snow_24_hour"),
            weight.cast("bigint").alias("weight"),
            "span",
        ]

    known = with_trailing_features(hours, span_days).select(
        *row(F.col("footfall_90_day_average"), F.col("rain_24_hour_total"), F.col("snow_24_hour_total"), F.col("copies"))
    )
    nothing = F.lit(None).cast("double")
    unknown = hours.filter(F.col("footfall_location").isNull()).withColumn("span", F.lit(0))
    return known, unknown.select(*row(nothing, nothing, nothing, F.lit(1)))


def daily_partials(known: DataFrame, unknown: DataFrame) -> DataFrame:
    """Sums and counts per city, location and day.

    Adds no shuffle to the hours with a location; those without are summed by task first.
    """
    weight = F.col("weight")
    aggs = [
        F.sum(F.col("total_footfall") * weight).alias("total_footfall"),
        F.sum(F.col("rolling") * weight).alias("rolling"),
    ]
    for name in MEANS:
        aggs.append(F.sum(F.col(name) * weight).alias(f"{name}_sum"))
        aggs.append(F.sum(F.when(F.col(name).isNotNull(), weight)).alias(f"{name}_n"))
    by_day = [
        hours.groupBy(*SERIES, "span", F.to_date("timestamp").alias("date")).agg(*aggs).drop("span")
        for hours in (known, unknown)
    ]
    return by_day[0].union(by_day[1])


def holiday_counts(holidays: DataFrame) -> DataFrame:
    """Holidays as ``(date, bank_holiday, fan_out)``; repeats of one name only add weight."""
    return holidays.groupBy("date", F.col("name").alias("bank_holiday")).agg(
        F.count(F.lit(1)).alias("fan_out")
    )


def _fan_out() -> Column:
    return F.coalesce("fan_out", F.lit(1).cast("bigint"))


def footfall_complete_weather(
    leeds: DataFrame, york: DataFrame, weather: DataFrame, holidays: DataFrame, span_days: int = SPAN_DAYS
) -> DataFrame:
    """Daily report by city, location, day and holiday name."""
    hours = weighted_hours(footfall_complete(leeds, york), weather, span_days)
    days = daily_partials(*hours).join(holiday_counts(holidays), "date", "left")
    day = F.col("date")
    return days.select(
        *SERIES,
        "date",
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        week_of_year(day).alias("week"),
        "bank_holiday",
        (F.col("total_footfall") * _fan_out()).alias("total_footfall"),
        round_half_up(F.col("rolling") * _fan_out()).alias("rolling_footfall"),
        *[round_half_up(mean_of(F.col(f"{n}_sum"), F.col(f"{n}_n")), 2).alias(n) for n in MEANS],
    )


def model_input_data_daily(
    leeds: DataFrame,
    york: DataFrame,
    weather: DataFrame,
    holidays: DataFrame,
    exclude_from: str = "2020-01-01",
    exclude_to: str = "2022-12-31",
    span_days: int = SPAN_DAYS,
    dedupe_holidays: bool = False,
) -> DataFrame:
    """Training rows by city, location, weekday, month and holiday flag.

    The excluded stretch is taken out after the trailing features are made, and its
    upper bound is the first instant of that day. A day with two holidays counts
    twice unless ``dedupe_holidays`` is set.
    """
    hours = weighted_hours(footfall_complete(leeds, york), weather, span_days)
    low, high = (F.lit(b).cast("timestamp") for b in (exclude_from, exclude_to))
    hours = [h.filter(~F.col("timestamp").between(low, high)) for h in hours]

    holiday_days = holidays.groupBy("date", F.col("name").isNotNull().alias("named")).agg(
        F.count(F.lit(1)).alias("fan_out")
    )
    if dedupe_holidays:
        holiday_days = holiday_days.filter("named").withColumn("fan_out", F.lit(1).cast("bigint"))
    days = daily_partials(*hours).join(holiday_days, "date", "left")

    by = [
        *[F.col(c) for c in SERIES],
        weekday_name(F.col("date")).alias("weekday"),
        month_name(F.col("date")).alias("month"),
        F.coalesce("named", F.lit(False)).cast("int").alias("bank_holiday"),
    ]
    aggs = [
        F.sum(F.col("total_footfall") * _fan_out()).alias("total_footfall"),
        round_half_up(F.sum(F.col("rolling") * _fan_out())).alias("rolling_footfall"),
    ]
    for name in MEANS:
        total, count = (F.sum(F.col(f"{name}_{part}") * _fan_out()) for part in ("sum", "n"))
        aggs.append(mean_of(total, count).alias(name))
    return days.groupBy(*by).agg(*aggs)
