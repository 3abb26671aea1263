"""Hour and date texts, missing values, calendar parts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kerbside.functions import calendar, text
from kerbside.functions.numeric import round_half_up


def column(spark, values, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v"))).collect()]


def test_hours(spark):
    values = ["01:00", "01", "1", "1.0", "23", "24", "abc", "100", None]
    good = ["01:00:00"] * 4 + ["23:00:00"] + [None] * 4
    assert column(spark, values, lambda c: text.hour_text(c, "null")) == good
    midnight = [g or "00:00:00" for g in good]
    assert column(spark, values, lambda c: text.hour_text(c, "midnight")) == midnight


@pytest.mark.parametrize("bad", ["24", "noon", "1h"])
def test_bad_hour_fails_by_default(spark, bad):
    with pytest.raises(Exception, match="unreadable hour"):
        column(spark, [bad], text.hour_number)


def test_null_hour_is_no_error(spark):
    assert column(spark, [None], text.hour_number) == [None]


def test_dates(spark):
    march = dt.datetime(2023, 3, 2)
    forms = ["02/03/23", "2/3/23", "02-Mar-23", "02-MAR-23", "2-Mar-2023", "2023-03-02", "02/03/2023", "2-3-2023", "02-03-23"]
    assert column(spark, forms, text.parse_moment) == [march] * len(forms)
    clocks = ["02/03/2023 04:05", "2/3/23 4:05", "2023-03-02 04:05:00", "2023-03-02T04:05:00"]
    assert column(spark, clocks, text.parse_moment) == [march.replace(hour=4, minute=5)] * 4


def test_date_order_and_century(spark):
    assert column(spark, ["02/03/23"], lambda c: text.parse_moment(c, dayfirst=False)) == [dt.datetime(2023, 2, 3)]
    # the preferred order is no date, so the other is taken
    assert column(spark, ["02/13/23"], text.parse_moment) == [dt.datetime(2023, 2, 13)]
    assert column(spark, ["13/02/23"], lambda c: text.parse_moment(c, dayfirst=False)) == [dt.datetime(2023, 2, 13)]
    years = column(spark, ["01/01/68", "01/01/69", "01-Jan-95"], text.parse_moment)
    assert [m.year for m in years] == [2068, 1969, 1995]


def test_bad_dates(spark):
    bad = ["soon", "31/02/23", "2023-13-01", ""]
    assert column(spark, bad, lambda c: text.parse_moment(c, on_error="null")) == [None] * 4
    with pytest.raises(Exception, match="unreadable date"):
        column(spark, ["31/02/23"], text.parse_moment)


def test_missing_texts(spark):
    assert column(spark, ["NA", "", "null", "0", "nan"], lambda c: text.blank_to_null("v")) == [None, None, None, "0", None]


def test_calendar(spark):
    days = spark.sql("SELECT explode(sequence(DATE'2000-01-01', DATE'2024-12-31')) AS d")
    rows = days.select(
        "d",
        calendar.week_of_year(F.col("d")),
        calendar.weekday_name(F.col("d")),
        calendar.month_name(F.col("d")),
        calendar.day_suffix(F.col("d")),
    ).collect()
    for d, week, weekday, month, suffix in rows:
        assert (week, weekday, month, suffix) == (int(d.strftime("%U")), d.strftime("%A"), d.strftime("%b"), d.strftime("%Y%m%d"))


def test_epoch_zone(spark):
    row = spark.range(1).select(
        calendar.epoch_timestamp(F.lit(1688169600)).alias("utc"),
        calendar.epoch_timestamp(F.lit(1688169600), "Europe/London").alias("local"),
    ).first()
    assert (row.utc, row.local) == (dt.datetime(2023, 7, 1, 0), dt.datetime(2023, 7, 1, 1))


def test_rounding_ignores_float_noise(spark):
    df = spark.createDataFrame([(1234.4999999999998,), (-0.5,), (1.005,)], "x double")
    assert [r[0] for r in df.select(round_half_up(F.col("x"))).collect()] == [1235.0, -1.0, 1.0]
    assert df.select(round_half_up(F.col("x"), 2)).collect()[2][0] == 1.01
