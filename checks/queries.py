"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import adapters as a
from kerbside.functions import calendar, text
from kerbside.operators import cleaning, history, joins, quality
from kerbside.operators.columns import with_preferred
from kerbside.operators.trailing import SERIES, with_trailing_features
from kerbside.plans import loads, model, reporting, scoring
from kerbside.schemas import FOOTFALL, WEATHER_HISTORY
from kerbside.session import configure, staging_path
from kerbside.sources import catalogue, csv_layouts, json_docs, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without zone, the type the SQL check has for them."""
    return df.select([F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n) for n, t in df.dtypes])


def query(make: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zoneless(make(configure(spark), sf_dir))

    QUERIES[make.__name__] = run
    return run


# ---- scans and sinks -----------------------------------------------------------


def csv_layout_rows(spark, sf_dir):
    def named(raw):
        columns = sorted(c for c in raw.columns if c != "source_file")
        raw = with_preferred(raw, cleaning.LOCATION_COLUMNS, "location_text")
        raw = with_preferred(raw, cleaning.COUNT_COLUMNS, "count_text")
        return raw.select(
            F.lit(", ".join(columns)).alias("columns_str"),
            "source_file",
            "location_text",
            F.col("Date").alias("date_text"),
            F.col("Hour").alias("hour_text"),
            "count_text",
        )

    frames = csv_layouts.read_layouts(spark, a.write_raw_counts(spark, sf_dir))
    return reduce(DataFrame.unionByName, [named(f) for f in frames])


@query
def csv_layout_read(spark, sf_dir):
    return csv_layout_rows(spark, sf_dir)


@query
def catalogue_filter(spark, sf_dir):
    return catalogue.csv_files(a.catalogue_docs(spark, sf_dir), a.EXCLUDED_BRAND_FILES)


@query
def forecast_flatten(spark, sf_dir):
    return json_docs.flatten_forecast(a.forecast_docs(a.forecasts(spark, sf_dir)))


@query
def history_flatten(spark, sf_dir):
    return json_docs.flatten_history(a.history_docs(a.weather(spark, sf_dir)))


@query
def holiday_flatten(spark, sf_dir):
    return json_docs.flatten_holidays(a.holiday_docs(a.holidays(spark, sf_dir)))


@query
def footfall_complete(spark, sf_dir):
    rows = a.footfall(spark, sf_dir)
    hour = F.hour("timestamp")
    early = rows.filter(hour < 16)
    return joins.footfall_complete(early.union(rows.filter(hour < 4)), rows.filter(hour >= 8))


@query
def typed_sink_roundtrip(spark, sf_dir):
    path = staging_path(spark, "typed")
    rows = a.footfall(spark, sf_dir)
    as_text = rows.select([F.col(c).cast("string").alias(c) for c in reversed(rows.columns)])
    tables.write_table(as_text, path, FOOTFALL)
    return tables.read_table(spark, path, FOOTFALL)


@query
def csv_sink_roundtrip(spark, sf_dir):
    rows = a.footfall(spark, sf_dir)
    by_source = rows.withColumn("source_file", F.concat("footfall_location", F.lit(".csv")))
    # two sources in turn below one root: the second must leave the first alone
    raw, first = staging_path(spark, "raw"), F.col("footfall_location") < "N"
    for part in (by_source.filter(first), by_source.filter(~first)):
        tables.land_counts(part, raw, staging_path(spark, "processed"), raw=True)
    run = tables.write_csv_run(rows, staging_path(spark, "runs"), "2001-06-01 00-00-00")

    by_run = tables.read_csv(spark, run, rows.schema).withColumn("source_file", F.lit("run"))
    return tables.read_csv(spark, raw, by_source.schema).union(by_run)


@query
def json_landing_roundtrip(spark, sf_dir):
    path = a.landed(spark, a.forecast_docs(a.forecasts(spark, sf_dir)), "forecast-docs")
    return json_docs.flatten_forecast(tables.read_json_runs(spark, path))


@query
def history_slice_replace(spark, sf_dir):
    rows = a.weather(spark, sf_dir)
    store = tables.PeriodTable(spark, staging_path(spark, "slices"), WEATHER_HISTORY)
    store.write_periods(rows)
    store.replace_days(a.fresh_slice(rows, "2001-05-20", "2001-06-01"), "2001-05-20", "2001-06-01")
    return store.read()


@query
def history_refresh(spark, sf_dir):
    rows = a.weather(spark, sf_dir)
    complete = tables.VersionedTable(spark, staging_path(spark, "complete"), WEATHER_HISTORY)
    complete.replace(rows)
    history.refresh_table(complete, a.fresh_slice(rows, "2001-05-20", "2001-06-01"))
    return complete.read()


@query
def history_refresh_range(spark, sf_dir):
    rows = a.weather(spark, sf_dir)
    complete_root = staging_path(spark, "complete-days")
    tables.PeriodTable(spark, complete_root, WEATHER_HISTORY).write_periods(rows)
    landed = a.landed(spark, a.history_docs(a.fresh_slice(rows, "2001-05-10", "2001-06-05")), "history-docs")
    at = staging_path(spark, "history-csv"), staging_path(spark, "history-slices"), complete_root
    run = "2001-06-01 00-00-00", "2001-05-15", "2001-06-01"
    loads.load_history(spark, landed, *at, *run)
    return loads.load_history(spark, landed, *at, *run)  # a run can be repeated


# ---- columns, cleaning, text ---------------------------------------------------


@query
def preferred_column(spark, sf_dir):
    rows = a.table(spark, sf_dir, "events").select(
        "event_id",
        F.floor("value").alias("InCount"),
        F.when(F.col("user_id") > 20, F.col("user_id")).alias("TotalCount"),
        F.col("event_type").alias("Location"),
    )
    rows = with_preferred(rows, cleaning.COUNT_COLUMNS, "total_footfall")
    rows = with_preferred(rows, cleaning.LOCATION_COLUMNS, "footfall_location")
    return rows.select("event_id", "total_footfall", "footfall_location")


def _cleaned(spark, sf_dir):
    raw = csv_layouts.read_layouts(spark, a.write_raw_counts(spark, sf_dir))
    return raw, [cleaning.clean_leeds(f) for f in raw]


@query
def clean_leeds(spark, sf_dir):
    raw = csv_layouts.read_layouts(spark, a.write_raw_counts(spark, sf_dir))
    return reduce(DataFrame.unionByName, [cleaning.clean_leeds(f, keep=["source_file"]) for f in raw])


@query
def clean_leeds_union(spark, sf_dir):
    return cleaning.union_cleaned(_cleaned(spark, sf_dir)[1])


@query
def clean_york(spark, sf_dir):
    raw = spark.read.options(**tables.CSV_OPTIONS).csv(a.write_raw_york(spark, sf_dir))
    return cleaning.clean_york(raw)


@query
def leeds_load(spark, sf_dir):
    return loads.load_leeds(
        spark, a.write_raw_counts(spark, sf_dir), staging_path(spark, "leeds-processed"),
        staging_path(spark, "leeds"), exclude=["counts-3b.csv"],
    )


@query
def leeds_catalogue_load(spark, sf_dir):
    return loads.load_leeds_catalogue(
        spark, a.count_catalogue(spark, sf_dir), a.write_raw_counts(spark, sf_dir),
        staging_path(spark, "leeds-processed"), staging_path(spark, "leeds"), exclude=["counts-3b.csv"],
    )


@query
def leeds_load_quarantine(spark, sf_dir):
    """Rows of the table and, with their reason, those that were set apart."""
    path = staging_path(spark, "leeds-lenient")
    kept = loads.load_leeds(
        spark, a.write_raw_broken(spark, sf_dir), staging_path(spark, "leeds-processed"), path, on_error="quarantine"
    )
    nothing = F.lit(None)
    apart = loads.quarantined(spark, path).select(
        *[nothing.cast(f.dataType).alias(f.name) for f in FOOTFALL], "source_file", "reason", "record"
    )
    text = nothing.cast("string")
    return kept.select("*", text.alias("source_file"), text.alias("reason"), text.alias("record")).union(apart)


@query
def york_load(spark, sf_dir):
    return loads.load_york(
        spark, a.write_raw_york(spark, sf_dir), staging_path(spark, "york-raw"),
        staging_path(spark, "york-processed"), staging_path(spark, "york"),
    )


@query
def forecast_load(spark, sf_dir):
    landed = a.landed(spark, a.forecast_docs(a.forecasts(spark, sf_dir)), "forecast-docs")
    at = staging_path(spark, "forecast-csv"), staging_path(spark, "forecasts"), "2001-06-01 00-00-00"
    loads.load_forecast(spark, landed, *at)
    return loads.load_forecast(spark, landed, *at)  # a run can be repeated


@query
def holiday_load(spark, sf_dir):
    landed = a.landed(spark, a.holiday_docs(a.holidays(spark, sf_dir)), "holiday-docs")
    at = staging_path(spark, "holiday-csv"), staging_path(spark, "holidays"), "2001-06-01 00-00-00"
    loads.load_holidays(spark, landed, *at)
    return loads.load_holidays(spark, landed, *at)  # a run can be repeated


@query
def hour_text(spark, sf_dir):
    hour = F.hour("ts").cast("string")
    form = F.col("user_id") % 6
    raw = (
        F.when(form == 0, hour)
        .when(form == 1, F.lpad(hour, 2, "0"))
        .when(form == 2, F.concat(F.lpad(hour, 2, "0"), F.lit(":00")))
        .when(form == 3, F.concat(hour, F.lit(".0")))
        .when(form == 4, F.concat(hour, F.lit("h")))
    )
    rows = a.table(spark, sf_dir, "events").select("event_id", raw.alias("raw_hour"))
    return rows.select(
        "event_id",
        text.hour_text(F.col("raw_hour"), "null").alias("hour"),
        text.hour_text(F.col("raw_hour"), "midnight").alias("hour_or_midnight"),
    )


DATE_FORMS = ["dd/MM/yy", "d/M/yyyy", "dd-MMM-yy", "d-MMM-yyyy", "yyyy-MM-dd", "dd/MM/yyyy HH:mm", "yyyy-MM-dd HH:mm:ss"]


@query
def date_text(spark, sf_dir):
    form = F.col("user_id") % (len(DATE_FORMS) + 1)
    raw = reduce(
        lambda chain, i: chain.when(form == i, F.date_format("ts", DATE_FORMS[i])),
        range(1, len(DATE_FORMS)),
        F.when(form == 0, F.date_format("ts", DATE_FORMS[0])),
    ).otherwise(F.lit("soon"))
    rows = a.table(spark, sf_dir, "events").select("event_id", raw.alias("raw_date"))
    return rows.select("event_id", text.parse_moment(F.col("raw_date"), on_error="null").alias("moment"))


@query
def calendar_parts(spark, sf_dir):
    day = F.to_date("o_orderdate")
    return a.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.year(day).cast("bigint").alias("year"),
        F.month(day).cast("bigint").alias("month"),
        calendar.week_of_year(day).alias("week"),
        calendar.weekday_name(day).alias("weekday"),
        calendar.month_name(day).alias("month_name"),
        calendar.day_suffix(day).alias("day_suffix"),
        F.to_date(calendar.epoch_timestamp(F.col("o_orderkey") * 7200)).alias("epoch_day"),
    )


# ---- joins, windows, views -----------------------------------------------------


@query
def hourly_weather_join(spark, sf_dir):
    return joins.with_hourly_weather(a.footfall(spark, sf_dir), a.weather(spark, sf_dir, gaps=True))


@query
def rolling_selfjoin(spark, sf_dir):
    rows, hours = a.footfall(spark, sf_dir), a.weather(spark, sf_dir, gaps=True)
    return joins.with_features(rows, reporting.rolling_features(rows, hours))


@query
def holiday_join(spark, sf_dir):
    rows = a.footfall(spark, sf_dir).withColumn("date", F.to_date("timestamp"))
    return joins.with_holidays(rows, a.holidays(spark, sf_dir, rare=True))


def _features(spark, sf_dir):
    return with_trailing_features(joins.with_hourly_weather(a.footfall(spark, sf_dir), a.weather(spark, sf_dir, gaps=True)))


@query
def rolling_same_hour_avg(spark, sf_dir):
    return _features(spark, sf_dir).select(*SERIES, "timestamp", "total_footfall", "footfall_90_day_average")


@query
def rolling_weather_24(spark, sf_dir):
    return _features(spark, sf_dir).select(*SERIES, "timestamp", "snow_24_hour_total", "rain_24_hour_total")


@query
def footfall_complete_weather(spark, sf_dir):
    return reporting.footfall_complete_weather(
        *a.cities(spark, sf_dir), a.weather(spark, sf_dir, gaps=True), a.holidays(spark, sf_dir, rare=True)
    )


def training_rows(spark, sf_dir):
    return reporting.model_input_data_daily(
        *a.cities(spark, sf_dir), a.weather(spark, sf_dir, gaps=True), a.holidays(spark, sf_dir, rare=True),
        exclude_from=a.EXCLUDE_FROM, exclude_to=a.EXCLUDE_TO,
    )


@query
def model_input_daily(spark, sf_dir):
    return training_rows(spark, sf_dir)


@query
def daily_totals(spark, sf_dir):
    return scoring.daily_totals(a.footfall(spark, sf_dir))


@query
def trailing_level(spark, sf_dir):
    return scoring.trailing_level(a.footfall(spark, sf_dir), a.AS_OF)


@query
def weather_carry(spark, sf_dir):
    return scoring.weather_carry(a.forecasts(spark, sf_dir, coming=True), a.weather(spark, sf_dir, gaps=True))


def scoring_rows(spark, sf_dir):
    return scoring.scoring_input(
        joins.footfall_complete(*a.cities(spark, sf_dir)), a.forecasts(spark, sf_dir, coming=True),
        a.weather(spark, sf_dir, gaps=True), a.holidays(spark, sf_dir, rare=True), a.AS_OF,
    )


@query
def scoring_input(spark, sf_dir):
    return scoring_rows(spark, sf_dir).orderBy(*SERIES, "date")


# ---- profile and quality -------------------------------------------------------


def _summary(spark, sf_dir, drop_unnamed):
    headers = csv_layouts.file_headers(spark, a.write_raw_counts(spark, sf_dir))
    found = csv_layouts.layouts(headers)
    frames = [csv_layouts.read_layout(spark, layout) for layout in found]
    return quality.file_summary(headers, csv_layouts.rows_per_source(found, frames), drop_unnamed)


@query
def file_summary(spark, sf_dir):
    return _summary(spark, sf_dir, drop_unnamed=False).drop("columns")


@query
def layout_profile(spark, sf_dir):
    return quality.layout_profile(_summary(spark, sf_dir, drop_unnamed=True))


@query
def layout_sample(spark, sf_dir):
    return quality.layout_sample(_summary(spark, sf_dir, drop_unnamed=True))


@query
def layout_preview(spark, sf_dir):
    return quality.layout_previews(csv_layout_rows(spark, sf_dir), _summary_sample(spark, sf_dir))


def _summary_sample(spark, sf_dir):
    return quality.layout_sample(_summary(spark, sf_dir, drop_unnamed=False))


@query
def hourly_profile(spark, sf_dir):
    return quality.hourly_profile(a.footfall(spark, sf_dir))


@query
def quality_duplicates(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir)[1]
    return quality.duplicate_rows(reduce(DataFrame.unionByName, cleaned))


@query
def quality_missing(spark, sf_dir):
    return quality.missing_values(a.weather(spark, sf_dir))


@query
def quality_reconcile(spark, sf_dir):
    raw = csv_layouts.read_layouts(spark, a.write_raw_counts(spark, sf_dir))
    return quality.reconcile([cleaning.tagged_leeds(f) for f in raw])


# ---- model ---------------------------------------------------------------------


def _trained(spark, sf_dir):
    rows = model.stage(spark, training_rows(spark, sf_dir))
    return rows, model.train(rows)


def _checked(scored: DataFrame, rows: DataFrame) -> DataFrame:
    """What must hold for any prediction, whatever the forest: whole, and within the labels seen."""
    seen = rows.agg(F.min(model.LABEL).alias("_low"), F.max(model.LABEL).alias("_high")).first()
    value = F.col("predicted_footfall")
    return scored.withColumns(
        {
            "prediction_is_whole": value == F.floor(value),
            "prediction_in_range": value.between(seen["_low"], seen["_high"]),
        }
    ).drop("predicted_footfall")


@query
def train_model(spark, sf_dir):
    rows, fitted = _trained(spark, sf_dir)
    return _checked(model.predict(fitted, rows), rows)


@query
def predict(spark, sf_dir):
    rows, fitted = _trained(spark, sf_dir)
    return _checked(model.predict(fitted, scoring_rows(spark, sf_dir)), rows)


@query
def model_roundtrip(spark, sf_dir):
    """A stored model predicts what the fresh one does."""
    path = staging_path(spark, "model")
    rows, fitted = _trained(spark, sf_dir)
    model.save(fitted, path)
    fresh = model.predict(fitted, scoring_rows(spark, sf_dir)).withColumnRenamed("predicted_footfall", "fresh")
    both = model.predict(model.load(spark, path), fresh)
    return both.withColumn("same", F.col("fresh") == F.col("predicted_footfall")).drop("fresh", "predicted_footfall")


@query
def model_encoding(spark, sf_dir):
    return _trained(spark, sf_dir)[1].encoding


@query
def model_cross_means(spark, sf_dir):
    """What training rows are encoded by: means over the other folds."""
    rows = model.stage(spark, training_rows(spark, sf_dir))
    return model.cross_means(rows).withColumn("mean", F.round("mean", 6))


@query
def model_filled(spark, sf_dir):
    return model.filled_values(_trained(spark, sf_dir)[1]).withColumn("mean", F.round("mean", 6))


@query
def model_fit(spark, sf_dir):
    """How well the forest fits rows it has not seen."""
    return model.fit_report(model.stage(spark, training_rows(spark, sf_dir)))
