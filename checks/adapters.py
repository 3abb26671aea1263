"""The given tables seen as counts, weather, forecasts and holidays, and as raw files of each.

Measures are whole numbers or quarters, so sums do not depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from kerbside.schemas import FOOTFALL, FORECASTS, HOLIDAYS, WEATHER_HISTORY, conform
from kerbside.session import staging_path
from kerbside.sources.tables import land_json_run

AS_OF = "2001-06-01"
FORECAST_END = "2001-07-01"
EXCLUDE_FROM, EXCLUDE_TO = "1997-01-01", "1998-12-31"


_schemas: dict[str, StructType] = {}
_stored: dict[tuple, str] = {}


def _storable(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let :func:`store` keep an input as a table, which later calls then read."""

    def read(spark: SparkSession, sf_dir: str, *args, **options) -> DataFrame:
        rows = make(spark, sf_dir, *args, **options)
        path = _stored.get((spark.sparkContext.applicationId, sf_dir, make.__name__, args, *sorted(options.items())))
        return rows if path is None else spark.read.schema(rows.schema).parquet(path)

    read.make = make
    return read


def store(spark: SparkSession, sf_dir: str) -> None:
    """Make the inputs once, so that timings are of the operators alone."""
    wanted = [(footfall, ("F",), {}), (footfall, ("O",), {}), (footfall, (), {})]
    wanted += [(f, (), o) for f, name in ((weather, "gaps"), (forecasts, "coming"), (holidays, "rare")) for o in ({}, {name: True})]
    for read, args, options in wanted:
        rows = read.make(spark, sf_dir, *args, **options)
        path = staging_path(spark, read.make.__name__)
        rows.write.parquet(path)
        _stored[(spark.sparkContext.applicationId, sf_dir, read.make.__name__, args, *sorted(options.items()))] = path
    write_raw_counts(spark, sf_dir)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is inferred once, then declared."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def _line_hour() -> Column:
    hours = F.make_dt_interval(hours=(F.col("l_orderkey") % 24).cast("int"))
    return F.col("l_shipdate").cast("timestamp") + hours


@_storable
def footfall(spark: SparkSession, sf_dir: str, city: str | None = None) -> DataFrame:
    """Counts of both cities, or of one."""
    lines = table(spark, sf_dir, "lineitem")
    if city is not None:
        lines = lines.filter(F.col("l_linestatus") == city)
    rows = lines.groupBy(
        F.col("l_linestatus").alias("city"),
        F.col("l_returnflag").alias("footfall_location"),
        _line_hour().alias("timestamp"),
    ).agg(F.sum("l_quantity").alias("total_footfall"))
    return conform(rows, FOOTFALL)


def cities(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return footfall(spark, sf_dir, "F"), footfall(spark, sf_dir, "O")


def _weather_measures(nullable: bool) -> list[Column]:
    rain = F.round(F.col("l_discount") * 100)
    snow = F.round(F.col("l_tax") * 100)
    if nullable:
        rain = F.when(F.col("l_suppkey") % 3 != 0, rain)
        snow = F.when(F.col("l_suppkey") % 3 != 1, snow)
    return [
        F.sum("l_suppkey").alias("pressure"),
        F.sum("l_partkey").alias("humidity"),
        F.max("l_linenumber").alias("clouds"),
        F.count(F.lit(1)).alias("wind"),
        F.sum(rain).alias("rain"),
        F.sum(snow).alias("snow"),
    ]


@_storable
def weather(spark: SparkSession, sf_dir: str, gaps: bool = False) -> DataFrame:
    """Hourly weather, in quarters of a degree.

    With ``gaps`` the weather of the 13th of a month is of half past, so that some counted
    hours have no weather; that is for the joins, where it matters.
    """
    rows = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_linestatus").alias("city"), _line_hour().alias("date"))
        .agg((F.sum("l_quantity") / 4).alias("temp"), *_weather_measures(nullable=True))
    )
    if gaps:
        later = F.col("date") + F.make_dt_interval(mins=F.lit(30))
        rows = rows.withColumn("date", F.when(F.dayofmonth("date") == 13, later).otherwise(F.col("date")))
    return conform(rows, WEATHER_HISTORY)


@_storable
def forecasts(spark: SparkSession, sf_dir: str, coming: bool = False) -> DataFrame:
    """Daily forecasts of all days, or of the days that are scored; those of the 7th are a year late, so the 8th follows the 6th."""
    shipped = F.col("l_shipdate")
    lines = table(spark, sf_dir, "lineitem")
    if coming:
        lines = lines.filter((shipped >= F.lit(AS_OF)) & (shipped < F.lit(FORECAST_END)))
    rows = (
        lines.groupBy(F.col("l_linestatus").alias("city"), F.to_date(shipped).alias("date"))
        .agg(
            F.min("l_quantity").alias("min_temp"),
            F.max("l_quantity").alias("max_temp"),
            *_weather_measures(nullable=False),
        )
    )
    if coming:
        rows = rows.withColumn("date", F.when(F.dayofmonth("date") == 7, F.date_add("date", 365)).otherwise(F.col("date")))
    return conform(rows, FORECASTS)


@_storable
def holidays(spark: SparkSession, sf_dir: str, rare: bool = False) -> DataFrame:
    """Order days as holidays; with ``rare`` all but the first of a month are a century off, so that few days have one."""
    day = F.to_date("o_orderdate")
    if rare:
        day = F.when(F.dayofmonth(day) == 1, day).otherwise(F.date_add(day, 36525))
    rows = table(spark, sf_dir, "orders").select(day.alias("date"), F.col("o_orderpriority").alias("name"))
    return conform(rows.distinct(), HOLIDAYS)


# ---- raw files -----------------------------------------------------------------


def _event_count() -> Column:
    return F.floor("value").cast("string")


# One raw layout per remainder of event_id by 7: columns by name, in file order.
def _layout_columns(layout: int) -> dict[str, Column]:
    location, hour = F.col("event_type"), F.hour("ts")
    count, nothing = _event_count(), F.lit(None).cast("string")
    short = F.date_format("ts", "dd/MM/yy")
    if layout == 0:
        return {"LocationName": location, "Date": F.date_format("ts", "dd-MMM-yy"), "Hour": hour.cast("string"),
                "TotalCount": count, "Month": F.date_format("ts", "MMM"), "": nothing}
    if layout == 1:
        return {"LocationName": location, "WeekDay": F.date_format("ts", "EEE"), "Date": short,
                "Hour": F.concat(hour.cast("string"), F.lit(":00")), "TotalCount": count}
    if layout == 2:
        return {"Date": F.date_format("ts", "yyyy-MM-dd"), "Hour": F.lpad(hour.cast("string"), 2, "0"),
                "LocationName": location, "InCount": count, "OutCount": F.lit("0")}
    if layout == 3:
        return {"Location": location, "Date": F.date_format("ts", "dd/MM/yyyy"),
                "Hour": F.concat(hour.cast("string"), F.lit(".0")), "InCount": F.lit("-1"), "ReportCount": count}
    if layout == 4:
        note = F.when(F.col("event_id") % 5 != 0, F.lit("ok"))
        return {"LocationName": location, "Date": F.date_format("ts", "d/M/yy"), "Hour": hour.cast("string"),
                "ReportCount": count, "Note": note}
    if layout == 5:
        return {"LocationName": location, "Date": short, "Hour": nothing, "ReportCount": count}
    return {"LocationName": location, "Date": short, "Hour": F.format_string("%02d:00", hour),
            "Count": F.concat(count, F.lit(".0")), "Unnamed: 4": nothing}


LAYOUTS = range(7)


_raw_counts: dict[tuple[str, str], str] = {}


def write_raw_counts(spark: SparkSession, sf_dir: str) -> str:
    """All events as count files of seven layouts, two sources each; returns the folder.

    Written once per application and set of tables.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key in _raw_counts:
        return _raw_counts[key]
    root = staging_path(spark, "raw-counts")
    events = table(spark, sf_dir, "events")
    half = F.when(F.dayofmonth("ts") <= 15, F.lit("a")).otherwise(F.lit("b"))

    def write(layout: int) -> None:
        rows = events.filter(F.col("event_id") % 7 == layout)
        source = F.concat(F.lit(f"counts-{layout}"), half, F.lit(".csv")).alias("source_file")
        columns = [c.alias(n) for n, c in _layout_columns(layout).items()]
        rows.select(*columns, source).write.partitionBy("source_file").option("header", "true").csv(
            f"{root}/layout={layout}"
        )

    with ThreadPoolExecutor(len(LAYOUTS)) as pool:
        list(pool.map(write, LAYOUTS))
    _raw_counts[key] = root
    return root


def write_raw_york(spark: SparkSession, sf_dir: str) -> str:
    """All events as the single-layout file: the date holds the hour, a zero count is blank."""
    path = staging_path(spark, "raw-york")
    count = F.floor("value")
    rows = table(spark, sf_dir, "events").select(
        F.date_format("ts", "dd/MM/yyyy HH:00").alias("Date"),
        F.col("event_type").alias("LocationName"),
        F.when(count % 4 != 0, count.cast("string")).alias("InCount"),
    )
    rows.write.option("header", "true").csv(path)
    return path


def write_raw_broken(spark: SparkSession, sf_dir: str) -> str:
    """All events as one layout; half of the rows have one fault: a cell too many, or an unreadable text."""
    path = staging_path(spark, "raw-broken")
    fault = F.col("event_id") % 8
    count = _event_count()
    hour = F.hour("ts").cast("string")
    cells = [
        F.col("event_type"),
        F.when(fault == 2, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd")),
        F.when(fault == 1, "25").otherwise(hour),
        F.when(fault == 0, F.concat(count, F.lit(",more"))).when(fault == 3, F.concat(count, F.lit(".5"))).otherwise(count),
    ]
    # one text to a row, so a comma in a cell starts another
    line = F.concat_ws(",", *cells).alias("LocationName,Date,Hour,Count")
    rows = table(spark, sf_dir, "events").select(line, F.lit("broken.csv").alias("source_file"))
    rows.write.partitionBy("source_file").options(header="true", sep="|").csv(path)
    return path


def count_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue of the raw count files: one twice, one in another format, one unlisted, one wrongly named."""
    half = F.when(F.dayofmonth("ts") <= 15, F.lit("a")).otherwise(F.lit("b"))
    names = (
        table(spark, sf_dir, "events")
        .select(F.concat(F.lit("counts-"), (F.col("event_id") % 7).cast("string"), half, F.lit(".csv")).alias("name"))
        .distinct()
        .filter(F.col("name") != "counts-6b.csv")
    )
    url = lambda folder: F.concat(F.lit(f"https://data.example/{folder}/"), F.col("name"))
    kind = F.when(F.col("name") == "counts-0a.csv", "xls").otherwise("csv")
    one = names.select(F.col("name").alias("key"), F.struct(kind.alias("format"), url("f").alias("url")).alias("value"))
    again = names.filter(F.col("name") == "counts-1a.csv").select(
        F.lit("zz").alias("key"), F.struct(F.lit("csv").alias("format"), url("new").alias("url")).alias("value")
    )
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value"))))
    docs = one.union(again).agg(entries.alias("resources"))
    return docs.select(F.lit(1).cast("bigint").alias("doc_id"), F.to_json(F.struct("resources")).alias("body"))


def catalogue_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalogue documents of at most 50 entries; brands repeat inside a document."""
    key = F.col("p_partkey")
    file_name = F.concat(F.replace("p_brand", F.lit("#"), F.lit("%20")), F.lit("%20"), F.col("p_type"), F.lit(".csv"))
    entry = F.struct(
        F.format_string("%012d", key).alias("key"),
        F.struct(
            F.when(key % 4 == 0, "xls").otherwise("csv").alias("format"),
            F.concat(F.lit("https://data.example/files/"), key.cast("string"), F.lit("/"), file_name).alias("url"),
        ).alias("value"),
    )
    docs = (
        table(spark, sf_dir, "part")
        .groupBy(F.floor(key / 50).cast("bigint").alias("doc_id"))
        .agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("resources"))
    )
    return docs.select("doc_id", F.to_json(F.struct("resources")).alias("body"))


EXCLUDED_BRAND_FILES = ["Brand%207%20ECONOMY.csv", "Brand%2012%20SMALL.csv"]


def _city_docs(entries: DataFrame, by: list[str]) -> DataFrame:
    """One document per group of ``by``, mapping each city to its list; a group is one day."""
    cities_of_day = entries.groupBy(*by, "city").agg(F.struct(F.collect_list("e").alias("list")).alias("answer"))
    docs = cities_of_day.groupBy(*by).agg(
        F.map_from_entries(F.collect_list(F.struct("city", "answer"))).alias("body")
    )
    return docs.select(*by, F.to_json("body").alias("body"))


def _kelvin(name: str) -> Column:
    return F.col(name) + F.lit(273.15)


def history_docs(rows: DataFrame) -> DataFrame:
    """Hourly weather as one response per day; null rain or snow has no key."""
    e = F.struct(
        F.unix_seconds("date").alias("dt"),
        F.struct(_kelvin("temp").alias("temp"), "pressure", "humidity").alias("main"),
        F.struct(F.col("clouds").alias("all")).alias("clouds"),
        F.struct(F.col("wind").alias("speed")).alias("wind"),
        F.when(F.col("rain").isNotNull(), F.struct(F.col("rain").alias("1h"))).alias("rain"),
        F.when(F.col("snow").isNotNull(), F.struct(F.col("snow").alias("1h"))).alias("snow"),
    )
    return _city_docs(rows.select("city", F.to_date("date").alias("day"), e.alias("e")), ["day"])


def forecast_docs(rows: DataFrame) -> DataFrame:
    """Daily forecasts as responses; a zero rain or snow has no key."""
    e = F.struct(
        F.unix_seconds(F.col("date").cast("timestamp")).alias("dt"),
        F.struct(_kelvin("min_temp").alias("min"), _kelvin("max_temp").alias("max")).alias("temp"),
        "pressure",
        "humidity",
        "clouds",
        F.col("wind").alias("speed"),
        F.when(F.col("rain") != 0, F.col("rain")).alias("rain"),
        F.when(F.col("snow") != 0, F.col("snow")).alias("snow"),
    )
    return _city_docs(rows.select("city", F.col("date").alias("day"), e.alias("e")), ["day"])


def holiday_docs(rows: DataFrame) -> DataFrame:
    """Holidays as one response per year; where a day is kept follows from its priority."""
    first = F.substring("name", 1, 1)
    counties = (
        F.when(first == "1", F.array(F.lit("GB-ENG"), F.lit("GB-WLS")))
        .when(first == "2", F.array(F.lit("GB-SCT")))
        .when(first == "3", F.array(F.lit("GB-NIR")))
    )
    day = F.struct(
        F.date_format("date", "yyyy-MM-dd").alias("date"),
        F.when(first == "3", "Saint Patrick's Day").otherwise(F.col("name")).alias("name"),
        F.col("name").alias("localName"),
        counties.alias("counties"),
    )
    docs = rows.groupBy(F.year("date").alias("year")).agg(F.array(F.collect_list(day)).alias("body"))
    return docs.select("year", F.to_json("body").alias("body"))


def landed(spark: SparkSession, docs: DataFrame, name: str) -> str:
    """Land documents and return the folder of the run."""
    return land_json_run(docs, staging_path(spark, name), "2001-06-01 00-00-00")


def fresh_slice(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Corrected weather for ``start <= date < end``: temperatures one up, every third hour not delivered."""
    low, high = F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")
    cut = rows.filter((F.col("date") >= low) & (F.col("date") < high) & (F.hour("date") % 3 != 2))
    return cut.withColumn("temp", F.col("temp") + 1)
