"""From raw count files to the typed footfall table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions.text import at_hour, blank_to_null, hour_number, parse_moment, whole_number
from kerbside.operators.columns import drop_nameless, drop_rows_with_null, with_preferred
from kerbside.schemas import FOOTFALL

# Names of the count and location columns, best first.
COUNT_COLUMNS = ["ReportCount", "TotalCount", "InCount", "Count"]
LOCATION_COLUMNS = ["LocationName", "Location"]


def read_missing_as_null(df: DataFrame) -> DataFrame:
    """Null out the texts that stand for a missing value, in every string column."""
    return df.select([blank_to_null(n) if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes])


def _with_keys(raw: DataFrame, counts: Sequence[str], locations: Sequence[str]) -> DataFrame:
    named = read_missing_as_null(drop_nameless(raw))
    named = with_preferred(named, counts, "total_footfall")
    return with_preferred(named, locations, "footfall_location")


def clean_leeds(
    raw: DataFrame,
    city: str = "Leeds",
    counts: Sequence[str] = COUNT_COLUMNS,
    locations: Sequence[str] = LOCATION_COLUMNS,
    dayfirst: bool = True,
    on_error: str = "fail",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Clean the files of one layout.

    Rows without an hour are daily totals and go. A null in any other column the
    layout has, used or not, drops the row as well, so this runs per layout and
    before layouts are put together. ``on_error="quarantine"`` leaves rows with an
    unreadable hour, date or count out; :func:`unreadable_leeds` returns those.
    """
    lenient = "null" if on_error == "quarantine" else on_error
    df = _with_keys(raw, counts, locations)
    hour = hour_number(F.col("Hour"), lenient)
    moment = parse_moment(F.col("Date"), dayfirst, lenient)
    # the copies made above are null with their sources, and a timestamp is null only
    # with its date, so the nulls can go before any text is parsed
    df = (
        drop_rows_with_null(df)
        .withColumn("timestamp", at_hour(moment, hour))
        .withColumn("city", F.lit(city))
        .withColumn("total_footfall", whole_number(F.col("total_footfall"), lenient))
    )
    if lenient == "null":
        df = df.filter(F.col("timestamp").isNotNull() & F.col("total_footfall").isNotNull())
    return df.select(*[f.name for f in FOOTFALL], *keep)


def tagged_leeds(
    raw: DataFrame,
    city: str = "Leeds",
    counts: Sequence[str] = COUNT_COLUMNS,
    locations: Sequence[str] = LOCATION_COLUMNS,
    dayfirst: bool = True,
) -> DataFrame:
    """Every raw row of a layout as ``daily``, ``null`` or ``filled``; filled ones with their cleaned values."""
    df = _with_keys(raw, counts, locations)
    gap = reduce(or_, [F.col(f"`{c}`").isNull() for c in df.columns])
    kind = F.when(F.col("Hour").isNull(), "daily").when(gap, "null").otherwise("filled")
    df = df.withColumn("kind", kind)
    values = {
        "city": F.lit(city),
        "footfall_location": F.col("footfall_location"),
        "timestamp": at_hour(parse_moment(F.col("Date"), dayfirst), hour_number(F.col("Hour"))),
        "total_footfall": whole_number(F.col("total_footfall")),
    }
    return df.select("kind", *[F.when(F.col("kind") == "filled", v).alias(n) for n, v in values.items()])


def unreadable_leeds(
    raw: DataFrame,
    counts: Sequence[str] = COUNT_COLUMNS,
    locations: Sequence[str] = LOCATION_COLUMNS,
    dayfirst: bool = True,
) -> DataFrame:
    """Rows whose hour, date or count text has no known form, with the reason.

    Rows that :func:`clean_leeds` drops for a null are not among them.
    """
    df = drop_rows_with_null(_with_keys(raw, counts, locations))
    reason = (
        F.when(hour_number(F.col("Hour"), "null").isNull(), "hour")
        .when(parse_moment(F.col("Date"), dayfirst, "null").isNull(), "date")
        .when(whole_number(F.col("total_footfall"), "null").isNull(), "count")
    )
    return df.withColumn("reason", reason).filter(F.col("reason").isNotNull())


def as_records(rows: DataFrame, reason: Column) -> DataFrame:
    """Rows of any layout as ``(source_file, reason, record)``; the record is the row as JSON."""
    cells = [F.col(f"`{c}`") for c in rows.columns if c not in ("source_file", "reason")]
    return rows.select("source_file", reason.alias("reason"), F.to_json(F.struct(*cells)).alias("record"))


def union_cleaned(frames: Iterable[DataFrame]) -> DataFrame:
    """One table from the cleaned layouts, whole-row duplicates removed.

    Copies collapse before the shuffle, so a row repeated in many files costs
    one row per task.
    """
    return reduce(DataFrame.unionByName, frames).dropDuplicates()


def clean_york(
    raw: DataFrame, city: str = "York", dayfirst: bool = True, on_error: str = "fail", keep: Sequence[str] = ()
) -> DataFrame:
    """Clean the single-layout city: the date holds the hour, a null count means 0.

    ``on_error="quarantine"`` leaves out what :func:`unreadable_york` returns.
    """
    lenient = "null" if on_error == "quarantine" else on_error
    df = read_missing_as_null(raw)
    if lenient == "null":
        df = df.filter(_york_reason(dayfirst).isNull())
    df = (
        df.withColumn("city", F.lit(city))
        .withColumn("Date", parse_moment(F.col("Date"), dayfirst, lenient))
        .withColumnsRenamed(
            {"Date": "timestamp", "LocationName": "footfall_location", "InCount": "total_footfall"}
        )
        .withColumn("total_footfall", whole_number(F.col("total_footfall"), lenient))
        .na.fill(0, ["total_footfall"])
    )
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in FOOTFALL], *keep)


def _york_reason(dayfirst: bool) -> Column:
    """Why a row can't be read; a missing date or count is no reason."""
    bad_date = F.col("Date").isNotNull() & parse_moment(F.col("Date"), dayfirst, "null").isNull()
    bad_count = F.col("InCount").isNotNull() & whole_number(F.col("InCount"), "null").isNull()
    return F.when(bad_date, "date").when(bad_count, "count")


def unreadable_york(raw: DataFrame, dayfirst: bool = True) -> DataFrame:
    """Rows whose date or count text has no known form, with the reason."""
    df = read_missing_as_null(raw).withColumn("reason", _york_reason(dayfirst))
    return df.filter(F.col("reason").isNotNull())
