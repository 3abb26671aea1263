"""Reading hours, dates and missing values out of hand-made CSV text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Texts that a CSV reader of data-frame libraries takes for a missing value.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Fixed value: the hour texts accepted, one or two digits, then a dot, a colon or the end of the text.
HOUR_PATTERN = r"^([0-9]{1,2})([.:]|$)"

# A day and month with one kind of separator, then a two-digit year.
_TWO_DIGIT_YEAR = r"^(\d{1,2}([/-])(?:\d{1,2}|[A-Za-z]{3})\2)(YEARS)(?!\d)"
_CLOCK = "[ H:mm[:ss]]"
_CLOCK_SHAPE = r"( \d{1,2}:\d{2}(:\d{2})?)?$"


def quoted(name: str) -> str:
    """Column name for use in an expression text."""
    return "`" + name.replace("`", "``") + "`"


def blank_to_null(name: str) -> Column:
    """Column ``name``, null where its text stands for a missing value."""
    column = quoted(name)
    texts = ", ".join(f"'{t}'" for t in MISSING_TEXTS)
    return F.expr(f"CASE WHEN {column} NOT IN ({texts}) THEN {column} END").alias(name)


def _or_fail(source: Column, parsed: Column, what: str, on_error: str) -> Column:
    if on_error == "null":
        return parsed
    if on_error != "fail":
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    message = F.concat(F.lit(f"unreadable {what}: "), source)
    return F.when(source.isNotNull(), F.coalesce(parsed, F.raise_error(message)))


def whole_number(value: Column, on_error: str = "fail") -> Column:
    """Count text such as ``12`` or ``12.0`` as a whole number; fractions and other texts are errors."""
    text = F.trim(value.cast("string"))
    number = text.try_cast("double")
    whole = F.when((number == F.floor(number)) & (F.abs(number) < 2**53), number.cast("bigint"))
    return _or_fail(text, whole, "count", on_error)


def hour_number(value: Column, on_error: str = "fail") -> Column:
    """Hour of day from ``1``, ``01``, ``01:00`` or ``1.0``; other texts and hours over 23 are errors."""
    text = F.trim(value.cast("string"))
    digits = F.nullif(F.regexp_extract(text, HOUR_PATTERN, 1), F.lit(""))
    hour = digits.cast("int")
    return _or_fail(text, F.when(hour <= 23, hour), "hour", on_error)


def hour_text(value: Column, on_error: str = "fail") -> Column:
    """Hour of day as ``HH:00:00``.

    ``on_error="midnight"`` gives ``00:00:00`` for an unreadable text.
    """
    hour = hour_number(value, "null" if on_error == "midnight" else on_error)
    text = F.concat(F.lpad(hour.cast("string"), 2, "0"), F.lit(":00:00"))
    return F.coalesce(text, F.lit("00:00:00")) if on_error == "midnight" else text


def parse_moment(value: Column, dayfirst: bool = True, on_error: str = "fail") -> Column:
    """Timestamp from the date forms met in count files, with or without a clock part.

    The shape of the text picks the one pattern to parse with, so no row pays for
    patterns that cannot match. Numeric forms are read day first (month first with
    ``dayfirst=False``); the other order is tried only where that is no valid date.
    Two-digit years from 69 on belong to the 1900s.
    """
    text = F.trim(value.cast("string"))
    full = F.regexp_replace(text, _TWO_DIGIT_YEAR.replace("YEARS", r"69|[7-9]\d"), "$119$3")
    full = F.regexp_replace(full, _TWO_DIGIT_YEAR.replace("YEARS", r"\d\d"), "$120$3")

    def parse(pattern: str) -> Column:
        return F.try_to_timestamp(full, F.lit(pattern + _CLOCK))

    def numeric(sep: str) -> Column:
        orders = [f"d{sep}M{sep}yyyy", f"M{sep}d{sep}yyyy"]
        return F.coalesce(*map(parse, orders if dayfirst else reversed(orders)))

    def shaped(pattern: str) -> Column:
        return full.rlike(pattern + _CLOCK_SHAPE)

    parsed = (
        F.when(shaped(r"^\d{1,2}/\d{1,2}/\d{4}"), numeric("/"))
        .when(shaped(r"^\d{1,2}-[A-Za-z]{3}-\d{4}"), parse("d-MMM-yyyy"))
        .when(full.rlike(r"^\d{4}-\d{1,2}-\d{1,2}"), full.try_cast("timestamp"))
        .when(shaped(r"^\d{1,2}-\d{1,2}-\d{4}"), numeric("-"))
    )
    return _or_fail(text, parsed, "date", on_error)


def at_hour(moment: Column, hour: Column) -> Column:
    """The day of ``moment`` at ``hour`` o'clock."""
    return F.to_date(moment).cast("timestamp") + F.make_dt_interval(hours=hour)
