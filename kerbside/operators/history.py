"""Weather history: one slice in, the complete table refreshed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from kerbside.schemas import WEATHER_HISTORY, conform
from kerbside.sources.tables import PeriodTable, VersionedTable

KEY = ["city", "date"]


def merge_slice(history: DataFrame, latest: DataFrame) -> DataFrame:
    """The new slice and all history rows whose city and hour it does not have."""
    kept = conform(history, WEATHER_HISTORY).join(latest.select(*KEY), KEY, "left_anti")
    return conform(latest, WEATHER_HISTORY).union(kept.select(WEATHER_HISTORY.names))


def in_range(rows: DataFrame, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Rows with ``start <= date < end``."""
    low, high = (F.lit(str(b)).cast("timestamp") for b in (start, end))
    return rows.filter((F.col("date") >= low) & (F.col("date") < high))


def refresh_table(complete: VersionedTable, latest: DataFrame) -> None:
    """Replace the complete table by itself merged with the slice."""
    complete.replace(merge_slice(complete.read(), latest))


def refresh_days(complete: PeriodTable, latest: DataFrame, start: dt.date | str, end: dt.date | str) -> None:
    """The same refresh for a table kept by period, with a slice of ``start <= date < end``.

    Hours outside the range cannot match a row of the slice, so only the periods it
    touches are listed, read and written, and the table comes out as from
    :func:`refresh_table`. Any number of days is one job.
    """
    complete.write_periods(merge_slice(complete.read_periods(start, end), in_range(latest, start, end)))
