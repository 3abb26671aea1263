"""The load jobs, from landed raw files to typed tables.

Each flattens or cleans its raw text once, into a staged table; the CSV files it keeps
and the typed table are both made from that. A load can be repeated: it replaces its
own files, and tables are swapped as a whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from kerbside.operators.cleaning import as_records, clean_leeds, clean_york, union_cleaned, unreadable_leeds, unreadable_york
from kerbside.operators.columns import drop_nameless
from kerbside.operators.history import in_range, refresh_days
from kerbside.schemas import FOOTFALL, FORECASTS, HOLIDAYS, WEATHER_HISTORY
from kerbside.session import staging_path
from kerbside.sources.catalogue import EXCLUDED_FILES, EXCLUDED_SOURCES, csv_files
from kerbside.sources.csv_layouts import MALFORMED, read_layouts
from kerbside.sources.json_docs import flatten_forecast, flatten_history, flatten_holidays
from kerbside.sources.tables import (
    CSV_OPTIONS,
    PeriodTable,
    VersionedTable,
    land_counts,
    read_json_runs,
    write_csv_run,
)

QUARANTINE = StructType().add("source_file", StringType()).add("reason", StringType()).add("record", StringType())


def _stage(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    path = staging_path(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _keep_and_store(
    spark: SparkSession, by_source: DataFrame, raw_root: str, processed_root: str, table_path: str, distinct: bool
) -> DataFrame:
    """Keep cleaned rows as files by source and as the table, both from one staged copy."""
    kept = _stage(spark, by_source, "cleaned")
    land_counts(kept, raw_root, processed_root, raw=False)
    rows = kept.select(FOOTFALL.names)
    table = VersionedTable(spark, table_path, FOOTFALL, by="timestamp")  # scoring reads the last days
    table.replace(union_cleaned([rows]) if distinct else rows)
    return table.read()


def quarantined(spark: SparkSession, table_path: str) -> DataFrame:
    """Rows the last load with ``on_error="quarantine"`` left out: ``(source_file, reason, record)``."""
    return VersionedTable(spark, f"{table_path}_quarantine", QUARANTINE).read()


def _quarantine(spark: SparkSession, records: Sequence[DataFrame], table_path: str) -> None:
    VersionedTable(spark, f"{table_path}_quarantine", QUARANTINE).replace(reduce(DataFrame.unionByName, records))


def load_leeds(
    spark: SparkSession,
    raw_root: str,
    processed_root: str,
    table_path: str,
    exclude: Sequence[str] = EXCLUDED_SOURCES,
    dayfirst: bool = True,
    on_error: str = "fail",
    names: DataFrame | None = None,
) -> DataFrame:
    """Clean every layout, keep the cleaned files by source, store the table.

    ``names`` (a frame with ``file_name``) restricts the load to these files. With
    ``on_error="quarantine"``, rows with a wrong number of cells or unreadable texts go
    to a table beside the result (:func:`quarantined`).
    """
    lenient = on_error == "quarantine"
    frames = read_layouts(spark, raw_root, exclude, names, malformed=lenient)
    if not frames:
        raise FileNotFoundError(f"no count file of the wanted names under {raw_root}")
    if lenient:
        records = []
        for i, raw in enumerate(frames):
            torn = raw.filter(F.col(MALFORMED).isNotNull())
            frames[i] = raw = raw.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
            records.append(as_records(torn, F.lit("cells")))
            unreadable = unreadable_leeds(raw, dayfirst=dayfirst).select(*[F.col(f"`{c}`") for c in _raw_columns(raw)], "reason")
            records.append(as_records(unreadable, F.col("reason")))
        _quarantine(spark, records, table_path)
    cleaned = [clean_leeds(raw, dayfirst=dayfirst, on_error=on_error, keep=["source_file"]) for raw in frames]
    by_source = reduce(DataFrame.unionByName, cleaned)
    return _keep_and_store(spark, by_source, raw_root, processed_root, table_path, distinct=True)


def _raw_columns(raw: DataFrame) -> list[str]:
    """Columns that cleaning keeps: those with a header."""
    return drop_nameless(raw).columns


def load_leeds_catalogue(
    spark: SparkSession,
    docs: DataFrame,
    raw_root: str,
    processed_root: str,
    table_path: str,
    exclude: Sequence[str] = EXCLUDED_FILES,
    **options,
) -> DataFrame:
    """The load of the files that the catalogue lists, out of those landed under ``raw_root``.

    ``exclude`` holds names as they stand in the catalogue. Files that landed but are
    not listed stay out.
    """
    names = csv_files(docs, exclude).select("file_name")
    return load_leeds(spark, raw_root, processed_root, table_path, exclude=(), names=names, **options)


def load_york(
    spark: SparkSession,
    raw_path: str,
    raw_root: str,
    processed_root: str,
    table_path: str,
    source_file: str = "york_footfall_data.csv",
    dayfirst: bool = True,
    on_error: str = "fail",
) -> DataFrame:
    """Keep the raw file, clean it, keep the cleaned file, store the table; ``on_error`` as for Leeds."""
    lenient = on_error == "quarantine"
    header = spark.read.options(**CSV_OPTIONS).csv(raw_path).schema
    strict = {**CSV_OPTIONS, "columnPruning": "false", "mode": "PERMISSIVE" if lenient else "FAILFAST"}
    if lenient:
        strict["columnNameOfCorruptRecord"] = MALFORMED
        header = header.add(MALFORMED, StringType())
    raw = spark.read.schema(header).options(**strict).csv(raw_path).withColumn("source_file", F.lit(source_file))
    if lenient:
        torn = raw.filter(F.col(MALFORMED).isNotNull())
        raw = raw.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)
        unreadable = unreadable_york(raw, dayfirst)
        _quarantine(spark, [as_records(torn, F.lit("cells")), as_records(unreadable, F.col("reason"))], table_path)
    land_counts(raw, raw_root, processed_root, raw=True)
    cleaned = clean_york(raw, dayfirst=dayfirst, on_error=on_error, keep=["source_file"])
    return _keep_and_store(spark, cleaned, raw_root, processed_root, table_path, distinct=False)


def _load_flat(spark: SparkSession, rows: DataFrame, schema: StructType, processed_root: str, table_path: str, run_ts: str) -> DataFrame:
    kept = _stage(spark, rows, "flattened")
    write_csv_run(kept, processed_root, run_ts)
    table = VersionedTable(spark, table_path, schema)
    table.replace(kept)
    return table.read()


def load_forecast(
    spark: SparkSession, landed: str, processed_root: str, table_path: str, run_ts: str, zone: str = "UTC"
) -> DataFrame:
    rows = flatten_forecast(read_json_runs(spark, landed), zone)
    return _load_flat(spark, rows, FORECASTS, processed_root, table_path, run_ts)


def load_holidays(
    spark: SparkSession, landed: str, processed_root: str, table_path: str, run_ts: str
) -> DataFrame:
    rows = flatten_holidays(read_json_runs(spark, landed))
    return _load_flat(spark, rows, HOLIDAYS, processed_root, table_path, run_ts)


def load_history(
    spark: SparkSession,
    landed: str,
    processed_root: str,
    slices_root: str,
    complete_root: str,
    run_ts: str,
    start: dt.date | str,
    end: dt.date | str,
    zone: str = "UTC",
    unit: str = "month",
) -> DataFrame:
    """Load the days ``start <= day < end`` and refresh the complete history with them, in one run."""
    rows = in_range(flatten_history(read_json_runs(spark, landed), zone), start, end)
    kept = _stage(spark, rows, "flattened")
    write_csv_run(kept, processed_root, run_ts)
    slices = PeriodTable(spark, slices_root, WEATHER_HISTORY, unit)
    slices.replace_days(kept, start, end)
    complete = PeriodTable(spark, complete_root, WEATHER_HISTORY, unit)
    refresh_days(complete, in_range(slices.read_periods(start, end), start, end), start, end)
    return complete.read()
