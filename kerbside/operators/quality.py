"""Layout profile of raw files and checks on cleaned counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window, functions as F


def file_summary(headers: DataFrame, row_counts: DataFrame, drop_unnamed: bool = False) -> DataFrame:
    """Per source: sorted column names, the same joined, how many, and the number of rows.

    ``headers`` and ``row_counts`` come from the CSV layout reader. A source without
    data rows counts 0. Files of one name in several folders are one source if their
    headers agree, and a row each if they don't.
    """
    names = F.col("header")
    if drop_unnamed:
        names = F.filter(names, lambda n: ~F.lower(n).contains("unnamed"))
    sources = headers.select("source_file", "header").distinct().withColumn("columns", F.array_sort(names))
    counted = row_counts.groupBy("source_file", "header").agg(F.sum("rows").alias("rows"))
    counted = sources.join(counted, ["source_file", "header"], "left").groupBy("source_file", "columns").agg(F.sum("rows").alias("rows"))
    return counted.select(
        F.col("source_file").alias("filename"),
        "columns",
        F.array_join("columns", ", ").alias("columns_str"),
        F.size("columns").cast("bigint").alias("columns_cnt"),
        F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"),
    )


def layout_profile(summary: DataFrame) -> DataFrame:
    """Per layout: number of files and rows, and its place in the order of layouts, from 0.

    The one window orders a row per different header, and the layout reader already
    has a branch of the plan for each of those.
    """
    totals = summary.groupBy("columns_str").agg(
        F.count(F.lit(1)).alias("total_files"), F.sum("rows").alias("total_rows")
    )
    place = F.row_number().over(Window.orderBy("columns_str")) - 1
    return totals.select("columns_str", place.cast("bigint").alias("column_group"), "total_files", "total_rows")


def layout_sample(summary: DataFrame) -> DataFrame:
    """The first file, by name, of each layout."""
    first = F.min_by(F.struct("filename", "columns_cnt", "rows"), "filename").alias("first")
    return summary.groupBy("columns_str").agg(first).select("columns_str", "first.*")


def preview(rows: DataFrame, source_file: str, n: int = 5) -> DataFrame:
    """The first ``n`` rows of one file, in order of all its columns, texts as they are."""
    columns = [F.col(f"`{c}`").asc_nulls_last() for c in rows.columns]
    return rows.filter(F.col("source_file") == source_file).orderBy(*columns).limit(n)


def layout_previews(rows: DataFrame, sample: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows of the sample file of each layout, with their place from 1.

    ``rows`` has ``columns_str`` and ``source_file`` beside its own columns, ``sample``
    is :func:`layout_sample`. Rows come in order of all their columns.
    """
    chosen = rows.join(sample.select("columns_str", F.col("filename").alias("source_file")), ["columns_str", "source_file"], "left_semi")
    order = [F.col(f"`{c}`").asc_nulls_last() for c in rows.columns if c not in ("columns_str", "source_file")]
    place = F.row_number().over(Window.partitionBy("columns_str", "source_file").orderBy(*order))
    return chosen.withColumn("place", place.cast("bigint")).filter(F.col("place") <= n)


def hourly_profile(footfall: DataFrame) -> DataFrame:
    """Mean count by hour of day."""
    return footfall.groupBy(F.hour("timestamp").cast("bigint").alias("hour")).agg(
        F.avg("total_footfall").alias("mean_footfall")
    )


def duplicate_rows(rows: DataFrame) -> DataFrame:
    """Rows beyond the first of each set of equal rows."""
    copies = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0).cast("bigint")).alias("total_duplicates"))


def missing_values(rows: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of nulls per column and in all, in one pass."""
    columns = list(columns or rows.columns)
    counts = rows.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    total = reduce(add, [F.col(f"`{c}`") for c in columns])
    return counts.withColumn("total_missing", total)


def reconcile(tagged: Sequence[DataFrame]) -> DataFrame:
    """Where each raw row went: daily totals, rows with a null, duplicates, cleaned.

    ``tagged`` are the layouts from ``cleaning.tagged_leeds``: each raw row is read
    once, and copies collapse before the shuffle. ``unexplained`` is what is left over
    and should be 0.
    """
    rows = reduce(DataFrame.unionByName, tagged)
    keys = [c for c in rows.columns if c != "kind"]
    copies = rows.groupBy("kind", *keys).agg(F.count(F.lit(1)).alias("_n"))
    zero = F.lit(0).cast("bigint")
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("_n"))), zero)
    sums = copies.agg(
        F.coalesce(F.sum("_n"), zero).alias("raw_rows"),
        of("daily").alias("daily_totals"),
        of("null").alias("null_rows"),
        of("filled").alias("filled_rows"),
        F.count_if(F.col("kind") == "filled").alias("cleaned_rows"),
    )
    duplicates = F.col("filled_rows") - F.col("cleaned_rows")
    explained = F.col("daily_totals") + F.col("null_rows") + duplicates + F.col("cleaned_rows")
    return sums.select(
        "raw_rows",
        "daily_totals",
        "null_rows",
        duplicates.alias("duplicates"),
        "cleaned_rows",
        (F.col("raw_rows") - explained).alias("unexplained"),
    )
