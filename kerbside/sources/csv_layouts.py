"""Many CSV files whose headers differ.

One read over mixed headers would put values under the wrong names, so files are
grouped by their ordered header and each group is read with its own schema. Spark's
readers list the files and read their rows; headers come from the files' heads.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kerbside.session import ship_package, staging_path
from kerbside.sources.catalogue import EXCLUDED_SOURCES
from kerbside.sources.tables import CSV_OPTIONS, CSV_STRICT

# Rows whose cells don't match the header, where they are wanted and not an error.
MALFORMED = "_malformed"


def source_name(path: Column) -> Column:
    """Name of the source a path belongs to: its ``source_file=`` folder if any, else the file name."""
    folder = F.nullif(F.regexp_extract(path, r"source_file=([^/]+)/", 1), F.lit(""))
    return F.coalesce(folder, F.element_at(F.split(path, "/"), -1))


def column_names(header: Sequence[str]) -> list[str]:
    """Column names of a header: blanks become ``Unnamed: i``, repeats get a suffix."""
    names: list[str] = []
    seen: dict[str, int] = {}
    for i, cell in enumerate(header):
        name = cell if cell.strip() else f"Unnamed: {i}"
        repeats = seen.get(name.lower(), 0)
        seen[name.lower()] = repeats + 1
        names.append(f"{name}.{repeats}" if repeats else name)
    return names


def _plain_path() -> Column:
    """The path of the file a row is from; the metadata percent-encode it, but a plus stands for itself."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _parse_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        cells = [next(csv.reader([line.removeprefix("\ufeff").rstrip("\r")]), []) for line in batch["line"]]
        yield batch.drop(columns="line").assign(header=[column_names(row) for row in cells])


def file_headers(
    spark: SparkSession,
    root: str,
    exclude: Sequence[str] = EXCLUDED_SOURCES,
    names: DataFrame | None = None,
) -> DataFrame:
    """``(path, source_file, header)`` of every CSV file under ``root``.

    The first line of each file, read when this is called. ``exclude`` leaves sources out;
    ``names``, a frame with ``file_name``, keeps only those it lists. A header with a
    line break inside quotes is an error.
    """
    return _wanted(_all_headers(spark, root), exclude, names)


def _wanted(headers: DataFrame, exclude: Sequence[str], names: DataFrame | None) -> DataFrame:
    if exclude:
        headers = headers.filter(~F.col("source_file").isin(list(exclude)))
    if names is not None:
        headers = headers.join(names.select(F.col("file_name").alias("source_file")).distinct(), "source_file", "left_semi")
    torn = F.raise_error(F.concat(F.lit("a header goes over several lines: "), F.col("path")))
    headers = headers.withColumn("path", F.when(F.col("torn"), torn.cast("string")).otherwise(F.col("path")))
    return headers.select("path", "source_file", "header")


#: Bytes of a file that are asked for at once until its first line ends.
HEAD = 1 << 16


def _head(path: str, uri: str) -> tuple[str | None, bool]:
    """First line of a file, null if it has none, and whether it could be opened here."""
    try:
        files, name = (fs.LocalFileSystem(), path.removeprefix("file:")) if path.startswith("file:") else fs.FileSystem.from_uri(uri)
        source = files.open_input_stream(name, compression=None, buffer_size=0)
    except (OSError, ImportError, pa.ArrowException):
        return None, False
    head = b""
    with source:
        while not re.search(rb"[\r\n]", head) and (more := source.read(HEAD)):
            head += more
    return (re.split(rb"[\r\n]", head)[0].decode("utf-8", "replace") if head else None), True


def _heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        told = [_head(path, uri) for path, uri in zip(batch["path"], batch["uri"], strict=True)]
        yield batch[["path"]].assign(line=[line for line, _ in told], opened=[opened for _, opened in told])


def _first_lines(spark: SparkSession, root: str) -> DataFrame:
    """``(path, line)`` of every CSV file, staged.

    Spark lists the files; workers read each up to the end of its first line, so
    the bytes read go by the number of files and not by their size. Where the workers'
    own client can't open a file (a scheme or login that only Spark's has), one text
    scan serves all files instead, and is dearer by the size of the text.
    """
    ship_package(spark)

    def files(kind: str) -> DataFrame:
        return spark.read.format(kind).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(root)

    listed = files("binaryFile").select(_plain_path().alias("path"), F.col("_metadata.file_path").alias("uri"))  # contents are not read
    heads = _staged(listed.mapInPandas(_heads, "path string, line string, opened boolean"))
    if heads.where(~F.col("opened")).isEmpty():
        return heads.where(F.col("line").isNotNull()).select("path", "line")
    lines = files("text").select("value", F.col("_metadata.file_block_start").alias("block"), _plain_path().alias("path"))
    first = lines.where(F.col("block") == 0).withColumn("number", F.monotonically_increasing_id())  # grows along a file's block
    return _staged(first.groupBy("path").agg(F.min_by("value", "number").alias("line")))


def _staged(frame: DataFrame) -> DataFrame:
    path = staging_path(frame.sparkSession, "heads")
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _all_headers(spark: SparkSession, root: str) -> DataFrame:
    """``(path, source_file, header, torn)`` of every CSV file, whether it is wanted or not."""
    first = _first_lines(spark, root).withColumn("source_file", source_name(F.col("path")))
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"')))
    schema = "path string, source_file string, torn boolean, header array<string>"
    return first.select("path", "source_file", "line", (quotes % 2 != 0).alias("torn")).mapInPandas(_parse_headers, schema)


@dataclass(frozen=True)
class Layout:
    """Files that share one ordered header: single files, and folders whose files all do."""

    header: tuple[str, ...]
    paths: tuple[str, ...]


def layouts(headers: DataFrame, all_headers: DataFrame | None = None) -> list[Layout]:
    """Group files by header.

    The driver gets a folder's name once for each header in it. If a folder has one
    header, its files are read by a pattern, however many they are; only folders of
    mixed files, or with files left out, give their file names. ``all_headers`` is the
    frame before files were left out.
    """
    folder = F.regexp_replace("path", "/[^/]*$", "")
    everything = (headers if all_headers is None else all_headers).withColumn("folder", folder)
    whole = everything.groupBy("folder").agg(F.count_distinct("header").alias("kinds"), F.count(F.lit(1)).alias("files"))
    own = headers.withColumn("folder", folder).groupBy("folder", "header").agg(F.count(F.lit(1)).alias("own"))
    uniform = own.join(whole, "folder").filter((F.col("kinds") == 1) & (F.col("own") == F.col("files")))
    mixed = headers.withColumn("folder", folder).join(uniform.select("folder"), "folder", "left_anti")
    told = uniform.select("header", F.col("folder").alias("path"), F.lit(True).alias("pattern")).union(
        mixed.select("header", "path", F.lit(False))
    )
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in told.toLocalIterator(prefetchPartitions=True):
        path = _as_literal(row["path"])
        groups.setdefault(tuple(row["header"]), []).append(f"{path}/*.csv" if row["pattern"] else path)
    return [Layout(h, tuple(sorted(p))) for h, p in sorted(groups.items())]


def _as_literal(path: str) -> str:
    """A path whose brackets, stars and the like are not taken for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_layout(spark: SparkSession, layout: Layout, malformed: bool = False) -> DataFrame:
    """Rows of one layout, all columns as text, plus ``source_file``.

    A row with more or fewer cells than the header is an error, or, with
    ``malformed``, its line is kept in that column and null for all other rows.
    """
    schema = StructType([StructField(name, StringType()) for name in layout.header])
    options = CSV_STRICT
    if malformed:
        schema = schema.add(MALFORMED, StringType())
        options = {**CSV_OPTIONS, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED, "columnPruning": "false"}
    rows = spark.read.schema(schema).options(**options).csv(list(layout.paths))
    return rows.select("*", source_name(_plain_path()).alias("source_file"))


def read_layouts(
    spark: SparkSession,
    root: str,
    exclude: Sequence[str] = EXCLUDED_SOURCES,
    names: DataFrame | None = None,
    malformed: bool = False,
) -> list[DataFrame]:
    """One frame per layout found under ``root``."""
    every = _all_headers(spark, root)
    found = layouts(_wanted(every, exclude, names), every.select("path", "source_file", "header"))
    return [read_layout(spark, layout, malformed) for layout in found]


def rows_per_source(found: Iterable[Layout], frames: Iterable[DataFrame]) -> DataFrame:
    """``(source_file, header, rows)`` over all layouts; only the file name leaves the scan."""
    counts = [
        frame.groupBy("source_file").agg(F.count(F.lit(1)).alias("rows")).withColumn("header", F.array(*map(F.lit, layout.header)))
        for layout, frame in zip(found, frames)
    ]
    union = counts[0]
    for more in counts[1:]:
        union = union.unionByName(more)
    return union
