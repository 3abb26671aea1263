"""What the operators of this subpackage share: reading, row functions, staging."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kerbside.session import ship_package, staging_path

#: A word, as Java and DuckDB patterns write it: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8; ``bytes.split`` cuts at the same characters as ``WORD``."""
    return (text or "").encode().split()


def n_words(column: str = "text"):
    """The number of words as a column; null texts have none."""
    return F.coalesce(F.regexp_count(F.col(column), F.lit(WORD)), F.lit(0)).cast("long")


def map_chunks(
    frame: DataFrame, columns: list[str], start: Callable[[], Callable[..., list[tuple]]], schema: str, chunk: int = 1000
) -> DataFrame:
    """Run a function over ``columns``, a chunk of rows at a time, in Arrow batches.

    ``start`` is called once in each task and returns the function, so that a
    task can hold tables and caches of its own. The function gets one list for
    each column and returns the result rows.
    """
    ship_package(frame.sparkSession)
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                rows = function(*(column.to_pylist() for column in batch.slice(at, chunk).columns))
                if rows:
                    yield record_batch(rows, arrow)

    return frame.select(*columns).mapInArrow(run, kind)


def map_rows(frame: DataFrame, columns: list[str], start: Callable[[], Callable[..., Iterable[tuple]]], schema: str, chunk: int = 1000) -> DataFrame:
    """``map_chunks`` with a function of one row, which returns the rows that come of it."""

    def by_row():
        function = start()
        return lambda *lists: [out for row in zip(*lists, strict=True) for out in function(*row)]

    return map_chunks(frame, columns, by_row, schema, chunk)


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    values = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared staging folder and read it back."""
    spark = frame.sparkSession
    path = staging_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


#: Rows of a file of ``stage_counted``, as long as they are of a few numbers each.
ROWS_PER_FILE = 50_000


def stage_counted(frame: DataFrame, name: str, most_rows: int, *metrics: Column) -> tuple[DataFrame, dict]:
    """``stage``, in as many files as ``most_rows`` rows need, with ``metrics`` told by the write itself.

    For small steps of a loop: however many partitions the shuffle before has, a few rows are a few tasks,
    and their number is known without another job.
    """
    seen = Observation()
    files = max(1, -(-most_rows // ROWS_PER_FILE))
    frame = stage(frame.coalesce(files).observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), name)
    return frame, seen.get


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
