"""Table and file sinks.

Every sink lets Spark rebalance before the write: small partitions merge, and one
source or day that holds much of the data is split over several files and tasks.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from kerbside.schemas import conform
from kerbside.session import setting

# Quotes are doubled inside quoted text, and blanks at the ends of a text are kept.
CSV_OPTIONS = {"header": "true", "escape": '"'}
CSV_WRITE_OPTIONS = {**CSV_OPTIONS, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# A row with more or fewer cells than the header, or with a cell that does not fit its
# type, is an error. Cells are only counted if the parser sees all of them.
CSV_STRICT = {**CSV_OPTIONS, "mode": "FAILFAST", "columnPruning": "false"}

# Sources a task writes side by side. Each holds an open file and its buffer, no rows.
OPEN_SOURCES = 32


def write_table(df: DataFrame, path: str, schema: StructType) -> None:
    """Replace the files at ``path``, with the declared columns and types.

    For tables nobody reads meanwhile; :class:`VersionedTable` swaps whole versions.
    """
    conform(df, schema).hint("rebalance").write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


class ConcurrentUpdateError(RuntimeError):
    """Somebody else has committed since this writer read the table."""


def publish(spark: SparkSession, source: str, target: str) -> bool:
    """Give a folder its final name, unless that is taken; tells if it was free.

    The rename refuses an existing target: of two writers at the same moment one succeeds. It needs a file
    system whose rename of a folder is one step, such as HDFS or a local disk.
    """
    context = spark.sparkContext
    fs, conf = context._jvm.org.apache.hadoop.fs, context._jsc.hadoopConfiguration()
    old, new = (fs.Path(p).getFileSystem(conf).makeQualified(fs.Path(p)) for p in (source, target))
    files = fs.FileContext.getFileContext(old.toUri(), conf)
    files.mkdir(new.getParent(), fs.permission.FsPermission.getDirDefault(), True)
    refuse = context._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        files.rename(old, new, refuse)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() != "FileAlreadyExistsException":
            raise
        return False
    return True


@dataclass(frozen=True)
class Snapshot:
    """The last commit and the version of each part as of it."""

    seq: int
    parts: dict[str, str]


class Versions:
    """The parts of a table, each in the version that the last commit about it names.

    Data go to a folder of their own below ``data``; a small table below ``commits``
    then names the parts it replaces. Readers see a version only once it is named, so
    a job that dies leaves the table as it was, and running readers keep their files.

    Commits are numbered. One is written aside and then renamed to its number, which fails if
    that is taken. A writer that has read the table through this object asks for the number
    after the commit it has read: if another commit has come between, or comes
    at the same moment, the write fails and changes nothing.

    Every ``WHOLE_EVERY``-th commit names all parts, so a reader needs no older ones however
    many there are, and an object that has read the log once reads the commits since then.
    """

    LOG = "seq long, part string, version string"
    WHOLE_EVERY = 32

    def __init__(self, spark: SparkSession, root: str, schema: StructType):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self._seen: int | None = None
        self._known = Snapshot(0, {})

    def _log(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.LOG).option("recursiveFileLookup", "true").parquet(f"{self.root}/commits")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.LOG)

    def _commit_path(self, seq: int) -> str:
        return f"{self.root}/commits/{seq:020d}"

    def _last(self) -> int:
        """Number of the last commit. They follow each other without a gap, so a few questions whether one exists find it."""
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path
        files = path(self.root).getFileSystem(context._jsc.hadoopConfiguration())
        low, step = self._known.seq, 1
        while files.exists(path(self._commit_path(low + step))):
            low, step = low + step, 2 * step
        high = low + step
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if files.exists(path(self._commit_path(middle))) else (low, middle)
        return low

    def snapshot(self) -> Snapshot:
        """One row for each part comes to the driver, as folders do in any file index."""
        last, known = self._last(), self._known
        if last > known.seq:
            whole = last - last % self.WHOLE_EVERY
            first, parts = (whole, {}) if whole > known.seq else (known.seq + 1, dict(known.parts))
            rows = self.spark.read.schema(self.LOG).parquet(*map(self._commit_path, range(first, last + 1))).collect()
            parts |= {r["part"]: r["version"] for r in sorted(rows, key=lambda r: r["seq"])}
            self._known = Snapshot(last, parts)
        return self._known

    def _read_snapshot(self) -> Snapshot:
        told = self.snapshot()
        self._seen = told.seq
        return told

    def _new_version(self) -> tuple[str, int]:
        """A folder name for new data, and the commit they build on."""
        base = self.snapshot().seq if self._seen is None else self._seen
        return f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}", base

    def _commit(self, base: int, version: str, parts: list[str]) -> None:
        """Name ``version`` as that of ``parts`` in the commit after ``base``."""
        self._seen = None
        changed = ConcurrentUpdateError(f"{self.root} has changed since it was read")
        if self._known.seq != base:
            raise changed
        new = dict.fromkeys(parts, version)
        state = self._known.parts | new
        told = new if (base + 1) % self.WHOLE_EVERY else state
        rows = self.spark.createDataFrame([(base + 1, p, v) for p, v in told.items()], self.LOG)
        aside = f"{self.root}/uncommitted/{uuid.uuid4().hex}"
        rows.coalesce(1).write.parquet(aside)
        if not publish(self.spark, aside, self._commit_path(base + 1)):
            raise changed
        self._known = Snapshot(base + 1, state)

    def _empty(self, version: str) -> None:
        """Give back the space of a version that no part uses any more."""
        self.spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(f"{self.root}/data/{version}")


class VersionedTable(Versions):
    """A table replaced as a whole, also by a query that reads it.

    With ``by``, a column's name, files hold ranges of it and are sorted by it, so a reader that
    wants some of them (the days before a forecast) skips the other files by their statistics.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, by: str | None = None):
        super().__init__(spark, root, schema)
        self.by = by

    def versions(self) -> list[str]:
        return [r["version"] for r in self._log().orderBy("seq").collect()]

    def read(self) -> DataFrame:
        parts = self._read_snapshot().parts
        if not parts:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return read_table(self.spark, f"{self.root}/data/{parts['']}", self.schema)

    def replace(self, df: DataFrame) -> None:
        version, base = self._new_version()
        rows = conform(df, self.schema)
        rows = rows.hint("rebalance") if self.by is None else rows.repartitionByRange(self.by).sortWithinPartitions(self.by)
        rows.write.mode("error").parquet(f"{self.root}/data/{version}")
        self._commit(base, version, [""])

    def drop_superseded(self, keep: int = 2) -> None:
        """Empty all but the newest ``keep`` versions."""
        for version in self.versions()[: -max(keep, 1)]:
            self._empty(version)


class PeriodTable(Versions):
    """A table with a ``date`` column kept by month, or other ``unit`` of ``date_trunc``.

    Days are replaced one by one whatever the unit; it only sets how much is rewritten
    around them. Small hourly tables do well with months, large ones with days. Each
    period has its own current version; a write makes new ones for the periods it
    touches and swaps them in together.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, unit: str = "month"):
        super().__init__(spark, root, schema)
        self.unit = unit

    def _period(self, moment: Column) -> Column:
        return F.to_date(F.date_trunc(self.unit, moment))

    def _read(self, parts: dict[str, str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        paths = [f"{self.root}/data/{version}/period={period}" for period, version in sorted(parts.items())]
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        return self._read(self._read_snapshot().parts)

    def read_periods(self, start: dt.date | str, end: dt.date | str) -> DataFrame:
        """All rows of the periods that ``start <= day < end`` touches; other folders are not even listed."""
        bounds = self.spark.sql("VALUES (0)").select(  # folded by the optimizer, no job
            self._period(F.lit(str(start)).cast("timestamp")).cast("string"), F.lit(str(end))
        )
        low, high = bounds.first()
        return self._read({p: v for p, v in self._read_snapshot().parts.items() if low <= p < high})

    def write_periods(self, df: DataFrame) -> None:
        """Make ``df`` the whole content of the periods it has rows of. A row without a date is an error."""
        version, base = self._new_version()
        path = f"{self.root}/data/{version}"
        period = F.coalesce(self._period(F.col("date")), F.raise_error(F.lit("a row without a date")).cast("date"))
        rows = conform(df, self.schema).withColumn("period", period)
        rows.hint("rebalance", F.col("period")).write.mode("error").partitionBy("period").parquet(path)
        files = self.spark.read.schema(self.schema).parquet(path).inputFiles()
        parts = sorted({name.rsplit("/", 2)[1].removeprefix("period=") for name in files})
        if parts:
            self._commit(base, version, parts)

    def replace_days(self, df: DataFrame, start: dt.date | str, end: dt.date | str) -> None:
        """Replace each day that ``df`` has rows of. A row outside ``start <= date < end`` is an error."""
        low, high = (F.lit(str(b)).cast("timestamp") for b in (start, end))
        moment = F.col("date").cast("timestamp")
        outside = F.raise_error(F.concat(F.lit(f"not in {start} to {end}: "), F.coalesce(F.col("date").cast("string"), F.lit("null"))))
        fresh = conform(df.withColumn("date", F.when((moment >= low) & (moment < high), moment).otherwise(outside.cast("timestamp"))), self.schema)
        days = fresh.select(F.to_date("date").alias("_day")).distinct()
        kept = self.read_periods(start, end).withColumn("_day", F.to_date("date")).join(days, "_day", "left_anti")
        self.write_periods(fresh.union(kept.select(self.schema.names)))


def write_csv_by_source(df: DataFrame, root: str) -> None:
    """CSV with a header, one folder per ``source_file``; other sources' files stay.

    Spark would first sort the rows of a task by source. The rows that one input task has of
    a source stay together however many they are, so rows go straight to the file of
    their source; a task with more than ``OPEN_SOURCES`` sorts only what it has after these.
    """
    with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", str(OPEN_SOURCES)):
        (
            df.hint("rebalance", F.col("source_file"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("source_file")
            .options(**CSV_WRITE_OPTIONS)
            .csv(root)
        )


def land_counts(df: DataFrame, raw_root: str, processed_root: str, raw: bool) -> str:
    """Write count files to the raw or the processed area and return where they went."""
    root = raw_root if raw else processed_root
    write_csv_by_source(df, root)
    return root


def write_csv_run(df: DataFrame, root: str, run_ts: str) -> str:
    """CSV of one run, under its own ``run_ts=`` folder; a repeated run replaces its own files."""
    path = f"{root}/run_ts={run_ts}"
    df.hint("rebalance").write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows written by the CSV sinks, in their declared types; also texts with line breaks."""
    return spark.read.schema(schema).options(**CSV_STRICT, multiLine="true").csv(path)


def land_json_run(docs: DataFrame, root: str, run_ts: str) -> str:
    """Raw responses of one run as JSON lines, under its own ``run_ts=`` folder; a repeated run replaces them.

    Line breaks in a JSON text can only be layout, so they become blanks.
    """
    path = f"{root}/run_ts={run_ts}"
    docs.select(F.regexp_replace("body", r"[\r\n]+", " ").alias("value")).write.mode("overwrite").text(path)
    return path


def read_json_runs(spark: SparkSession, path: str) -> DataFrame:
    """Landed responses, one document per row in ``body``."""
    return spark.read.text(path).select(F.col("value").alias("body"))
