"""Session settings the jobs rely on, and where they may stage data."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Timestamps are stored and compared in UTC.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # text that does not fit its type is an error, never a null
    "spark.sql.ansi.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Put the job settings on an existing session."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the length of a block, afterwards as it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the session's own ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster a
    machine-local path would be lost with its executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="kerbside-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def staging_path(spark: SparkSession, name: str) -> str:
    """A new path below the staging root."""
    return f"{staging_root(spark)}/kerbside/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers, once for each application.

    Workers import the functions that tasks run by their module; they need not
    have the package on their own path.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="kerbside-package-")
    archive = shutil.make_archive(f"{folder}/kerbside-package", "zip", os.path.dirname(package), os.path.basename(package))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
