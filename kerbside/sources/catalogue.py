"""Catalogue documents that list the downloadable count files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

CATALOGUE_TYPE = "resources map<string, struct<format: string, url: string>>"

# Files that hold no counts, as named in the catalogue.
EXCLUDED_FILES = ["Christmas%20analysis.csv"]
# The same under the names that landed files have.
EXCLUDED_SOURCES = [*EXCLUDED_FILES, *(name.replace("%20", "_") for name in EXCLUDED_FILES)]


def csv_files(docs: DataFrame, exclude: Sequence[str] = EXCLUDED_FILES) -> DataFrame:
    """CSV files of each catalogue: ``(doc_id, file_name, resource_id, url)``.

    ``docs`` holds ``doc_id`` and the document text ``body``. Excluded names are
    compared as they stand in the address, before ``%20`` becomes an underscore.
    Of two files with one name the later in the document counts. A broken document is an error.
    """
    entries = (
        docs.select("doc_id", F.from_json("body", CATALOGUE_TYPE, {"mode": "FAILFAST"}).alias("doc"))
        .select("doc_id", F.posexplode(F.map_entries("doc.resources")).alias("place", "entry"))
        .select(
            "doc_id",
            "place",
            F.col("entry.key").alias("resource_id"),
            F.col("entry.value.format").alias("format"),
            F.col("entry.value.url").alias("url"),
        )
    )
    named = (
        entries.filter(F.col("format") == "csv")
        .withColumn("address_name", F.element_at(F.split("url", "/"), -1))
        .filter(~F.col("address_name").isin(list(exclude)))
        .withColumn("file_name", F.replace("address_name", F.lit("%20"), F.lit("_")))
    )
    last = F.max_by(F.struct("resource_id", "url"), "place").alias("last")
    return named.groupBy("doc_id", "file_name").agg(last).select("doc_id", "file_name", "last.*")
