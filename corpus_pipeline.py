"""A training corpus from raw documents, in stages, each by an operator of kerbside.llm.

Each stage takes what the one before has written and kept; all but the last
return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import bpe, mixing, pii, similarity, toxicity
from kerbside.llm.frames import stage, table
from kerbside.llm.queries import TOXIC_FROM, VOCABULARY


def toxic_segments(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without toxic passages; learned from the labels that are not held out."""
    labels = table(spark, sf_dir, "labels").where(F.crc32(F.col("doc_id").cast("string")) % 4 != 2)
    return toxicity.reject(docs, toxicity.train(docs, labels), TOXIC_FROM)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return similarity.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs, pii.train(pii.labelled_table()))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply_mix(docs, mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each row of the mix."""
    return bpe.encode(docs, VOCABULARY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxic_segments", toxic_segments),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("tokens", tokens),
]

#: SQL can't express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
