"""Column choice by name, made from the schema before any row is read."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from kerbside.functions.text import quoted


def drop_nameless(df: DataFrame) -> DataFrame:
    """Drop columns that had no header: ``Unnamed: 3`` and Spark's own ``_c3``."""
    nameless = [c for c in df.columns if re.search("unnamed", c, re.I) or re.fullmatch(r"_c\d+", c)]
    return df.drop(*nameless)


def preferred_name(columns: Sequence[str], preferences: Sequence[str]) -> str:
    """First preferred name that exists; the values in it play no part."""
    for name in preferences:
        if name in columns:
            return name
    raise ValueError(f"none of {list(preferences)} among {list(columns)}")


def with_preferred(df: DataFrame, preferences: Sequence[str], new_name: str) -> DataFrame:
    """Copy the first existing preferred column to ``new_name``."""
    return df.withColumn(new_name, F.col(f"`{preferred_name(df.columns, preferences)}`"))


def drop_rows_with_null(df: DataFrame) -> DataFrame:
    """Rows with a value in every column; names may hold dots, as repeated CSV headers do."""
    return df.filter(" AND ".join(f"{quoted(c)} IS NOT NULL" for c in df.columns))
