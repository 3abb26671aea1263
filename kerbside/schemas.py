"""Declared table schemas and the cast that puts a frame into one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, dtype()) for name, dtype in columns.items()])


# Table layouts that downstream users query by name.
FOOTFALL = _schema(
    city=StringType,
    footfall_location=StringType,
    timestamp=TimestampType,
    total_footfall=LongType,
)

WEATHER_HISTORY = _schema(
    city=StringType,
    date=TimestampType,
    temp=DoubleType,
    pressure=LongType,
    humidity=LongType,
    clouds=LongType,
    wind=DoubleType,
    rain=DoubleType,
    snow=DoubleType,
)

FORECASTS = _schema(
    city=StringType,
    date=DateType,
    min_temp=DoubleType,
    max_temp=DoubleType,
    pressure=LongType,
    humidity=LongType,
    clouds=LongType,
    wind=DoubleType,
    rain=DoubleType,
    snow=DoubleType,
)

HOLIDAYS = _schema(date=DateType, name=StringType)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Select the declared columns in order, each cast to its declared type."""
    return df.select([F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
