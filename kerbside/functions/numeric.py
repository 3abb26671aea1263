"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

KELVIN_OFFSET = 273.15


def round_half_up(value: Column, digits: int = 0) -> Column:
    """Round half away from zero, as a double.

    The value passes through a decimal with six places first. Partial sums of
    doubles reach the final aggregate in any order, and without that step a tie
    such as x.5 would round up or down depending on which task finished first.
    """
    return F.round(value.cast("decimal(28,6)"), digits).cast("double")


def kelvin_to_celsius(value: Column) -> Column:
    return value.cast("double") - F.lit(KELVIN_OFFSET)


def mean_of(total: Column, count: Column) -> Column:
    """Mean from a sum and a count; null where nothing was counted."""
    return total.cast("double") / F.nullif(count, F.lit(0).cast("bigint"))
