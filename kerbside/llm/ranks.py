"""Consecutive numbers of rows within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.frames import stage


def ranked(frame: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """The rows with ``pos``, their place (from 0) in their group, and ``n``, the group's rows; staged.

    Rows are dealt by ranges of group and order, nulls first, and numbered within each partition; a
    group's place in a partition follows from the counts of those before. So a group of any
    size is many tasks, and what meets in a window is one row for each group and partition.
    Rows that are equal in group and order should be equal in all columns.
    """
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    at = F.monotonically_increasing_id()
    dealt = frame.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__at", at)
    dealt = dealt.withColumns({"__part": F.shiftright("__at", 33), "__at": F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))})
    dealt = stage(dealt, name)
    counts = dealt.groupBy(*group, "__part").agg(F.min("__at").alias("first"), F.count(F.lit(1)).alias("c"))
    own = Window.partitionBy(*group)
    before = F.coalesce(F.sum("c").over(own.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(
        *(F.col(c).alias(f"__{c}") for c in group), F.col("__part").alias("__of"),
        (before - F.col("first")).alias("__shift"), F.sum("c").over(own).alias("n"),
    )
    same = F.col("__part") == F.col("__of")
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return dealt.join(counts, same).select(*frame.columns, (F.col("__at") + F.col("__shift")).alias("pos"), "n")
