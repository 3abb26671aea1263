"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.frames import n_words, stage
from kerbside.session import ship_package

PLAN = (
    "doc_id long, row_hash long, source string, source_no long, size long, source_size long, target double, "
    "whole int, part double, cell long"
)

#: A row taken more often is dealt out in blocks.
MOST_COPIES = 1_000


def source_targets(totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """One row for each source: source, source_no, n_docs, source_size, target.

    ``totals`` has source, size (the sum of the words of some documents) and rows (their number).
    Sources in code point order, null last, take the weights in turn and share
    the sum of all sizes by weight. No target may exceed ``most`` times its
    source's size; what a capped source can't take goes to the others by weight.
    In order of size a weight, the capped sources come first: source k is capped
    if its cap a weight lies below what is left a weight. The windows below see
    one row for each source, never documents.
    """
    sources = totals.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("rows").alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    by_room = Window.orderBy("room", "source_no").rowsBetween(Window.unboundedPreceding, -1)
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    cap = F.col("source_size") * F.lit(most)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(by_room), F.lit(0.0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(by_room), F.lit(0.0))
    return (
        sources.withColumn("source_no", F.row_number().over(by_name).cast("long") - 1)
        .withColumn("weight", F.element_at(cycle, (F.col("source_no") % len(weights) + 1).cast("int")))
        .withColumn("room", cap / F.col("weight"))
        .withColumn("share", left / left_weight)
        .withColumn("capped", F.col("room") < F.col("share"))
        # the first uncapped source sees exactly what the capped ones leave
        .withColumn("final_share", F.min(F.when(~F.col("capped"), F.struct("room", "source_no", "share"))).over(everything)["share"])
        .withColumn("target", F.when(F.col("capped"), cap).otherwise(F.least(cap, F.col("weight") * F.col("final_share"))))
        .select("source", "source_no", "n_docs", "source_size", "target")
    )


def pivotal(parts: np.ndarray, sizes: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Round fractions so that the sum of size times fraction stays as it is.

    Two open fractions at a time: mass moves from one to the other, in words,
    until one of them is 0 or 1; which way is random, with the odds that leave
    both expectations as they were. One fraction at most stays open.
    """
    p, held, draws = parts.astype(float).tolist(), -1, random.random(len(parts)).tolist()
    w = sizes.astype(float).tolist()
    for i in range(len(p)):
        if not 0.0 < p[i] < 1.0:
            continue
        if held < 0:
            held = i
            continue
        j, ratio = held, w[held] / w[i]
        up, down = min(1.0 - p[i], p[j] * ratio), min(p[i], (1.0 - p[j]) * ratio)
        if draws[i] * (up + down) < down:  # i rises
            if 1.0 - p[i] <= p[j] * ratio:
                p[j], p[i] = p[j] - (1.0 - p[i]) / ratio, 1.0
            else:
                p[i], p[j] = p[i] + p[j] * ratio, 0.0
        elif p[i] <= (1.0 - p[j]) * ratio:
            p[j], p[i] = p[j] + p[i] / ratio, 0.0
        else:
            p[i], p[j] = p[i] - (1.0 - p[j]) * ratio, 1.0
        for k in (i, j):
            if p[k] < 1e-12 or p[k] > 1.0 - 1e-12:
                p[k] = float(round(p[k]))
        held = i if 0.0 < p[i] < 1.0 else j if 0.0 < p[j] < 1.0 else -1
    return np.array(p)


def _round_cell(seed: int, level: int, last: bool):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "row_hash"], na_position="last", kind="stable").reset_index(drop=True)
        name = f"{seed}:{level}:{key[0]}:{key[1]}".encode()
        random = np.random.Generator(np.random.PCG64(int.from_bytes(hashlib.sha256(name).digest()[:8], "big")))
        parts = pivotal(rows["part"].to_numpy(), rows["size"].to_numpy(), random)
        if last:  # one document of the source is left open at most
            parts = np.where((parts > 0) & (parts < 1), (random.random(len(parts)) < parts).astype(float), parts)
        rows["part"] = parts
        return rows

    return run


def _several(rows: DataFrame, count: str, number: str, most: int = 1_000) -> DataFrame:
    """Each row as often as ``count`` says, numbered from 0: blocks of ``most`` are dealt out before they are written out."""
    spark = rows.sparkSession
    blocks = rows.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / most))))
    dealt = blocks.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("row_hash", "__block"))
    first = F.col("__block") * most
    last = F.least(first + most, F.col(count)) - 1
    return dealt.withColumn(number, F.explode(F.sequence(first, last))).drop("__block")


def mix(
    documents: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    most: float = 3.0,
    seed: int = 20,
    cell_rows: int = 2_000,
    fan_in: int = 1_000,
) -> DataFrame:
    """How many copies of each document a mix takes.

    One row for each row of ``documents``: doc_id, row_hash (of all columns),
    source, size (words of the text; null: 0), source_size, target, copies and
    taken (copies times size). A document's expected copies are target over
    source size; the whole part is taken as it is and the fraction is rounded.

    The fractions of a source are rounded in cells of about ``cell_rows``
    documents, dealt by a hash, so that a source with much of the data is many
    tasks. A cell leaves one open fraction at most; ``fan_in`` such residuals
    meet in a cell of the next level until each source has one cell. Draws
    depend on the cell and the order of doc_id alone: reruns agree. Wholly equal
    rows are counted first and dealt by their number, so they don't meet in one cell.

    Texts without words have no share and no copies. Repeated rows count
    each for itself. A null source is a source. Empty tables give no rows;
    other columns only enter row_hash.
    """
    spark = documents.sparkSession
    ship_package(spark)
    sized = documents.select(
        "doc_id", F.xxhash64(*(F.col(f"`{c}`") for c in sorted(documents.columns))).alias("row_hash"), "source", n_words().alias("size")
    )
    equal = sized.groupBy("doc_id", "row_hash", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    equal = stage(equal, "mix-sizes")
    once = equal.where("rows = 1").drop("rows").withColumn("number", F.lit(0).cast("long"))
    sized = once.unionByName(_several(equal.where("rows > 1"), "rows", "number").drop("rows"))
    totals = equal.select("source", (F.col("size") * F.col("rows")).alias("size"), "rows")
    targets = source_targets(totals, weights, most)
    own = F.xxhash64(F.lit(seed), "doc_id", "row_hash")
    cells = F.ceil(F.col("n_docs") / F.lit(cell_rows))
    expected = F.when(F.col("source_size") > 0, F.least(F.lit(most), F.col("target") / F.col("source_size"))).otherwise(0.0)
    rows = (
        sized.join(targets.withColumnRenamed("source", "named"), F.col("source").eqNullSafe(F.col("named")))
        .withColumn("expected", F.when(F.col("size") > 0, expected).otherwise(0.0))
        .withColumn("whole", F.floor("expected").cast("int"))
        .withColumn("part", F.col("expected") - F.col("whole"))
        .withColumn("cell", F.pmod(F.when(F.col("number") == 0, own).otherwise(F.xxhash64(own, "number")), cells))
        .select("doc_id", "row_hash", "source", "source_no", "size", "source_size", "target", "whole", "part", "cell")
    )
    open_part = (F.col("part") > 0) & (F.col("part") < 1)
    done = [rows.where(~open_part)]
    top = targets.agg(F.max("n_docs")).first()[0] or 0
    n_cells, level = -(-top // cell_rows), 0
    rows = rows.where(open_part)
    while True:
        last = n_cells <= 1
        rounded = stage(rows.groupBy("source_no", "cell").applyInPandas(_round_cell(seed, level, last), PLAN), f"mix-level{level}")
        if last:
            done.append(rounded)
            break
        done.append(rounded.where(~open_part))
        rows = rounded.where(open_part).withColumn("cell", F.floor(F.col("cell") / fan_in))
        n_cells, level = -(-n_cells // fan_in), level + 1
    plan = done[0]
    for more in done[1:]:
        plan = plan.unionByName(more)
    return (
        plan.withColumn("copies", (F.col("whole") + F.col("part")).cast("int"))
        .withColumn("taken", F.col("copies") * F.col("size"))
        .select("doc_id", "row_hash", "source", "size", "source_size", "target", "copies", "taken")
    )


def apply_mix(documents: DataFrame, plan: DataFrame) -> DataFrame:
    """The documents as often as the plan says; equal rows add up their copies.

    Equal rows become one before the shuffle and are written out again in
    blocks, so neither meets in one task.
    """
    columns = documents.columns
    # a struct, so that null ids are equal and the join uses the grouping's shuffle
    key = lambda row_hash: F.struct(F.col("doc_id").alias("doc_id"), row_hash.alias("row_hash"))
    hashed = documents.withColumn("__key", key(F.xxhash64(*(F.col(f"`{c}`") for c in sorted(columns))))).dropDuplicates(["__key"])
    wanted = plan.groupBy(key(F.col("row_hash")).alias("__key")).agg(F.sum("copies").alias("__copies")).where(F.col("__copies") > 0)
    few = hashed.join(wanted.where(F.col("__copies") <= MOST_COPIES), "__key")
    few = few.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
    many = hashed.join(wanted.where(F.col("__copies") > MOST_COPIES), "__key")
    many = _several(many.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), "__copies", F.col("__key.row_hash")), "__copies", "__copy")
    return few.select(*(F.col(f"`{c}`") for c in columns)).unionByName(many.select("row.*"))
