"""Conversations brought back to turns that alternate, at least cost.

A conversation is repaired by a shortest path: rows are kept, given another role,
deleted, and turns without text inserted, until the roles read ``(s?(ua)+)?``. Four
states say what has come so far. The costs from a row to the end are vectors over
these states, made from the end backwards, but only those at checkpoints are
stored; the walk forward makes the vectors between two checkpoints again when it gets there.

A long conversation is cut into blocks, which are the outer checkpoints. A block is
one group of a Spark task: its cost matrix between states is made without its
neighbours, a conversation's matrices are folded from its end, and every block walks for itself.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from kerbside.llm.frames import record_batch, stage
from kerbside.llm.ranks import ranked
from kerbside.llm.similarity import map_groups
from kerbside.session import ship_package

#: Costs of the edits, and what a truncated row that stays adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: States: nothing yet, after s, after u, after a. What a user or an assistant turn leads to, whichever is allowed.
NEXT = (2, 2, 3, 2)
ROLE = ("user", "user", "assistant", "user")
INFINITE = 1 << 60
#: Cheapest ends from each state when no row is left: insert what is missing.
END = (0, 2 * INSERT, INSERT, 0)

#: Rows of a block.
BLOCK = 4096
NOT_BLANK = r"[^\x20\x09-\x0D]"


def _kept(state: int, code: str) -> int:
    """The state after keeping a row as it is, -1 if that is not allowed; upper case codes are truncated rows."""
    role = code.lower()
    if role == "s":
        return 1 if state == 0 else -1
    return NEXT[state] if role == ROLE[state][0] else -1


def back(costs: tuple[int, ...], code: str) -> tuple[int, ...]:
    """Costs from before a row, given those after it. ``d`` is a row that must go."""
    new = []
    for state in range(4):
        best = DELETE + costs[state]
        if code != "d":
            to = _kept(state, code)
            stays = min(costs[to] if to >= 0 else INFINITE, REROLE + costs[NEXT[state]])
            best = min(best, stays + (TRUNCATED if code.isupper() else 0))
        new.append(best)
    for _ in range(2):  # inserted turns before the row: two lead back to where they began
        new = [min(new[s], INSERT + new[NEXT[s]]) for s in range(4)]
    return tuple(new)


def matrix(codes: str) -> list[tuple[int, ...]]:
    """For each state after the rows, the least cost to get there from each state before them."""
    out = []
    for after in range(4):
        costs = tuple(0 if s == after else INFINITE for s in range(4))
        for code in reversed(codes):
            costs = back(costs, code)
        out.append(costs)
    return out


def walk(codes: str, end: tuple[int, ...], state: int, last: bool) -> tuple[str, int]:
    """The cheapest edits from ``state`` through the rows, the ASCII-least of them, and the state after.

    ``end`` are the costs from after the rows. Vectors are stored at every ``step`` rows, about the
    square root of their number; those between are made when the walk gets there.
    """
    n = len(codes)
    step = max(1, math.isqrt(n))
    stored, costs = {n: end}, end
    for i in range(n - 1, -1, -1):
        costs = back(costs, codes[i])
        if i % step == 0:
            stored[i] = costs
    audit: list[str] = []
    for begin in range(0, n, step):
        stop = min(begin + step, n)
        inner = [stored[stop]]
        for i in range(stop - 1, begin - 1, -1):
            inner.append(back(inner[-1], codes[i]))
        inner.reverse()
        i = begin
        while i < stop:
            code, now, after = codes[i], inner[i - begin][state], inner[i - begin + 1]
            if now == DELETE + after[state]:
                edit = "D"
            elif now == INSERT + inner[i - begin][NEXT[state]]:
                audit.append("I")
                state = NEXT[state]
                continue
            else:
                to = _kept(state, code)
                edit = "K" if to >= 0 and now == (TRUNCATED if code.isupper() else 0) + after[to] else "R"
                state = to if edit == "K" else NEXT[state]
            audit.append(edit)
            i += 1
    while last and END[state]:
        audit.append("I")
        state = NEXT[state]
    return "".join(audit), state


def repaired(audit: str, state: int, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """Roles and texts after the edits, one after the other."""
    rows = iter(rows)
    for edit in audit:
        if edit == "I":
            yield ROLE[state], ""
            state = NEXT[state]
            continue
        role, text = next(rows)
        if edit == "K":
            yield role, text
            state = _kept(state, role[0])
        elif edit == "R":
            yield ROLE[state], text
            state = NEXT[state]


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copy after the damage a hash of each row's place says; nulls are one space."""
    space = F.lit(" ")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    place = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(place) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, r"[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(role)
    copies = F.when(kind == 0, F.array().cast("array<int>")).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def _matrices(key: tuple, rows: list[tuple]) -> Iterable[tuple]:
    codes = "".join(code for _, code in sorted(rows))
    yield *key, codes, [c for costs in matrix(codes) for c in costs]


def _checkpoints(key: tuple, rows: list[tuple]) -> Iterable[tuple]:
    """Costs after each block of a conversation, from the last to the first; and then the state before each."""
    costs, out = END, []
    for block, _, flat in sorted(rows, reverse=True):
        out.append((*key, block, list(costs)))
        costs = tuple(min(flat[4 * after + s] + costs[after] for after in range(4)) for s in range(4))
    for row in out:
        yield *row, costs[0], row[1] == out[0][1]


def _walks(key: tuple, rows: list[tuple]) -> Iterable[tuple]:
    for codes, costs, total, last in rows:
        for state in range(4) if key[1] else (0,):
            yield *key, state, *walk(codes, tuple(costs), state, last), total


def _chain(key: tuple, rows: list[tuple]) -> Iterable[tuple]:
    """Of each block the walk that begins where the one before ended."""
    found = {(block, state): (audit, after, total) for block, state, audit, after, total in rows}
    state = 0
    for block in range(1 + max(b for b, _ in found)):
        audit, after, total = found[block, state]
        yield *key, block, state, audit, total
        state = after


def _hashes(frame: DataFrame, schema: str) -> DataFrame:
    """conv_id and repaired_sha256 of sorted rows, read as a stream: a block's edits come before its rows."""
    ship_package(frame.sparkSession)
    kind = StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, begun, out = None, None, False, []
        edits: str = ""
        state, texts = 0, []

        def flush():
            nonlocal begun, texts
            for role, text in repaired(edits, state, texts):
                if begun:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
                begun = True
            texts = []

        for batch in batches:
            for conv_id, _, audit, before, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if audit is None:
                    texts.append((role, text))
                    continue
                if digest is not None:
                    flush()
                if digest is None or conv_id != conv:
                    if digest is not None:
                        out.append((conv, digest.hexdigest()))
                    conv, digest, begun = conv_id, hashlib.sha256(), False
                edits, state = audit, before
            if len(out) >= 1000:
                yield record_batch(out, arrow)
                out = []
        if digest is not None:
            flush()
            out.append((conv, digest.hexdigest()))
        if out:
            yield record_batch(out, arrow)

    return frame.mapInArrow(run, kind)


def repair(rows: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """What is wrong with each conversation, the cheapest repair and its digest.

    ``rows`` has conv_id, turn, role, text and copy (as ``damage`` gives them, without nulls in role and text).
    The result has one row for each conv_id of ``conversations``: gaps, blank, duplicate, truncated, illegal, cost,
    audit (edits' initials D, I, K, R in order) and repaired_sha256. Rows are taken by turn, nulls
    first; rows of one turn by role and digest of the text, equal ones as counted. Rows of a null conv_id are one conversation. Without rows counts
    are 0, the audit is empty. A role is read by its initial; one that is not s, u or a cannot be kept.

    Rows of a conversation are numbered across tasks and dealt in blocks of ``block``, so no task holds a
    conversation's texts: repeated rows are found by their role and text, and the digest is read as a stream.
    What one task has of a conversation is a few numbers for each block, and its audit, which is one value of
    the result. Other columns are not read.
    """
    kind = conversations.schema["conv_id"].dataType.simpleString()
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first(), "copy")
    blank = ~F.col("text").rlike(NOT_BLANK)
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = F.when(blank, 1).when(F.col("seen") > 1, 2).when(cut, 3).otherwise(0)
    seen = rows.select("conv_id", "turn", "role", "text", F.row_number().over(earlier).alias("seen"), F.sha2("text", 256).alias("sha"))
    placed = ranked(seen.withColumn("fault", fault), ["conv_id"], ["turn", "role", "sha", "seen"], "repair-rows")
    initial = F.substr("role", F.lit(1), F.lit(1))
    kept = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    code = F.when(F.col("fault").isin(1, 2), "d").when(F.col("fault") == 3, F.upper(kept)).otherwise(kept)
    numbered = F.floor(F.col("pos") / F.lit(block)).cast("int").alias("block")
    slim = placed.select("conv_id", numbered, "pos", code.alias("code"))

    blocks = map_groups(slim, ["conv_id", "block"], _matrices, f"conv_id {kind}, block int, codes string, costs array<bigint>")
    blocks = stage(blocks, "repair-blocks")
    ends = map_groups(
        blocks, ["conv_id"], _checkpoints, f"conv_id {kind}, block int, costs array<bigint>, total long, last boolean"
    ).withColumnsRenamed({"conv_id": "__conv", "block": "__block"})
    same = F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("block") == F.col("__block"))
    open_blocks = blocks.select("conv_id", "block", "codes").join(ends, same).select("conv_id", "block", "codes", "costs", "total", "last")
    walks = map_groups(
        open_blocks, ["conv_id", "block"], _walks, f"conv_id {kind}, block int, state int, audit string, after int, total long"
    )
    walked = stage(
        map_groups(walks, ["conv_id"], _chain, f"conv_id {kind}, block int, state int, audit string, total long"), "repair-walks"
    )

    nothing = F.lit(None)
    edits = walked.select(
        "conv_id", (F.col("block").cast("long") * block).alias("pos"), "audit", "state",
        nothing.cast("string").alias("role"), nothing.cast("string").alias("text"),
    )
    texts = placed.select("conv_id", "pos", nothing.cast("string").alias("audit"), nothing.cast("int").alias("state"), "role", "text")
    stream = edits.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "pos", F.col("audit").asc_nulls_last())
    digests = _hashes(stream, f"conv_id {kind}, repaired_sha256 string").withColumnRenamed("conv_id", "__conv")

    found = placed.groupBy("conv_id").agg(
        F.min("turn").alias("low"), F.max("turn").alias("high"),
        *(F.sum((F.col("fault") == i).cast("long")).alias(n) for i, n in ((1, "blank"), (2, "duplicate"), (3, "truncated"))),
    )
    turns = placed.where(F.col("turn").isNotNull()).select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.count(F.lit(1)).alias("turns"))
    pair = F.concat(initial, F.lead(initial).over(Window.partitionBy("conv_id", "block").orderBy("pos")))
    inner = placed.select("conv_id", "pos", "role", numbered).withColumn("pair", pair)
    # the last row of a block meets the first of the next by their numbers
    edges = placed.where((F.col("pos") % block).isin(0, block - 1)).select(
        "conv_id", F.floor((F.col("pos") + 1) / F.lit(block)).alias("edge"), (F.col("pos") % block == 0).alias("right"), initial.alias("initial")
    )
    edges = edges.where("edge > 0").groupBy("conv_id", "edge").agg(
        F.concat(F.max(F.when(~F.col("right"), F.col("initial"))), F.max(F.when(F.col("right"), F.col("initial")))).alias("pair")
    )
    pairs = inner.select("conv_id", "pair").unionByName(edges.select("conv_id", "pair"))
    illegal = pairs.where(F.col("pair").isNotNull() & ~F.col("pair").isin("su", "ua", "au")).groupBy("conv_id").agg(F.count(F.lit(1)).alias("illegal"))
    audits = walked.groupBy("conv_id").agg(
        F.max("total").alias("cost"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit")
    )

    out = conversations.select("conv_id").distinct()
    for part in (found, turns, illegal, audits, digests):
        own = part if "__conv" in part.columns else part.withColumnRenamed("conv_id", "__conv")
        out = out.join(own, F.col("conv_id").eqNullSafe(F.col("__conv")), "left").drop("__conv")
    zero = F.lit(0).cast("long")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), zero)
    counts = [F.coalesce(n, zero).cast("long").alias(n) for n in ("blank", "duplicate", "truncated", "illegal", "cost")]
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id", gaps.cast("long").alias("gaps"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
