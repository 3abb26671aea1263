"""Prefix-target expansion of conversations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The template. A turn is OPEN, the role, CLOSE_ROLE, the text, END. Neither roles
#: nor texts can hold "<" once they are escaped, nor can a role hold ">".
OPEN, CLOSE_ROLE, END = "<turn ", ">", "</turn>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"))


def escape(text: Column) -> Column:
    for plain, code in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def expand(conversations: DataFrame) -> DataFrame:
    """One training example for each assistant turn, with all turns before it as context.

    Columns: conv_id, example_no (from 0), n_turns, text, loss_start, loss_chars.
    ``text`` is the formatted prefix, ending with the reply; the loss mask is one
    range of it, the reply's text between its marks (in characters, from 0).
    Turns after the last reply form one more row, with all turns as context and
    an empty mask, so a reader finds every turn of the conversation.

    Rows are put in order of turn, role and text, nulls first; repeated turns
    all stay. Null roles and texts are empty ones, a null conv_id is an id. A row's size is that
    of its prefix, as the task asks: an n-turn conversation gives text that
    grows with n squared. Empty tables give no rows; other columns are ignored.
    """
    turns = conversations.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("turn")
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    head = lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(CLOSE_ROLE))
    formatted = whole.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(head(t), escape(t["text"]), F.lit(END))).alias("parts"),
        F.transform("turns", lambda t: F.length(escape(t["text"]))).alias("lengths"),
        F.transform("turns", lambda t: t["role"] == "assistant").alias("replies"),
    )
    numbers = F.sequence(F.lit(1), F.size("replies"))
    ends = F.filter(numbers, lambda i: F.element_at("replies", i) | (i == F.size("replies")))
    examples = formatted.select("*", F.posexplode(ends).alias("example_no", "n_turns"))
    loss = F.when(F.element_at("replies", F.col("n_turns")), F.element_at("lengths", F.col("n_turns"))).otherwise(0)
    return examples.select(
        "conv_id",
        F.col("example_no").cast("long").alias("example_no"),
        F.col("n_turns").cast("long").alias("n_turns"),
        F.array_join(F.slice("parts", F.lit(1), F.col("n_turns")), "").alias("text"),
        loss.cast("long").alias("loss_chars"),
    ).select(
        "conv_id",
        "example_no",
        "n_turns",
        "text",
        F.when(F.col("loss_chars") > 0, F.length("text") - len(END) - F.col("loss_chars")).otherwise(0).cast("long").alias("loss_start"),
        "loss_chars",
    )


def read_back(text: Column) -> Column:
    """The turns of a formatted text: an array of role and text, unescaped."""
    parts = F.split(text, END, -1)
    parts = F.slice(parts, F.lit(1), F.size(parts) - 1)
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape(F.substring(F.substring_index(p, CLOSE_ROLE, 1), len(OPEN) + 1, 2**31 - 1)).alias("role"),
            unescape(p.substr(F.locate(CLOSE_ROLE, p) + 1, F.lit(2**31 - 1))).alias("text"),
        ),
    )


def loss_text(text: Column, start: Column, chars: Column) -> Column:
    """What the loss mask covers, unescaped."""
    return unescape(text.substr((start + 1).cast("int"), chars.cast("int")))


def digest(examples: DataFrame) -> DataFrame:
    """What the formatted examples hold, read back from them: one row for each conversation.

    The examples of a conversation lie together, as ``expand`` makes them, and
    its longest one holds all turns.
    """
    turns = read_back(F.col("text"))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    last = F.col("example_no") == F.max("example_no").over(Window.partitionBy("conv_id"))
    rows = examples.select(
        "conv_id",
        "example_no",
        F.when(last, turns).alias("turns"),
        loss_text(F.col("text"), F.col("loss_start"), F.col("loss_chars")).alias("loss"),
        F.length("text").cast("long").alias("chars"),
    ).select(
        "conv_id",
        "example_no",
        "loss",
        "chars",
        F.size("turns").cast("long").alias("n"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
    )
    losses = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example_no", "loss"))), lambda x: x["loss"]), "")
    return (
        rows.groupBy("conv_id")
        .agg(
            F.max("n").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            losses.alias("loss"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
