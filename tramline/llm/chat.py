"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all preceding turns are its context and only that
reply is trainable. What follows the last reply (or a conversation without one) becomes one last
example without a target, so that no turn is lost.

A turn is written as ``<|start|>role<|message|>text<|end|>``. Inside roles and texts a backslash is put
after every ``<``, ``[`` and backslash, which breaks up every control string (``<|end|>``, ``</s>``,
``[INST]``) and is undone by dropping it again.

Defined cases: null roles and texts are empty strings; turns are ordered by (turn, role, text), nulls
first, so repeated rows and ties have one order; rows of a null conversation id form one conversation;
an empty table gives no rows; further columns are ignored. A conversation is one row, as its last
example holds all of it anyway; examples are cut out of that row one at a time and never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, MESSAGE, END = "<|start|>", "<|message|>", "<|end|>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def formatted_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit(MESSAGE), text, F.lit(END))


def conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its formatted text and where each turn lies in it.

    ``spans``: role, start and end (code points, from 0) of the turn, and of its text.
    """
    said = turns.select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("r"), F.coalesce(F.col(text), F.lit("")).alias("t"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "r", "t").rowsBetween(Window.unboundedPreceding, 0)
    size = F.length("role") + F.length("text") + len(START) + len(MESSAGE) + len(END)
    laid = (
        said.select("conv_id", "turn", "r", "t", escaped(F.col("r")).alias("role"), escaped(F.col("t")).alias("text"))
        .withColumn("size", size)
        .select("conv_id", "role", "text", "size", F.sum("size").over(order).cast("int").alias("end"))
    )
    rows = laid.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("end", "size", "role", "text"))).alias("said"))
    return rows.select(
        "conv_id",
        F.array_join(F.transform("said", lambda t: formatted_turn(t.role, t.text)), "").alias("formatted"),
        F.transform("said", lambda t: F.struct(
            t.role.alias("role"), (t.end - t.size).alias("start"), (t.end - len(END) - F.length(t.text)).alias("text_start"),
            (t.end - len(END)).alias("text_end"), t.end.alias("end"))).alias("spans"),
    )


def examples(turns: DataFrame, target: str = "assistant", **columns: str) -> DataFrame:
    """One row per example: conv_id, example (from 0), text, loss (array of start, end; code points), is_last.

    ``loss`` holds the one trainable span, the reply without its markers, or nothing.
    """
    whole = conversations(turns, **columns)
    count = F.size("spans")
    replies = F.filter(
        F.transform("spans", lambda s, i: F.struct(
            s["end"].alias("end"), (i + 1 == count).alias("is_last"),
            F.when(s["role"] == target, F.array(F.struct(s["text_start"].alias("start"), s["text_end"].alias("end")))).alias("loss"))),
        lambda e: e["loss"].isNotNull() | e["is_last"],
    )
    out = whole.select("conv_id", "formatted", F.posexplode(replies).alias("example", "cut"))
    no_span = F.array().cast("array<struct<start:int,end:int>>")
    return out.select(
        "conv_id", "example", F.substring("formatted", F.lit(1), F.col("cut.end")).alias("text"),
        F.coalesce("cut.loss", no_span).alias("loss"), F.col("cut.is_last").alias("is_last"),
    )


def parsed(text: Column) -> Column:
    """The turns of a formatted text, read back: array of role, text."""
    turns = F.filter(F.split(text, r"<\|end\|>"), lambda t: t != "")
    body = F.transform(turns, lambda t: F.split(F.substring(t, F.lit(len(START) + 1), F.length(t)), r"<\|message\|>"))
    return F.transform(body, lambda p: F.struct(unescaped(p[0]).alias("role"), unescaped(p[1]).alias("text")))


def trained(text: Column, loss: Column) -> Column:
    """All text under the loss mask, read back."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(text, s["start"] + 1, s["end"] - s["start"]))), "")


def digests(made: DataFrame) -> DataFrame:
    """Per conversation what its examples say when they are read back.

    Only what the digests need leaves an example's row: the reply it trains, and from the last example,
    which holds the whole conversation, the turns.
    """
    turns = F.when(F.col("is_last"), parsed(F.col("text")))
    read = made.select(
        "conv_id", "example", F.length("text").cast("bigint").alias("chars"), trained(F.col("text"), F.col("loss")).alias("reply"),
        F.size(turns).cast("bigint").alias("n"),
        F.sha2(F.array_join(F.transform(turns, lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "").cast("binary"), 256).alias("sha"),
        F.col("is_last"),
    )
    replies = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "reply"))), lambda r: r.reply), "")
    return (
        read.groupBy("conv_id")
        .agg(
            F.max(F.when(F.col("is_last"), F.col("n"))).alias("n_turns"), F.max(F.when(F.col("is_last"), F.col("sha"))).alias("turns_sha256"),
            replies.alias("trained"), F.sum("chars").alias("formatted_chars"), F.count(F.lit(1)).alias("n_examples"),
        )
        .select(
            "conv_id", "n_turns", "turns_sha256", F.length("trained").cast("bigint").alias("loss_chars"),
            F.sha2(F.col("trained").cast("binary"), 256).alias("loss_sha256"), "formatted_chars", "n_examples",
        )
    )
