"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, and joined to one string:

    <|im_start|>user            a header opens a run of turns with one role
    first text<|im_sep|>second  adjacent turns of that role share it
    <|im_end|>                  and one end

Inside roles and texts ``&`` becomes ``&amp;`` and ``<|`` becomes ``&lt;|``, inside roles a
line break ``&#10;``, so no control string can come from them and both are read back as
they were. The string is made of
segments, each under the loss mask or not; the texts of assistants are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>\n"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&#10;"), F.lit("\n")))


def chat_format(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, segments): the conversation as an array of (s, loss); the segments one after
    the other are the formatted string.

    Turns are ordered by number, a null number first, ties by role and text; repeated rows
    are turns of their own. Null roles and texts are empty. A null conversation is one
    like any other; no rows give no conversations. Other columns are left out.
    """
    rows = turns.select(
        F.col(conv).alias("conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Where runs of one role begin: each turn sees the one before it, so the fold over the
    # turns stays linear in the conversation's length.
    before = F.concat(F.array(F.lit(None).cast("string")), F.col("turns.role"))
    last = F.size("turns") - 1

    def segment(t: Column, i: Column) -> Column:
        opens = F.when(t.role.eqNullSafe(F.col("before")[i]), F.lit(SEP)).otherwise(
            F.concat(F.when(i == 0, "").otherwise(F.lit(END)), F.lit(START), escape_role(t.role), F.lit("\n"))
        )
        return F.array(
            F.struct(opens.alias("s"), F.lit(False).alias("loss")),
            F.struct(escape(t.text).alias("s"), (t.role == LEARNED).alias("loss")),
            F.struct(F.when(i == last, F.lit(END)).otherwise("").alias("s"), F.lit(False).alias("loss")),
        )

    parts = F.flatten(F.transform("turns", segment))
    return (
        sorted_turns.withColumn("before", before)
        .select(F.col("conv").alias(conv), F.filter(parts, lambda p: (p.s != "") | p.loss).alias("segments"))
    )


def formatted(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda p: p.s), "")


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda p: p.loss), lambda p: unescape(p.s)), "")


def read_back(text: Column) -> Column:
    """The turns of a formatted string as an array of (role, text)."""
    runs = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda r: r != "")

    def turns(run: Column) -> Column:
        body = F.substring(run, F.lit(len(START) + 1), F.length(run))
        at = F.instr(body, "\n")
        role = F.substring(body, F.lit(1), at - 1)
        texts = F.split(F.substring(body, at + 1, F.length(body)), r"<\|im_sep\|>")
        return F.transform(texts, lambda t: F.struct(unescape_role(role).alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(runs, turns))
