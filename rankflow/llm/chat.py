"""Chat formatting with prefix-target expansion, in DataFrame functions only.

A turn is written as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control strings
inside a text are escaped reversibly: a backslash is doubled, then ``<|``
becomes ``<\\|``, so neither marker can occur in a formatted text.  Roles are
percent-encoded.

Every assistant turn becomes one example: the context is the formatted text
of all turns before it, the target its own reply, and only the reply (without
its end marker) is trainable.  The formatted turns are stored once, each with
the position at which it starts in its conversation; an example names its
context by length (``context_chars``) and carries its target and loss span.
So this table stays linear in the input; ``render`` expands chosen examples,
or all of them, to their whole texts, which repeat the prefixes and grow with
the square of a conversation's turns.

Scale: one shuffle by conversation; positions are a running sum in a window
that streams and spills, so a conversation of a third of all rows is not
gathered in memory.

Defined cases: a null text or role is empty; turns are ordered by turn (null
first), then role and text, so ties and repeated rows have a fixed order; a
null conversation id is a conversation of its own; a conversation without an
assistant turn is formatted but yields no example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def format_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                 role_col: str = "role", text_col: str = "text", trainable_role: str = "assistant") -> DataFrame:
    """One row per turn: conv_id, seq (0, 1, ...), role, is_target, chars_before,
    segment (the formatted turn), target (the escaped reply, else null)."""
    role = F.coalesce(F.col(role_col), F.lit(""))
    turns = conversations.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), role.alias("role"),
        escape(F.coalesce(F.col(text_col), F.lit(""))).alias("body"))
    head = F.concat(F.lit(START), F.url_encode("role"), F.lit("\n"))
    turns = turns.withColumn("segment", F.concat(head, F.col("body"), F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "body")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.char_length("segment")
    target = F.col("role") == trainable_role
    return turns.select(
        "conv_id", (F.row_number().over(order) - 1).cast("long").alias("seq"), "role", target.alias("is_target"),
        (F.sum(size).over(upto) - size).alias("chars_before"), "segment",
        F.when(target, F.col("body")).alias("target"))


def examples(turns: DataFrame) -> DataFrame:
    """One row per trainable turn of :func:`format_turns`: conv_id, example
    (its turn's place), context_turns, context_chars, loss_start, loss_end
    (positions in the example's text) and target."""
    head = F.char_length("segment") - F.char_length("target") - F.lit(len(END))
    return turns.where("is_target").select(
        "conv_id", F.col("seq").alias("example"), F.col("seq").alias("context_turns"),
        F.col("chars_before").alias("context_chars"),
        (F.col("chars_before") + head).alias("loss_start"),
        (F.col("chars_before") + head + F.char_length("target")).alias("loss_end"), "target")


def render(turns: DataFrame, chosen: DataFrame) -> DataFrame:
    """The full text of chosen examples: conv_id, example, text, loss_start,
    loss_end.  The text repeats the context, so its size is the sum of the
    prefixes: choose the examples a batch needs."""
    t = turns.select(F.col("conv_id").alias("t_conv"), "seq", "segment")
    e = chosen.select("conv_id", "example", "loss_start", "loss_end")
    joined = e.join(t, e["conv_id"].eqNullSafe(t["t_conv"]) & (t["seq"] <= e["example"]))
    parts = F.array_sort(F.collect_list(F.struct("seq", "segment")))
    return (joined.groupBy("conv_id", "example", "loss_start", "loss_end").agg(parts.alias("parts"))
            .select("conv_id", "example", F.array_join("parts.segment", "").alias("text"), "loss_start", "loss_end"))


def parse(segment: Column) -> tuple[Column, Column]:
    """(role, text) read back from a formatted turn."""
    inner = F.substr(segment, F.lit(len(START) + 1), F.char_length(segment) - F.lit(len(START) + len(END)))
    cut = F.locate("\n", inner)
    return F.url_decode(F.substr(inner, F.lit(1), cut - 1)), unescape(F.substr(inner, cut + 1))
