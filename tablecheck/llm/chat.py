"""Chat formatting with a loss mask, in Spark expressions only.

A conversation becomes one text. Adjacent turns of one role share a block::

    <|role:user|>
    first text<|next|>second text<|end|>
    <|role:assistant|>
    ...

The characters ``<``, ``[``, ``|`` and the backslash inside roles and texts are
each followed by a backslash, so no control string of this or a common other
template survives inside a text, and every text comes back unchanged. The output
keeps a conversation as segments; their texts joined are the formatted text, and
a segment's ``loss`` tells whether it is learned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNED = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[|\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[|\\])\\", "$1")


def format_conversations(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learned: str = LEARNED
) -> DataFrame:
    """One row (``conv_id``, ``segments``) per conversation.

    Turns are ordered by their number, then role and text, so ties and repeated
    rows have a fixed order and all are kept; a null number comes first. A null
    role or text counts as empty; rows without a conversation id form one
    conversation of their own. Empty input gives an empty result; other columns are ignored.
    A conversation is one text and so is put together in one task.
    """
    escaped = turns.select(
        F.col(conv_id).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            escape(F.coalesce(F.col(role), F.lit(""))).alias("role"),
            escape(F.coalesce(F.col(text), F.lit(""))).alias("text"),
        ).alias("said"),
    )
    sorted_turns = escaped.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))

    def segments(t: Column, i: Column) -> Column:
        goes_on = (i > 0) & (F.get("said", i - 1)["role"] == t["role"])
        ends = (i == F.size("said") - 1) | (F.get("said", i + 1)["role"] != t["role"])
        start = F.when(goes_on, F.lit("<|next|>")).otherwise(F.concat(F.lit("<|role:"), t["role"], F.lit("|>\n")))
        mark = lambda s: F.struct(s.alias("text"), F.lit(False).alias("loss"))
        said = F.struct(t["text"].alias("text"), (t["role"] == escape(F.lit(learned))).alias("loss"))
        return F.array(mark(start), said, mark(F.when(ends, F.lit("<|end|>\n")).otherwise(F.lit(""))))

    return sorted_turns.select("conv_id", F.flatten(F.transform("said", segments)).alias("segments"))


def formatted_text(segments: str | Column) -> Column:
    """The formatted conversation."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def learned_text(segments: str | Column) -> Column:
    """All text under the loss mask, as it was before formatting."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def parse_turns(formatted: str | Column) -> Column:
    """The turns of a formatted conversation as an array of (role, text)."""
    formatted = F.col(formatted) if isinstance(formatted, str) else formatted

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "|>", 1)
        body = F.substring_index(F.substr(block, F.length(role) + 4), "<|end|>", 1)
        return F.transform(
            F.split(body, r"<\|next\|>"), lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text"))
        )

    blocks = F.split(formatted, r"<\|role:")
    return F.flatten(F.transform(F.slice(blocks, 2, F.size(blocks)), turns))


def digests(output: DataFrame) -> DataFrame:
    """Per conversation what the output holds: counts and hashes of its turns and of its learned text."""
    read = output.select("conv_id", formatted_text("segments").alias("formatted"), learned_text("segments").alias("learned"))
    read = read.withColumn("turns", parse_turns("formatted"))
    line = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
