"""Multi-party perspective rotation: a dialogue once from each speaker's side.

For every participant the dialogue is rendered with that speaker as the assistant and
all others as users under their names; system turns stay system turns. The loss mask
holds the spans of the assistant's own words and end marks.

A dialogue comes in parts of ``turns_per_part`` turn numbers, so that one of any length
is spread over many rows and tasks. Turns are gathered into parts once, before they are
rotated; a conversation that holds a third of all rows is then many parts, which a join
with its speakers may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _message(turn: Column, speaker: Column, system: str) -> tuple[Column, Column]:
    """What stands before a turn's words, and whether it is the speaker's own."""
    name = F.coalesce(turn["speaker"], F.lit(""))
    own = turn["speaker"].eqNullSafe(speaker)
    head = (
        F.when(own, F.lit("assistant"))
        .when(turn["speaker"].eqNullSafe(F.lit(system)), F.lit(system))
        .when(name == "", F.lit("user"))
        .otherwise(F.concat(F.lit("user name="), F.regexp_replace(name, r"[\s<>|]+", "_")))
    )
    return F.concat(F.lit(OPEN), head, F.lit("\n")), own


def rotate(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    speaker: str = "role",
    text: str = "text",
    system: str = "system",
    turns_per_part: int = 256,
) -> DataFrame:
    """``conv_id``, ``perspective``, ``part``, ``n_turns``, ``text`` and ``mask``.

    ``part`` is the turn number divided by ``turns_per_part``; turns without a number
    make a last part without number. In a part turns are ordered by number, then by
    speaker and text (nulls first); repeated turns all stay. ``mask`` lists the spans
    ``[start, end)`` in characters of the part's text that count for the loss; it is
    empty where the speaker says nothing in that part. A null or empty text is an empty
    turn. A null or empty speaker is a user without a name and no participant; rows
    with a null ``conv_id`` are one conversation. One without participants gives no row.
    Further columns of the input are left out.
    """
    rows = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.col(f"`{speaker}`").alias("speaker"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    part = F.floor(F.col("turn") / turns_per_part).alias("part")
    parts = rows.groupBy("conv_id", part).agg(
        F.array_sort(F.collect_list(F.struct("turn", "speaker", "text"))).alias("turns")
    )
    people = rows.filter((F.col("speaker") != system) & (F.col("speaker") != "")).select(
        F.col("conv_id").alias("_conv_id"), F.col("speaker").alias("perspective")
    )
    rotated = parts.join(people.distinct(), F.col("conv_id").eqNullSafe(F.col("_conv_id")))

    def render(one: Column) -> Column:
        head, own = _message(one, F.col("perspective"), system)
        return F.struct(head.alias("head"), F.concat(one["text"], F.lit(CLOSE)).alias("body"), own.alias("own"))

    def add(state: Column, one: Column) -> Column:
        start = state["at"] + F.length(one["head"])
        end = start + F.length(one["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(one["own"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    none = F.array().cast("array<struct<start:int,end:int>>")
    shown = rotated.select("conv_id", "perspective", "part", F.transform("turns", render).alias("turns"))
    return shown.select(
        "conv_id",
        "perspective",
        "part",
        F.size("turns").alias("n_turns"),
        F.array_join(F.transform("turns", lambda one: F.concat(one["head"], one["body"])), "").alias("text"),
        F.aggregate("turns", F.struct(F.lit(0).alias("at"), none.alias("spans")), add, lambda state: state["spans"]).alias("mask"),
    )
