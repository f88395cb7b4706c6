"""Chat formatting by perspective rotation.

For every participant (distinct role) of a conversation, the dialogue is rendered with that
speaker as assistant and the others as named users. The mask lists the character spans that
the assistant wrote, its end mark included; a loss would be taken over these only.

A turn is rendered as ``<|im_start|>assistant\\n{text}<|im_end|>\\n`` or
``<|im_start|>user name={role}\\n{text}<|im_end|>\\n`` (the published ChatML form).

A dialogue is rendered in chunks of ``chunk_turns`` turn numbers, so a conversation with a
third of all rows is rendered by many tasks, and one row never holds more than a chunk;
joining the chunks of a perspective in order gives its whole dialogue. Where more than
``chunk_turns`` rows share turn numbers, a chunk is split into ``piece`` 0, 1, ...

Marks inside a text or a role would forge turns, so there ``<|im_start|>`` is rendered as
``<| im_start |>`` and ``<|im_end|>`` as ``<| im_end |>``; line ends in a role are rendered as spaces.

Defined results: a null role is the participant ``unknown``; a null text is empty; a null turn
comes first, in chunk -1; ties are in order of role, then text; repeated rows are rendered as
often as they occur; a null conversation is a conversation; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def unmarked(text: Column) -> Column:
    for mark in (START, END):
        text = F.replace(text, F.lit(mark), F.lit(f"<| {mark[2:-2]} |>"))
    return text


def rotate_perspectives(
    turns: DataFrame, chunk_turns: int = 64, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """conv_id, perspective, chunk, piece, n_turns, n_assistant, text, mask (array of start and end)."""
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
        unmarked(F.coalesce(F.col(text_col), F.lit(""))).alias("text"),
    ).withColumn("chunk", F.coalesce(F.floor(F.col("turn") / chunk_turns), F.lit(-1)).cast("long"))
    by_place = Window.partitionBy("conv_id", "chunk").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumn("place", F.row_number().over(by_place) - 1).withColumn("piece", F.floor(F.col("place") / chunk_turns).cast("long"))
    pieces = rows.groupBy("conv_id", "chunk", "piece").agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns")
    )
    # Roles are counted map-side first; a conversation has as many rows here as participants.
    people = turns.select(F.col(conv_col).alias("c"), F.coalesce(F.col(role_col), F.lit("unknown")).alias("perspective")).distinct()
    each = pieces.join(people, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")

    def own(t: Column) -> Column:
        return t["role"] == F.col("perspective")

    head = lambda t: F.when(own(t), F.lit(f"{START}assistant\n")).otherwise(F.concat(F.lit(f"{START}user name="), unmarked(F.translate(t["role"], "\r\n", "  ")), F.lit("\n")))
    body = lambda t: F.concat(t["text"], F.lit(END))
    rendered = F.transform("turns", lambda t: F.struct(own(t).alias("own"), F.length(head(t)).alias("lead"), F.length(body(t)).alias("size"), F.concat(head(t), body(t), F.lit("\n")).alias("shown")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("mask"))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + t["lead"]
        span = F.struct(begin.alias("start"), (begin + t["size"]).alias("end"))
        return F.struct(
            (begin + t["size"] + 1).alias("at"), F.when(t["own"], F.concat(state["mask"], F.array(span))).otherwise(state["mask"]).alias("mask")
        )

    return each.withColumn("r", rendered).select(
        "conv_id", "perspective", "chunk", "piece", F.size("r").alias("n_turns"), F.size(F.filter("r", lambda t: t["own"])).alias("n_assistant"),
        F.concat_ws("", F.transform("r", lambda t: t["shown"])).alias("text"), F.aggregate("r", start, step, lambda s: s["mask"]).alias("mask"),
    )
