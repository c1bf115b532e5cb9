"""Multi-party perspective rotation of dialogues, with DataFrame functions only.

Each participant in turn is the assistant, the others are named users; only what the assistant says is trained on. Rendered are pieces,
one per turn and perspective, with their place in the dialogue: pieces in order of ``start`` and joined are the dialogue. Places are prefix
sums over slices of the turn numbers, so a conversation of any length is spread over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coverloom.session import materialise

START, END = "<|im_start|>", "<|im_end|>"
SLICE = 4096  # turn numbers


def _unmarked(text: Column) -> Column:
    """Marks inside a text lose their meaning."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<\|", "< |")


def _name(speaker: Column) -> Column:
    return F.regexp_replace(speaker, r"[\s<>|=]+", "_")


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text",
           neutral: tuple[str, ...] = ("system",)) -> DataFrame:
    """(conv_id, perspective, turn, speaker, role, piece, start, length, train_start, train_end): one row per turn and perspective.

    ``neutral`` speakers are rendered as ``system`` and are no perspective; a null or empty speaker is the user ``unknown``, no perspective either. A
    null text is empty. ``start`` counts characters from the dialogue's begin; ``train_start`` and ``train_end`` bound the
    text and end mark of an assistant's turn there, else null. Turns go by number (null first), then speaker and text; equal rows
    are interchangeable. Rows without conversation and conversations without a perspective give nothing. Other columns are ignored.
    """
    known = F.when(F.trim(F.col(speaker_col)) != "", F.col(speaker_col))
    turns = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), known.alias("speaker"), _unmarked(F.col(text_col)).alias("text"))
    turns = turns.filter(F.col("conv_id").isNotNull())
    speaks = F.col("speaker").isNotNull() & ~F.col("speaker").isin(*neutral)
    seats = turns.filter(speaks).select(F.col("conv_id").alias("_conv"), F.col("speaker").alias("perspective")).distinct()
    seats = materialise(seats, "perspectives")
    rows = turns.join(seats, F.col("conv_id") == F.col("_conv")).drop("_conv")
    role = F.when(F.col("speaker") == F.col("perspective"), "assistant").when(F.col("speaker").isin(*neutral), "system").otherwise("user")
    name = F.when(F.col("role") == "user", F.concat(F.lit(" name="), _name(F.coalesce("speaker", F.lit("unknown"))))).otherwise("")
    rows = rows.withColumn("role", role).withColumn("head", F.concat(F.lit(START), "role", name, F.lit("\n")))
    rows = rows.withColumn("piece", F.concat("head", "text", F.lit(END + "\n"))).withColumn("length", F.length("piece").cast("long"))
    rows = rows.withColumn("_slice", F.floor(F.coalesce("turn", F.lit(0)) / SLICE))
    dialogue = ["conv_id", "perspective"]
    sums = rows.groupBy(*dialogue, "_slice").agg(F.sum("length").alias("_sum"))
    earlier = Window.partitionBy(*dialogue).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    within = Window.partitionBy(*dialogue, "_slice").orderBy(F.col("turn").asc_nulls_first(), "speaker", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(sums, [*dialogue, "_slice"])
    placed = placed.withColumn("start", F.col("_before") + F.coalesce(F.sum("length").over(within), F.lit(0)))
    own = F.col("role") == "assistant"
    train_start = F.col("start") + F.length("head")
    return placed.select(*dialogue, "turn", "speaker", "role", "piece", "start", "length", F.when(own, train_start).alias("train_start"),
                         F.when(own, train_start + F.length("text") + len(END)).alias("train_end"))
