"""Places of conversation turns without a window over a whole conversation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SLICE = 256  # turn numbers


def slice_of(turn: str = "turn"):
    """Turns in slices along their number; null before all others."""
    return F.coalesce(F.floor(F.col(turn) / SLICE), F.lit(-(1 << 62))).cast("long").alias("slice")


def placed(rows: DataFrame, order: list[str], conv: str = "conv") -> tuple[DataFrame, DataFrame]:
    """(rows with ``n``: 1, 2, … within conversation and slice; conv, slice, rows, start per slice).

    ``start + n`` is the place in the conversation. Rows are windowed per (conversation, slice), only
    the table with one row per slice is windowed per conversation.
    """
    numbered = rows.withColumn("n", F.row_number().over(Window.partitionBy(conv, "slice").orderBy(*order)))
    along = Window.partitionBy(conv).orderBy("slice")
    slices = rows.groupBy(conv, "slice").agg(F.count("*").alias("rows"))
    return numbered, slices.withColumn("start", F.sum("rows").over(along) - F.col("rows"))
