"""Chat logs: cumulative snapshots collapsed to maximal conversations, then rendered.

A chat service that logs the whole conversation after every turn leaves each conversation many
times, every time a turn longer. Each turn is hashed with its place, role and text; the running
combination of these hashes identifies the prefix that ends at the turn. A conversation whose
whole hash is the hash of a proper prefix of another one is dropped by an anti-join; of equal
conversations the one with the smallest id stays. What stays is rendered as text. All steps are
DataFrame operations.

A conversation is cut into slices along its turns: the running hash is computed per slice, and one
row per slice carries it on. So a conversation that holds a third of all turns is not read by one task until it
is rendered into its one cell. Prefixes are counted by distinct hash before the anti-join, so a first turn that
many conversations share is one row there.

Defined cases. Turns are ordered by ``turn`` (null first), then role and text; their place in
this order counts, not the number. Rows that repeat a turn entirely count once. A null id is a
conversation of its own. A null text or role differs from an empty one in comparing and is
rendered like an empty one. An empty table gives no conversation. Markers of the format inside a
text are broken by a blank so that they cannot open or close a turn. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

SLICE = 256  # turns
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def turn_hashes(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """One row per distinct turn: conv, slice, turn, role, a 128-bit content hash (h1, h2)."""
    content = F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in ("role", "text")])
    hashes = [F.xxhash64(F.lit(n), F.length("role"), content) for n in ("first", "second")]
    rows = turns.select(
        F.col(id_column).alias("conv"), F.floor(F.coalesce("turn", F.lit(-1)) / SLICE).alias("slice"), "turn", "role", *[h.alias(n) for h, n in zip(hashes, ("h1", "h2"))]
    )
    return rows.distinct()


def prefixes(turns: DataFrame) -> DataFrame:
    """conv, place (1, 2, …), p1, p2: hash of the first ``place`` turns; ``last``: the whole conversation."""
    order = ["turn", "role", "h1", "h2"]
    here = Window.partitionBy("conv", "slice").orderBy(*order)
    numbered = turns.withColumn("n", F.row_number().over(here))
    slices = turns.groupBy("conv", "slice").agg(F.count("*").alias("rows"))
    along = Window.partitionBy("conv").orderBy("slice")
    starts = slices.select("conv", "slice", (F.sum("rows").over(along) - F.col("rows")).alias("start"))
    same = [F.col("a.conv").eqNullSafe(F.col("b.conv")), F.col("a.slice") == F.col("b.slice")]
    placed = numbered.alias("a").join(starts.alias("b"), same).select("a.*", (F.col("n") + F.col("start")).alias("place"))
    placed = placed.select("conv", "slice", "place", *[F.xxhash64(F.lit(n), "place", "h1", "h2").alias(n) for n in ("t1", "t2")])
    running = Window.partitionBy("conv", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    inside = placed.select("conv", "slice", "place", *[F.bit_xor(t).over(running).alias(t) for t in ("t1", "t2")])
    whole = placed.groupBy("conv", "slice").agg(F.bit_xor("t1").alias("w1"), F.bit_xor("t2").alias("w2"), F.max("place").alias("end"))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select(
        "conv", "slice", *[F.coalesce(F.bit_xor(w).over(before), F.lit(0)).alias(w) for w in ("w1", "w2")], F.max("end").over(Window.partitionBy("conv")).alias("end")
    )
    return inside.alias("a").join(carried.alias("b"), same).select(
        "a.conv", "place", F.col("t1").bitwiseXOR(F.col("w1")).alias("p1"), F.col("t2").bitwiseXOR(F.col("w2")).alias("p2"), (F.col("place") == F.col("end")).alias("last")
    )


def maximal(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """conv, n_turns, copies: conversations that no other one continues; equal ones once, by smallest id."""
    found = prefixes(turn_hashes(turns, id_column))
    whole = found.filter("last").groupBy("place", "p1", "p2").agg(F.min("conv").alias("conv"), F.count("*").alias("copies"))
    proper = found.filter("not last").select("place", "p1", "p2").distinct()
    return whole.join(proper, ["place", "p1", "p2"], "left_anti").select("conv", F.col("place").alias("n_turns"), "copies")


def escaped(text):
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("< |"))


def rendered(turns: DataFrame, keep: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """conv, n_turns, copies, chat: one line-framed block per turn."""
    rows = turns.select(F.col(id_column).alias("c"), "turn", "role", "text")
    mine = rows.join(keep, F.col("c").eqNullSafe(F.col("conv")))
    turn = F.struct("turn", "role", "text")
    block = lambda t: F.concat(F.lit(OPEN), escaped(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit(CLOSE + "\n"))
    return (
        mine.groupBy("conv", "n_turns", "copies")
        .agg(F.sort_array(F.collect_set(turn)).alias("turns"))
        .select("conv", "n_turns", "copies", F.array_join(F.transform("turns", block), "").alias("chat"))
    )


def collapse(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """Maximal conversations with their text."""
    return rendered(turns, maximal(turns, id_column), id_column)
