"""Trees in (id, parent) tables, of any depth, by pointer doubling.

Each round joins every pointer with the pointer at its end, so pointers reach twice as far: a
chain of n nodes takes about log2(n) rounds, whose state is a written table. A cycle never
ends, which the number of nodes tells.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tributary.storage import write_and_read


def _check(round_: int, nodes: int, open_: int) -> None:
    if open_ and 1 << round_ > 2 * nodes:
        raise ValueError("the parents form a cycle")


def paths(nodes: DataFrame, id_: str, parent: str, name: str, separator: str = " > ") -> DataFrame:
    """id, name, depth (1 for a root), path of names from the root; nodes that no root reaches are left out."""
    state = nodes.select(F.col(id_).alias("id"), F.col(parent).alias("up"), F.lit(1).alias("depth"), F.col(name).cast("string").alias("path"))
    state = write_and_read(state, "tree-paths")
    total, round_ = state.count(), 0
    while not state.filter("up is not null").isEmpty():
        _check(round_, total, 1)
        above = state.select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"), F.col("path").alias("start"))
        # an inner join drops nodes under a parent that is not there
        moved = state.filter("up is not null").join(above, "up").select("id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), F.concat("start", F.lit(separator), "path").alias("path"))
        state = write_and_read(state.filter("up is null").unionByName(moved), "tree-paths")
        round_ += 1
    return nodes.select(F.col(id_).alias("id"), F.col(name).alias("name")).join(state.drop("up"), "id").select("id", "name", "depth", "path")


def closure(nodes: DataFrame, id_: str, parent: str) -> DataFrame:
    """id, ancestor, distance: every node with itself and all nodes above it.

    After k rounds pairs nearer than 2**k are known; those up to twice as far are the known pairs of the node 2**k above.
    """
    jumps = write_and_read(nodes.filter(F.col(parent).isNotNull()).select(F.col(id_).alias("id"), F.col(parent).alias("to")), "tree-jumps")
    jumps = write_and_read(jumps.join(nodes.select(F.col(id_).alias("to")), "to", "left_semi").select("id", "to"), "tree-jumps")
    pairs = [nodes.select(F.col(id_).alias("id"), F.col(id_).alias("ancestor"), F.lit(0).cast("long").alias("distance"))]
    total, round_ = nodes.count(), 0
    while not jumps.isEmpty():
        _check(round_, total, 1)
        known = reduce(DataFrame.unionByName, pairs)
        farther = jumps.join(known.withColumnRenamed("id", "to"), "to").select("id", "ancestor", (F.col("distance") + F.lit(1 << round_)).alias("distance"))
        pairs.append(write_and_read(farther, "tree-pairs"))
        next_ = jumps.join(jumps.select(F.col("id").alias("to"), F.col("to").alias("then")), "to").select("id", F.col("then").alias("to"))
        jumps = write_and_read(next_, "tree-jumps")
        round_ += 1
    return reduce(DataFrame.unionByName, pairs)
