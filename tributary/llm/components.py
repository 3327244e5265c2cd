"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.storage import write_and_read


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge to another one; root: the smallest node reached.

    Stars are alternately hung on larger and on smaller neighbours until nothing changes. Each
    round is two aggregates and two joins whose state is a written table; minima are partial
    aggregates, and a node with very many neighbours only meets its own minimum in a join.
    Null ends and loops are no edges.
    """
    pairs = write_and_read(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct(),
        "component-pairs",
    )
    before = None
    while True:
        print_ = tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
        if print_ == before or not print_[0]:
            roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        before = print_
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = write_and_read(hung.unionByName(small.withColumnRenamed("m", "v")).distinct(), "component-pairs")
