"""Join strategies for small sides and for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def hot_keys(df: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """Keys that hold at least ``share`` of all rows: never more than 1/share of them."""
    counts = df.groupBy(key).agg(F.count("*").alias("_n"))
    total = df.agg(F.count("*")).scalar()
    return counts.filter(F.col("_n") >= total * share).select(key)


def salted_join(big: DataFrame, other: DataFrame, key: str, row_id: str, salts: int = 16, share: float = 0.01) -> DataFrame:
    """Inner join whose hot keys spread over ``salts`` partitions.

    Only hot keys are salted, and only their rows of the other side are replicated.
    The salt comes from the row itself, so a retried task repeats it.
    """
    hot = F.broadcast(hot_keys(big, key, share).withColumn("_hot", F.lit(True)))
    salt = F.when(F.col("_hot"), F.pmod(F.xxhash64(row_id), F.lit(salts))).otherwise(F.lit(0))
    left = big.join(hot, key, "left").withColumn("_salt", salt.cast("int")).drop("_hot")
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = other.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_hot")
    return left.join(right, [key, "_salt"]).drop("_salt")


def hot_split_join(big: DataFrame, other: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    """Inner join in two parts: hot keys (at most 1/share of them) with their rows of the
    other side, which Spark broadcasts if they are few by its own measure; the rest by an ordinary join."""
    hot = F.broadcast(hot_keys(big, key, share))
    few = other.join(hot, key, "left_semi")
    hot_part = big.join(hot, key, "left_semi").join(few, key)
    rest = big.join(hot, key, "left_anti").join(other, key)
    return hot_part.unionByName(rest)


def skew_profile(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and the share of all rows each key holds."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    return counts.select(key, "n", (F.col("n") / total).alias("share"))


def partition_profile(df: DataFrame) -> DataFrame:
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(F.count("*").alias("n"))


def range_join(facts: DataFrame, periods: DataFrame, key: str, at: str, start: str, end: str) -> DataFrame:
    """Facts inside the half-open period of the same key."""
    f, p = facts.alias("f"), periods.alias("p")
    inside = (F.col(f"f.{at}") >= F.col(f"p.{start}")) & (F.col(f"f.{at}") < F.col(f"p.{end}"))
    keep = [F.col(f"f.{c}") for c in facts.columns] + [F.col(f"p.{c}") for c in periods.columns if c != key]
    return f.join(p, (F.col(f"f.{key}") == F.col(f"p.{key}")) & inside).select(*keep)
