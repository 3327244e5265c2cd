"""Mergeable member sets as 64-bit words: one row per (set, word_no).

A set of ids never has to fit one cell or one task: ``word_no = id div 64`` and
the bit at ``id mod 64``. Words of equal key merge with ``bit_or``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

MAX_ID = 4294967295  # ids are unsigned 32-bit
BLOCK_BITS = 8  # a block is 256 words, 16,384 ids


def checked_id(member: Column) -> Column:
    """Fail instead of silently truncating an id that does not fit 32 bits."""
    ok = (member >= 0) & (member <= MAX_ID)
    return F.when(ok, member).otherwise(F.raise_error(F.concat(F.lit("id does not fit 32 bits: "), member.cast("string"))).cast("bigint"))


def word_no(member: Column) -> Column:
    return F.shiftright(member, 6)


def bit(member: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), member.bitwiseAND(F.lit(63)).cast("int"))


def bitmap_agg(members: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Build one word-sliced bitmap per key; partial + final hash aggregate, no Python."""
    ids = members.withColumn("_id", checked_id(F.col(member).cast("bigint")))
    return ids.groupBy(*keys, word_no(F.col("_id")).alias("word_no")).agg(F.bit_or(bit(F.col("_id"))).alias("bits"))


def bitmap_union(words: DataFrame, keys: list[str]) -> DataFrame:
    return words.groupBy(*keys, "word_no").agg(F.bit_or("bits").alias("bits"))


def cardinality(words: DataFrame, keys: list[str], name: str = "members") -> DataFrame:
    """Words need not be merged; that is done here."""
    return bitmap_union(words, keys).groupBy(*keys).agg(F.sum(F.bit_count("bits")).cast("bigint").alias(name))


def members(words: DataFrame, keys: list[str], name: str = "actor_id") -> DataFrame:
    """All ids, one row each."""
    positions = F.array(*[F.lit(i) for i in range(64)])
    return (
        bitmap_union(words, keys).select(*keys, "word_no", "bits", F.explode(positions).alias("_pos"))
        .filter(F.getbit("bits", F.col("_pos")) == 1)
        .select(*keys, (F.col("word_no") * 64 + F.col("_pos")).alias(name))
    )


def contains(words: DataFrame, probes: DataFrame, keys: list[str], member: str) -> DataFrame:
    """Adds ``found`` to each probe; an absent set contains nothing.

    Hits come from an inner join, so a short probe list is broadcast and the words stay
    where they are; a long one joins by shuffle.
    """
    asked = probes.select(*keys, member).distinct().withColumn("word_no", word_no(F.col(member).cast("bigint")))
    hit = F.getbit("bits", F.col(member).bitwiseAND(F.lit(63)).cast("int")) == 1
    hits = words.join(asked, [*keys, "word_no"]).filter(hit).select(*keys, member, F.lit(True).alias("found")).distinct()
    return probes.join(hits, [*keys, member], "left").select(*probes.columns, F.coalesce("found", F.lit(False)).alias("found"))


def block_counts(words: DataFrame, keys: list[str]) -> DataFrame:
    """Members per block and up to its end; at most 2**18 blocks per set of 32-bit ids."""
    so_far = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    blocks = words.groupBy(*keys, F.shiftright("word_no", BLOCK_BITS).alias("block")).agg(F.sum(F.bit_count("bits")).alias("n"))
    return blocks.withColumn("through", F.sum("n").over(so_far))


def pages(words: DataFrame, requests: DataFrame, keys: list[str], size: int = 1000, name: str = "actor_id") -> DataFrame:
    """First ``size`` ids >= cursor, ascending, per request (keys, cursor).

    Block counts tell which blocks hold the page: the cursor's own and those that follow
    until ``size`` members are certain. Only their words are joined to the request.
    """
    words = bitmap_union(words, keys)
    request = Window.partitionBy(*keys, "cursor")
    wanted = requests.select(*keys, "cursor").distinct()
    start = F.shiftright("cursor", 6 + BLOCK_BITS)
    candidates = block_counts(words, keys).join(wanted, keys)
    base = F.max(F.when(F.col("block") <= start, F.col("through")).otherwise(0))
    bases = candidates.groupBy(*keys, "cursor").agg(base.alias("_base"))
    needed = (
        candidates.filter(F.col("block") >= start)
        .join(bases, [*keys, "cursor"])
        .filter((F.col("block") == start) | (F.col("through") - F.col("n") - F.col("_base") < size))
        .select(*keys, "cursor", "block")
    )
    from_cursor = F.call_function("shiftleft", F.lit(-1).cast("bigint"), F.col("cursor").bitwiseAND(F.lit(63)).cast("int"))
    at_cursor = F.col("word_no") == word_no(F.col("cursor"))
    kept = F.when(at_cursor, F.col("bits").bitwiseAND(from_cursor)).otherwise(F.col("bits"))
    near = (
        words.withColumn("block", F.shiftright("word_no", BLOCK_BITS))
        .join(needed, [*keys, "block"])
        .filter(F.col("word_no") >= word_no(F.col("cursor")))
        .withColumn("bits", kept)
        .filter(F.col("bits") != 0)
    )
    ids = members(near, [*keys, "cursor"], name)  # one row per word already
    ranked = ids.withColumn("_r", F.row_number().over(request.orderBy(name)))
    return ranked.filter(F.col("_r") <= size).drop("_r")
