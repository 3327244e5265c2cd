"""Stored member sets: blocks of merged words, clustered by set, with a directory of counts.

Words are merged once, when a set is stored. A block is one row of up to 32 words (2,048 ids) with
its count and the count before it in its region of 256 blocks; the directory has one row per (set,
region). Files are clustered by (set, block), so a read of few sets skips the others' row
groups, and the counts are read without the words. A probe meets one block; a page finds its
blocks by the counts and reads no others.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tributary.operators.bitmaps import bitmap_union, word_no

WORDS = 5  # a block is 2**5 words of 64 ids
BLOCKS = 8  # a region is 2**8 blocks


def block_no(member: Column) -> Column:
    return F.shiftright(word_no(member), WORDS)


@dataclass(frozen=True)
class StoredSets:
    """Sets by ``keys`` under ``path``; an absent set is empty."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]

    @property
    def blocks(self) -> DataFrame:
        """keys, region, block, n, inner (ids before it in the region), nos (places of its words), bits."""
        return self.spark.read.parquet(f"{self.path}/blocks")

    @property
    def directory(self) -> DataFrame:
        """keys, region, n, before (ids of the set before the region)."""
        return self.spark.read.parquet(f"{self.path}/directory")


def store(words: DataFrame, keys: list[str], path: str) -> StoredSets:
    """Write sets of (keys, word_no, bits); several rows of one word are merged by OR."""
    block = F.shiftright("word_no", WORDS)
    place = F.struct(F.col("word_no").bitwiseAND(F.lit((1 << WORDS) - 1)).cast("int").alias("no"), "bits")
    grouped = bitmap_union(words, keys).filter("bits != 0").groupBy(*keys, block.alias("block"))
    rows = grouped.agg(F.sum(F.bit_count("bits")).cast("long").alias("n"), F.sort_array(F.collect_list(place)).alias("w"))
    rows = rows.withColumn("region", F.shiftright("block", BLOCKS))
    before = Window.partitionBy(*keys, "region").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(
        *keys, "region", "block", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("inner"), F.transform("w", lambda w: w["no"]).alias("nos"), F.transform("w", lambda w: w["bits"]).alias("bits")
    )
    clustered = rows.repartitionByRange(*keys, "region").sortWithinPartitions(*keys, "block")
    clustered.write.mode("error").parquet(f"{path}/blocks")
    stored = StoredSets(words.sparkSession, path, tuple(keys))
    counts = stored.blocks.groupBy(*keys, "region").agg(F.sum("n").alias("n"))
    along = Window.partitionBy(*keys).orderBy("region").rowsBetween(Window.unboundedPreceding, -1)
    directory = counts.withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0)))
    directory.repartitionByRange(*keys, "region").sortWithinPartitions(*keys, "region").write.mode("error").parquet(f"{path}/directory")
    return stored


def cardinality(sets: StoredSets, name: str = "members") -> DataFrame:
    """Members per set, from the directory alone."""
    return sets.directory.groupBy(*sets.keys).agg(F.sum("n").alias(name))


def _word(member: Column) -> Column:
    """The word of a block that holds ``member``; null where it has none."""
    at = F.array_position("nos", word_no(member).bitwiseAND(F.lit((1 << WORDS) - 1)).cast("int"))
    return F.get("bits", (F.nullif(at, F.lit(0)) - 1).cast("int"))


def contains(sets: StoredSets, probes: DataFrame, member: str) -> DataFrame:
    """Adds ``found`` to each probe of (keys, ``member``)."""
    keys = list(sets.keys)
    id_ = F.col(member).cast("long")
    asked = probes.select(*keys, member).filter(id_ >= 0).distinct().withColumn("block", block_no(id_))
    hit = F.getbit(_word(id_), id_.bitwiseAND(F.lit(63)).cast("int")) == 1
    hits = sets.blocks.join(asked, [*keys, "block"]).filter(hit).select(*keys, member, F.lit(True).alias("found"))
    return probes.join(hits, [*keys, member], "left").select(*probes.columns, F.coalesce("found", F.lit(False)).alias("found"))


def _ids(blocks: DataFrame, *keep: str, name: str) -> DataFrame:
    """The ids of block rows, one row each."""
    words = blocks.select(*keep, "block", F.explode(F.arrays_zip("nos", "bits")).alias("w"))
    positions = F.array(*[F.lit(i) for i in range(64)])
    bits = words.select(*keep, "block", "w.nos", "w.bits", F.explode(positions).alias("_pos")).filter(F.getbit("bits", F.col("_pos")) == 1)
    number = F.shiftleft("block", WORDS) + F.col("nos")
    return bits.select(*keep, (number * 64 + F.col("_pos")).alias(name))


def members(sets: StoredSets, name: str = "actor_id", where: Column | None = None) -> DataFrame:
    """All ids of all sets, or of those that satisfy ``where`` on the keys; no shuffle."""
    blocks = sets.blocks if where is None else sets.blocks.filter(where)
    return _ids(blocks, *sets.keys, name=name)


def needed_blocks(sets: StoredSets, requests: DataFrame, size: int) -> DataFrame:
    """keys, cursor, region, block: where the first ``size`` ids >= cursor of a request can be.

    Regions by the directory, then blocks by their counts; no word is read. The cursor's own block is
    always one of them, as the counts do not tell where in it the cursor falls.
    """
    keys = list(sets.keys)
    asked = requests.select(*keys, "cursor").distinct().withColumn("start", block_no(F.greatest("cursor", F.lit(0))))
    own = F.shiftright("start", BLOCKS)
    regions = sets.directory.join(asked, keys)
    reached = regions.groupBy(*keys, "cursor").agg(F.max(F.when(F.col("region") <= own, F.col("before") + F.col("n")).otherwise(0)).alias("passed"))
    regions = regions.join(reached, [*keys, "cursor"]).filter((F.col("region") == own) | (F.col("region") > own) & (F.col("before") - F.col("passed") < size))
    counts = sets.blocks.select(*keys, "region", "block", F.col("n").alias("m"), "inner")
    blocks = counts.join(regions.select(*keys, "cursor", "start", "region", "before"), [*keys, "region"])
    first = F.col("before") + F.col("inner")  # ids of the set before the block
    base = blocks.groupBy(*keys, "cursor").agg(
        F.max(F.when(F.col("block") <= F.col("start"), first + F.col("m"))).alias("through"), F.min(F.when(F.col("block") > F.col("start"), first)).alias("next")
    )
    near = blocks.join(base, [*keys, "cursor"]).filter(
        (F.col("block") == F.col("start")) | (F.col("block") > F.col("start")) & (first - F.coalesce("through", "next") < size)
    )
    return near.select(*keys, "cursor", "region", "block")


def pages(sets: StoredSets, requests: DataFrame, size: int = 1000, name: str = "actor_id") -> DataFrame:
    """First ``size`` ids >= cursor, ascending, per request (keys, cursor)."""
    keys = list(sets.keys)
    request = [*keys, "cursor"]
    found = sets.blocks.drop("n", "inner").join(needed_blocks(sets, requests, size), [*keys, "region", "block"])
    words = found.select(*request, "block", F.explode(F.arrays_zip("nos", "bits")).alias("w"))
    number = F.shiftleft("block", WORDS) + F.col("w.nos")
    from_cursor = F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("cursor").bitwiseAND(F.lit(63)).cast("int"))
    first = word_no(F.greatest("cursor", F.lit(0)))
    words = words.select(*request, number.alias("no"), F.col("w.bits").alias("bits")).filter(F.col("no") >= first)
    words = words.withColumn("bits", F.when((F.col("no") == first) & (F.col("cursor") >= 0), F.col("bits").bitwiseAND(from_cursor)).otherwise(F.col("bits")))
    before = Window.partitionBy(*request).orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    words = words.withColumn("seen", F.coalesce(F.sum(F.bit_count("bits")).over(before), F.lit(0))).filter(F.col("seen") < size)
    positions = F.array(*[F.lit(i) for i in range(64)])
    bits = words.select(*request, "no", "bits", "seen", F.explode(positions).alias("_pos")).filter(F.getbit("bits", F.col("_pos")) == 1)
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("_pos")))  # bits under this one
    rank = F.col("seen") + F.bit_count(F.col("bits").bitwiseAND(below))
    return bits.filter(rank < size).select(*request, (F.col("no") * 64 + F.col("_pos")).alias(name))


def _of_set(sets: StoredSets, values: dict) -> Column:
    return reduce(and_, [F.col(k) == F.lit(values[k]) for k in sets.keys])


def read_contains(sets: StoredSets, values: dict, ids: list[int], name: str = "actor_id") -> DataFrame:
    """Those of a few ids that one set holds. Set and blocks are literals, so other row groups are skipped."""
    wanted = sorted({i for i in ids if i >= 0})
    rows = sets.blocks.filter(_of_set(sets, values) & F.col("block").isin([i >> 6 + WORDS for i in wanted]))
    asked = rows.withColumn(name, F.explode(F.array(*map(F.lit, wanted)).cast("array<bigint>")))
    id_ = F.col(name)
    return asked.filter((block_no(id_) == F.col("block")) & (F.getbit(_word(id_), id_.bitwiseAND(F.lit(63)).cast("int")) == 1)).select(name)


def read_page(sets: StoredSets, values: dict, cursor: int, size: int = 1000, name: str = "actor_id") -> DataFrame:
    """One page of one set, ascending. The directory's rows of the set (8,192 at most) tell which regions to read."""
    own = _of_set(sets, values)
    start = max(cursor, 0) >> 6 + WORDS
    regions = sets.directory.filter(own & (F.col("region") >= start >> BLOCKS)).select("region", "n", "before").orderBy("region").collect()
    passed = next((r.before + r.n for r in regions if r.region == start >> BLOCKS), regions[0].before if regions else 0)
    last = max((r.region for r in regions if r.region == start >> BLOCKS or r.before - passed < size), default=-1)
    rows = sets.blocks.filter(own & F.col("region").between(start >> BLOCKS, last) & (F.col("block") >= start))
    return _ids(rows, name=name).filter(F.col(name) >= cursor).orderBy(name).limit(size)
