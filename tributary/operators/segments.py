"""Audience segments: boolean expressions over tag member sets."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tributary.operators import bitmaps
from tributary.sources.sinks import replace_partitions


@dataclass(frozen=True)
class Segment:
    """``tag``, or two segments joined by ``and``, ``or`` or ``and_not``."""

    op: str
    left: "Segment | int"
    right: "Segment | None" = None

    def __and__(self, other: "Segment") -> "Segment":
        return Segment("and", self, other)

    def __or__(self, other: "Segment") -> "Segment":
        return Segment("or", self, other)

    def __sub__(self, other: "Segment") -> "Segment":
        return Segment("and_not", self, other)

    def tags(self) -> list[int]:
        return [self.left] if self.op == "tag" else self.left.tags() + self.right.tags()

    def fold(self, leaf: Callable, combine: dict[str, Callable]):
        if self.op == "tag":
            return leaf(self.left)
        return combine[self.op](self.left.fold(leaf, combine), self.right.fold(leaf, combine))


def tag(number: int) -> Segment:
    return Segment("tag", number)


WORDS = {
    "and": lambda a, b: a.bitwiseAND(b),
    "or": lambda a, b: a.bitwiseOR(b),
    "and_not": lambda a, b: a.bitwiseAND(F.bitwise_not(b)),
}
ARRAYS = {"and": np.bitwise_and, "or": np.bitwise_or, "and_not": lambda a, b: a & ~b}
FLAGS = {"and": lambda a, b: a & b, "or": lambda a, b: a | b, "and_not": lambda a, b: a & ~b}
# Size of a combination if tags were independent.
CHANCE = {"and": lambda a, b: a * b, "or": lambda a, b: 1 - (1 - a) * (1 - b), "and_not": lambda a, b: a * (1 - b)}


def most_recent_signal(log: DataFrame) -> DataFrame:
    """One row per (attribute, actor, tag): the latest signal wins."""
    latest = F.max_by("signal", F.struct("ts", "event_id"))
    return log.groupBy("attribute_id", "actor_id", "tag_id").agg(
        latest.alias("latest_signal"), F.max("ts").alias("last_persist_time")
    )


def active(membership: DataFrame) -> DataFrame:
    return membership.filter(F.col("latest_signal") == 1)


def tag_bitmaps(membership: DataFrame) -> DataFrame:
    """All tags in one pass: (tag_id, word_no, bits)."""
    return bitmaps.bitmap_agg(active(membership).select("tag_id", "actor_id"), ["tag_id"], "actor_id")


def _needed(segments: dict[int, Segment]) -> list[int]:
    return sorted({t for s in segments.values() for t in s.tags()})


def evaluate(tag_words: DataFrame, segments: dict[int, Segment]) -> DataFrame:
    """All segments in one job: (segment_id, word_no, bits), empty words left out.

    Each tag is read once for all expressions; words that are not merged yet are joined by OR,
    words of a missing tag count as 0.
    """
    return _evaluate(tag_words.select("tag_id", "word_no", "bits"), segments)


def _evaluate(words: DataFrame, segments: dict[int, Segment]) -> DataFrame:
    """One row per word with a column per tag (a partial aggregate and one shuffle), then every
    expression on whole Arrow batches of these columns, whatever the number of segments."""
    tags = _needed(segments)
    zero = F.lit(0).cast("bigint")
    columns = [F.coalesce(F.bit_or(F.when(F.col("tag_id") == t, F.col("bits"))), zero).alias(f"t{t}") for t in tags]
    per_word = words.filter(F.col("tag_id").isin(tags)).groupBy("word_no").agg(*columns)
    ids = np.fromiter(segments, dtype=np.int32)
    schema = pa.schema([("segment_id", pa.int32()), ("word_no", pa.int64()), ("bits", pa.int64())])

    def compute(batches):
        for batch in batches:
            rows = {t: batch.column(f"t{t}").to_numpy() for t in tags}
            results = np.stack([s.fold(rows.__getitem__, ARRAYS) for s in segments.values()])
            which, at = np.nonzero(results)
            yield pa.RecordBatch.from_arrays([pa.array(ids[which]), pa.array(batch.column("word_no").to_numpy()[at]), pa.array(results[which, at])], schema=schema)

    return per_word.mapInArrow(compute, "segment_id int, word_no bigint, bits bigint")


def evaluate_members(membership: DataFrame, segments: dict[int, Segment]) -> DataFrame:
    """Membership rows → segment words with a single shuffle on word_no: the tag words
    are only a partial aggregate here and are never exchanged on their own."""
    member = bitmaps.checked_id(F.col("actor_id").cast("bigint"))
    rows = active(membership).withColumn("_id", member)
    return _evaluate(rows.select("tag_id", bitmaps.word_no(F.col("_id")).alias("word_no"), bitmaps.bit(F.col("_id")).alias("bits")), segments)


def evaluate_rows(membership: DataFrame, segments: dict[int, Segment]) -> DataFrame:
    """Second, independent path: per-actor flags instead of words. (segment_id, actor_id)"""
    tags = _needed(segments)
    flags = [F.coalesce(F.bool_or(F.col("tag_id") == t), F.lit(False)).alias(f"t{t}") for t in tags]
    per_actor = active(membership).filter(F.col("tag_id").isin(tags)).groupBy("actor_id").agg(*flags)
    hits = [F.when(s.fold(lambda t: F.col(f"t{t}"), FLAGS), F.lit(i)) for i, s in segments.items()]
    return per_actor.select("actor_id", F.explode(F.array_compact(F.array(*hits))).alias("segment_id"))


def estimate(tag_words: DataFrame, segments: dict[int, Segment]) -> DataFrame:
    """Expected share and size of each segment from tag densities alone."""
    tags = _needed(segments)
    per_word = tag_words.groupBy("word_no").agg(
        F.bit_or("bits").alias("anyone"),
        *[F.coalesce(F.bit_or(F.when(F.col("tag_id") == t, F.col("bits"))), F.lit(0).cast("bigint")).alias(f"t{t}") for t in tags],
    )
    sizes = per_word.agg(
        F.sum(F.bit_count("anyone")).cast("double").alias("universe"),
        *[F.sum(F.bit_count(f"t{t}")).cast("double").alias(f"n{t}") for t in tags],
    )
    shares = [
        F.struct(F.lit(i).alias("segment_id"), s.fold(lambda t: F.col(f"n{t}") / F.col("universe"), CHANCE).alias("share"))
        for i, s in segments.items()
    ]
    rows = sizes.select("universe", F.explode(F.array(*shares)).alias("s")).select("universe", "s.*")
    return rows.select("segment_id", "share", (F.col("share") * F.col("universe")).alias("expected"))


def agreement(words: DataFrame, rows: DataFrame) -> DataFrame:
    """Member totals of two pipelines side by side."""
    a = bitmaps.cardinality(words, ["segment_id"], "members_a")
    b = rows.groupBy("segment_id").agg(F.count("*").alias("members_b"))
    joined = a.join(b, "segment_id", "full").na.fill(0, ["members_a", "members_b"])
    return joined.withColumn("agree", F.col("members_a") == F.col("members_b"))


def replace_tag(words: DataFrame, path: str, tag_id: int) -> None:
    """Idempotently replace one tag's stored bitmap, by nothing where the tag has no words;
    other tags stay untouched."""
    replace_partitions(words, path, "tag_id", [tag_id])


def split_blobs(blobs: DataFrame, name: str, data: str, limit: int) -> DataFrame:
    """Cut each blob to pieces of at most ``limit`` bytes; an empty blob gives one empty piece."""
    n = F.greatest(F.ceil(F.length(data) / limit), F.lit(1)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col(data), i * limit + 1, F.lit(limit)))
    # The pieces leave the blob behind before they become rows, so no row carries the whole of it.
    pieces = blobs.select(name, n.alias("n"), cut.alias("pieces"))
    return pieces.select(name, "n", F.posexplode("pieces").alias("chunk", "data")).select(name, "chunk", "n", "data")


def join_blobs(chunks: DataFrame, name: str) -> DataFrame:
    """Put pieces back together; ``data`` is NULL where a piece is missing. A group is one blob."""
    ordered = F.sort_array(F.collect_list(F.struct("chunk", "data")))
    grouped = chunks.groupBy(name).agg(F.first("n").alias("n"), ordered.alias("pieces"))
    whole = F.unhex(F.array_join(F.transform("pieces", lambda p: F.hex(p["data"])), ""))
    return grouped.select(name, "n", F.when(F.size("pieces") == F.col("n"), whole).alias("data"))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
