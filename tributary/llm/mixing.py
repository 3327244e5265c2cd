"""Mixing sources to target weights by hash thresholds.

Every row gets a hash. A source takes the rows whose hash lies below a threshold, so a larger
budget always contains a smaller one and nothing is sorted: histograms of words by source and
hash bucket show in which bucket a budget ends, and only that bucket is counted again by the next
bits of the hash. What is stored between the steps is one narrow row per document and one row
per source and bucket.

Defined cases. A null or empty text has no words, size 0, and its copies follow its hash like
those of any other row. A null source is a source of its own, last in order. Equal rows have
equal hashes and are taken together; a null id is hashed by its text. A source without words has
target 0 and takes nothing. An empty table gives an empty mix. Other columns are kept and may
have any name but those that the operator adds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from tributary.llm.common import word_count
from tributary.storage import write_and_read

LEVEL_BITS = 12  # a histogram has 4,096 buckets a source at most
LEVELS = 5
HASH_BITS = LEVEL_BITS * LEVELS
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)


@dataclass
class Mix:
    rows: DataFrame  # one narrow row per document: id, source, size, hash
    thresholds: DataFrame  # one row per source


def row_hash(id_column: str, text: str):
    """60 bits of md5, the same in any SQL engine."""
    key = F.coalesce(F.col(id_column).cast("string"), F.col(text), F.lit(""))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size → with ``weight`` and ``target``.

    Sources are ranked by a range partitioning and the partitions' counts, not in one task. The
    excess over a cap is shared anew among the others until no target is above its cap; only the
    two running totals come to the driver.
    """
    spark = sizes.sparkSession
    ordered = sizes.repartitionByRange(F.col("source").asc_nulls_last()).sortWithinPartitions(F.col("source").asc_nulls_last())
    placed = write_and_read(ordered.withColumn("at", F.monotonically_increasing_id()), "mix-sources")
    part, within = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    starts = (
        placed.groupBy(part.alias("part")).count()
        .withColumn("start", F.sum("count").over(Window.orderBy("part")) - F.col("count")).select("part", "start")
    )
    listed = F.array(*map(F.lit, weights))
    ranked = placed.withColumn("part", part).join(starts, "part").select(
        "source", "source_size", F.get(listed, ((F.col("start") + within) % len(weights)).cast("int")).cast("long").alias("weight")
    )
    left = ranked.withColumn("cap", F.col("source_size") * max_epochs)
    given = F.when(F.col("source_size") > 0, F.col("weight")).otherwise(0)
    total = left.agg(F.sum("source_size"), F.sum(given)).first()
    budget, active = total[0] or 0, total[1] or 0
    whole = budget
    while True:
        above = F.col("weight") * F.lit(budget).cast("decimal(38,0)") > F.col("cap").cast("decimal(38,0)") * F.lit(active)
        capped, weight = left.filter(above).agg(F.coalesce(F.sum("cap"), F.lit(0)), F.coalesce(F.sum(given), F.lit(0))).first()
        if (whole - capped, (total[1] or 0) - weight) == (budget, active):
            break
        budget, active = whole - capped, total[1] - weight
    share = F.col("weight").cast("double") * F.lit(float(budget)) / F.lit(float(active or 1))
    return left.withColumn("target", F.when(above, F.col("cap").cast("double")).otherwise(share)).drop("cap")


def mix(documents: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> Mix:
    """Thresholds that take each source near its target, in whole copies of whole documents.

    ``full`` copies of all rows and one more of each row with ``hash < below``.
    """
    narrow = documents.select(
        F.col(id_column).alias("id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), row_hash(id_column, text).alias("hash")
    )
    rows = write_and_read(narrow, "mix-rows")
    sources = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs)
    size = F.greatest("source_size", F.lit(1))
    full = F.floor(F.col("target") / size)
    state = write_and_read(
        sources.withColumn("full", full)
        .withColumn("rest", F.col("target") - full * F.col("source_size"))
        .withColumn("below", F.lit(0).cast("long"))
        .withColumn("done", F.col("rest") <= 0),
        "mix-level",
    )
    for level in range(LEVELS):
        if not level or state.filter("not done").limit(1).count():
            state = write_and_read(_refine(rows, state, level), "mix-level")
    return Mix(rows, state.select("source", "source_size", "weight", "target", "full", "below"))


def _refine(rows: DataFrame, state: DataFrame, level: int) -> DataFrame:
    """Move each threshold to the start of the bucket in which its budget ends; ``rest`` is what the
    bucket may still take. At the last level one bucket is one hash: it is taken if that is nearer."""
    shift = HASH_BITS - LEVEL_BITS * (level + 1)
    width = 1 << shift
    open_ = state.filter("not done").select(F.col("source").alias("s"), "below")
    inside = (F.col("hash") >= F.col("below")) & (F.col("hash") < F.col("below") + (width << LEVEL_BITS))
    buckets = (
        rows.filter("size > 0").join(open_, F.col("source").eqNullSafe(F.col("s")) & inside)
        .groupBy("source", F.shiftright("hash", shift).alias("bucket"))
        .agg(F.sum("size").alias("words"))
        .withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("bucket")))
    )
    budget = state.select(F.col("source").alias("s"), "rest")
    first = (
        buckets.join(budget, F.col("source").eqNullSafe(F.col("s"))).filter(F.col("upto") > F.col("rest"))
        .groupBy("source").agg(F.min_by(F.struct("bucket", "words", "upto"), "bucket").alias("end"))
        .select(F.col("source").alias("s"), "end")
    )
    last = F.lit(level == LEVELS - 1)
    before = F.col("end.upto") - F.col("end.words")
    nearer = last & (F.col("end.upto") - F.col("rest") < F.col("rest") - before)
    found = ~F.col("done") & F.col("end").isNotNull()
    return (
        state.join(first, F.col("source").eqNullSafe(F.col("s")), "left")
        .withColumn("below", F.when(found, F.col("end.bucket") * width + F.when(nearer, 1).otherwise(0))
                    .when(~F.col("done"), F.col("below") + (width << LEVEL_BITS)).otherwise(F.col("below")))
        .withColumn("rest", F.when(found, F.col("rest") - before).otherwise(F.col("rest")))
        .withColumn("done", F.col("done") | F.col("end").isNull())
        .drop("s", "end")
    )


def copies(full, below, hash_):
    return (full + F.when(hash_ < below, 1).otherwise(0)).cast("int")


def mixed_sizes(plan: Mix) -> DataFrame:
    """One row per document with the words that the mix takes of it."""
    limits = plan.thresholds.withColumnRenamed("source", "s")
    taken = copies(F.col("full"), F.col("below"), F.col("hash")) * F.col("size")
    return plan.rows.join(limits, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", taken.cast("long").alias("taken")
    )


def mixed_documents(documents: DataFrame, plan: Mix, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The documents as often as the mix takes them; columns as given."""
    limits = plan.thresholds.select(F.col("source").alias("_mix_source"), F.col("full").alias("_mix_full"), F.col("below").alias("_mix_below"))
    number = copies(F.col("_mix_full"), F.col("_mix_below"), row_hash(id_column, text))
    return (
        documents.join(limits, F.col(source).eqNullSafe(F.col("_mix_source")))
        .withColumn("_mix_copies", number)
        .filter("_mix_copies > 0")
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies"))))
        .select(*[documents[c] for c in documents.columns])
    )
