"""Structured Streaming jobs: windows, late rows, deduplication, bronze ingestion. ``keyed`` holds the keyed state.

Every sink is a folder written per batch id, so a replayed batch replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.operators import cdc

BatchWriter = Callable[[DataFrame, int], None]


def run_available(stream: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process everything that has arrived, batch by batch, and stop."""
    query = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_periodic(stream: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "update", every: str = "5 seconds") -> StreamingQuery:
    """Long-running form: one batch per interval until stopped."""
    return stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def batch_folder(path: str) -> BatchWriter:
    """Writer that keeps each batch under its own id and overwrites it on replay."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def complete_folder(path: str) -> BatchWriter:
    """Writer for complete mode: the last batch is the whole result."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return write


def window_counts(stream: DataFrame, ts: str, delay: str, length: str, slide: str | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows per event-time window; ``delay`` bounds both the lateness and the kept state."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    counted = stream.withWatermark(ts, delay).groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n")


def latest_updates(updates: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Final value per key of an update-mode sink written by ``batch_folder``."""
    newest = F.max_by(F.struct(*values), F.col("batch_id"))
    return updates.groupBy(*keys).agg(newest.alias("v")).select(*keys, "v.*")


def late_rows(batch: DataFrame, ts: str, high_water: DataFrame, delay: str) -> Column:
    """True for rows older than the newest time of earlier batches minus ``delay``."""
    limit = high_water.agg(F.max("ts") - F.expr(f"INTERVAL {delay}")).scalar()
    return F.coalesce(F.col(ts) < limit, F.lit(False))


def windowed_with_late(stream: DataFrame, ts: str, delay: str, length: str, keys: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """Counts per window and keys with late rows counted apart.

    Each batch stores its partial counts and the newest event time so far; ``window_totals``
    adds the parts. The only state between batches is that one time.
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read once for both outputs
        mark = spark.read.schema("ts TIMESTAMP").parquet(f"{path}/marks/batch_id={batch_id - 1}")
        late = late_rows(batch, ts, mark, delay)
        counted = batch.withColumn("late", late).groupBy(F.window(ts, length).alias("w"), *keys, "late").agg(F.count("*").alias("n"))
        counted.select(F.col("w.start").alias("start"), *keys, "late", "n").write.mode("overwrite").parquet(f"{path}/counts/batch_id={batch_id}")
        newest = batch.select(F.col(ts).alias("ts")).unionByName(mark).agg(F.max("ts").alias("ts"))
        newest.write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")
        batch.unpersist()

    # Before the first batch there is no newest time.
    spark.range(0).select(F.lit(None).cast("timestamp").alias("ts")).write.mode("ignore").parquet(f"{path}/marks/batch_id=-1")
    return run_available(stream, write, checkpoint)


def window_totals(path: str, spark, keys: list[str]) -> DataFrame:
    parts = spark.read.parquet(f"{path}/counts")
    return parts.groupBy("start", *keys).agg(
        F.coalesce(F.sum(F.when(~F.col("late"), F.col("n"))), F.lit(0)).alias("on_time"),
        F.coalesce(F.sum(F.when(F.col("late"), F.col("n"))), F.lit(0)).alias("late"),
    )


def bronze_stream(messages: DataFrame, path: str, checkpoint: str, skip_snapshot: bool = False) -> StreamingQuery:
    """Messages → flat changes → append-only bronze files by ingest day, in one query."""
    changes = cdc.skip_snapshots(cdc.flatten(cdc.parse_envelopes(messages)), skip_snapshot)
    rows = cdc.to_bronze(changes).withColumn("ingest_date", F.to_date("ingest_ts"))
    query = (
        rows.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("ingest_date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def drop_redelivered_stream(changes: DataFrame, delay: str) -> DataFrame:
    """First copy of each message coordinate; state is dropped ``delay`` behind event time."""
    timed = changes.withColumn("event_ts", F.timestamp_millis("source_ts_ms")).withWatermark("event_ts", delay)
    return timed.dropDuplicatesWithinWatermark(["kafka_topic", "kafka_partition", "kafka_offset"])


def data_batches(query: StreamingQuery) -> int:
    """Batches of this run that read any input."""
    return sum(1 for p in query.recentProgress if p["numInputRows"] > 0)
