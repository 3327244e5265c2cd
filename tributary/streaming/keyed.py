"""Current state per key of a change stream, on Spark's state store.

The state of a key is its newest event by (lsn, offset), so an older change that arrives late
loses. Without a retention the state is a streaming aggregate, all in the JVM, and deleted keys
stay in it for ever. With one, an arbitrary stateful operator drops a deleted key by a timer,
``retention`` after the delete was processed, with the next batch that has data; a change may
then come up to ``retention`` after a newer delete of its key. That costs a Python call per key
and batch. Keys that are present have no timer.

The sink is two rings of folders that overwrite themselves: the winners of the latest batches,
and two merged tables. Storage grows with the keys, not with the batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tributary.operators import cdc
from tributary.storage import settings
from tributary.streaming.jobs import run_available

KEY = ["source_table", "id"]
POSITION = ["lsn", "kafka_offset"]
EVENT = ["op", "deleted", "row_json", "source_ts_ms", *POSITION]
EVENT_SCHEMA = "op STRING, deleted BOOLEAN, row_json STRING, source_ts_ms BIGINT, lsn BIGINT, kafka_offset BIGINT"
KEYED_SCHEMA = f"source_table STRING, id STRING, {EVENT_SCHEMA}"
EXPIRED = "expired"  # operation of the row that a dropped tombstone leaves in the sink
STATE_STORE = {
    # On local disk of the executors with snapshots in the checkpoint: state may exceed their memory.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Timers of processing time would start batches without data for ever; they fire with the next data.
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def keyed_events(messages: DataFrame, key_fields: str | list[str] = "id") -> DataFrame:
    """Accepted changes with their key. A truncate has no key; it is the event of the null key of its table."""
    changes = cdc.flatten(cdc.parse_envelopes(messages))
    truncate = F.col("op") == "t"
    rows = changes.withColumn("id", F.when(~truncate, cdc.row_key(key_fields))).filter(F.col("id").isNotNull() | truncate)
    return rows.withColumn("kafka_offset", F.coalesce("kafka_offset", F.lit(-1).cast("bigint"))).select(*KEY, *EVENT)


def newest_per_batch(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Map-side combine: one row per key and Arrow batch, so a hot key shuffles little."""
    for frame in frames:
        yield frame.sort_values(POSITION, kind="stable").drop_duplicates(KEY, keep="last")


def _event(row: pd.Series) -> tuple:
    return row["op"], bool(row["deleted"]), row["row_json"], int(row["source_ts_ms"]), int(row["lsn"]), int(row["kafka_offset"])


def _advance(retention_ms: int) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            _, _, _, *rest = state.get
            state.remove()
            yield pd.DataFrame([(*key, EXPIRED, True, None, *rest)], columns=[*KEY, *EVENT])
            return
        held = tuple(state.get) if state.exists else None
        newest = held
        for frame in frames:
            event = _event(frame.sort_values(POSITION, kind="stable").iloc[-1])
            if newest is None or event[-2:] > newest[-2:]:
                newest = event
        if newest[1]:
            state.setTimeoutDuration(retention_ms)  # a call clears the timer, so it is set each time
        if newest is not held:
            state.update(newest)
            yield pd.DataFrame([(*key, *newest)], columns=[*KEY, *EVENT])

    return advance


def winners(messages: DataFrame, retention_ms: int | None = None, key_fields: str | list[str] = "id") -> DataFrame:
    """Stream of the keys that the batch touches, with their newest event."""
    events = keyed_events(messages, key_fields)
    if retention_ms is None:
        newest = F.max_by(F.struct(*EVENT), F.struct(*POSITION))
        return events.groupBy(*KEY).agg(newest.alias("e")).select(*KEY, "e.*")
    combined = events.mapInPandas(newest_per_batch, KEYED_SCHEMA)
    return combined.groupBy(*KEY).applyInPandasWithState(
        _advance(retention_ms), KEYED_SCHEMA, EVENT_SCHEMA, "update", GroupStateTimeout.ProcessingTimeTimeout
    )


def keyed_state(
    messages: DataFrame, path: str, checkpoint: str, merge_every: int = 10, retention_ms: int | None = None, key_fields: str | list[str] = "id"
) -> StreamingQuery:
    """Process what has arrived and keep the current state under ``path``.

    A batch writes its winners; every ``merge_every`` batches they are merged with the last merged
    table. A ring holds twice that many batches and two merged tables, so the folder being
    overwritten is never one that a merge or a replay of the batch needs. ``merge_every`` must
    stay the same for one checkpoint, and so must the choice to have a retention.
    """
    spark = messages.sparkSession

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{path}/changes/slot={batch_id % (2 * merge_every)}")
        if (batch_id + 1) % merge_every == 0:
            slot = batch_id // merge_every % 2
            kept = _newest(spark, f"{path}/merged/slot={1 - slot}", f"{path}/changes", batch_id)
            kept.withColumn("upto", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{path}/merged/slot={slot}")

    spark.createDataFrame([], f"{KEYED_SCHEMA}, upto BIGINT").write.mode("ignore").parquet(f"{path}/merged/slot=1")
    with settings(spark, STATE_STORE):
        return run_available(winners(messages, retention_ms, key_fields), write, checkpoint, "update")


def _newest(spark: SparkSession, merged_path: str, changes_path: str, last: int | None = None) -> DataFrame:
    """Newest event per key of the newest merged table below ``merged_path`` and of the batches since, up to ``last``."""
    merged = spark.read.schema(f"{KEYED_SCHEMA}, upto BIGINT").parquet(merged_path).select(*KEY, *EVENT, "upto")
    changes = spark.read.schema(f"{KEYED_SCHEMA}, batch_id BIGINT").parquet(changes_path).select(*KEY, *EVENT, "batch_id")
    if last is not None:
        merged, changes = merged.filter(F.col("upto") < last), changes.filter(F.col("batch_id") <= last)
    upto = merged.agg(F.coalesce(F.max("upto"), F.lit(-1))).first()[0]  # -1: no merged table holds a key yet
    since = changes.filter(F.col("batch_id") > upto)
    rows = merged.filter(F.col("upto") == upto).withColumnRenamed("upto", "batch_id").unionByName(since)
    newest = F.max_by(F.struct(*EVENT), "batch_id")  # later winners of a key replace earlier ones
    return rows.groupBy(*KEY).agg(newest.alias("e")).select(*KEY, "e.*").filter(F.col("op") != EXPIRED)


def read_keyed_state(spark: SparkSession, path: str) -> DataFrame:
    """Keys that are present: neither deleted nor older than the last truncate of their table."""
    newest = _newest(spark, f"{path}/merged", f"{path}/changes")
    return cdc.since_truncate(newest.filter(F.col("id").isNotNull() & ~F.col("deleted")), newest)
