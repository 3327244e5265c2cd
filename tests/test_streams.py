import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tributary.plans import stream_queries
from tributary.sources import scans
from tributary.storage import run_path
from tributary.streaming import keyed


class LongHistory:
    """One event every hour of 120 days."""

    def __init__(self, spark):
        self.spark = spark
        start = F.lit("2023-01-01").cast("timestamp_ntz")
        self.events = spark.range(120 * 24).select(
            F.col("id").alias("event_id"),
            (start + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("ts"),
            (F.col("id") % 5).alias("user_id"),
            F.lit("view").alias("event_type"),
        )


def test_no_row_of_a_long_history_is_late(spark):
    history = LongHistory(spark)
    counted = stream_queries.tumbling_windows(history)
    assert counted.agg(F.count("*"), F.sum("n")).first() == (120 * 24, 120 * 24)
    assert stream_queries.sliding_windows(history).agg(F.sum("n")).first()[0] == 2 * 120 * 24


def test_deliveries_hold_every_row_and_the_repeated_ones(spark):
    rows = spark.range(1000).select(F.col("id").alias("offset"), (F.col("id") % 100).alias("time"))
    *_, path = stream_queries.deliveries(rows, "time", again=F.col("offset") % 10 == 0)
    stored = spark.read.parquet(path)
    assert stored.columns == ["offset"] and stored.distinct().count() == 1000 and 1000 < stored.count() < 1100


def change(op, key, lsn):
    image = {"id": key, "lsn": lsn}
    before, after = (image, None) if op == "d" else (None, image)
    return json.dumps({"before": before, "after": after, "source": {"schema": "s", "table": "t", "lsn": lsn}, "op": op, "ts_ms": lsn})


def deliver(spark, source, batch, n):
    rows = [("t", 0, 10 * n + i, change(*event)) for i, event in enumerate(batch)]
    spark.createDataFrame(rows, scans.MESSAGES).coalesce(1).write.mode("append").parquet(source)


def advance(spark, source, path, **options):
    keyed.keyed_state(scans.file_stream(spark, source, scans.MESSAGES), path, f"{path}-checkpoint", **options)
    return {r["id"]: r["lsn"] for r in keyed.read_keyed_state(spark, path).collect()}


WITH_AND_WITHOUT_TIMERS = pytest.mark.parametrize("retention_ms", [None, 3_600_000])


@WITH_AND_WITHOUT_TIMERS
def test_state_survives_restarts_and_ignores_older_changes(spark, retention_ms):
    source, path = run_path(spark, "changes"), run_path(spark, "state")
    batches = [[("c", "a", 5), ("d", "b", 9)], [("u", "a", 4)], [("u", "b", 7), ("c", "c", 1)], [("u", "c", 3), ("u", "a", 6)]]
    states = []
    for n, events in enumerate(batches):
        deliver(spark, source, events, n)
        states.append(advance(spark, source, path, merge_every=2, retention_ms=retention_ms))  # every run restarts from the checkpoint
    assert states == [{"a": 5}, {"a": 5}, {"a": 5, "c": 1}, {"a": 6, "c": 3}]
    merged = spark.read.parquet(f"{path}/merged").filter("upto = 3").collect()
    assert {(r["id"], r["deleted"], r["lsn"]) for r in merged} == {("a", False, 6), ("b", True, 9), ("c", False, 3)}


def test_storage_of_the_state_is_bounded(spark):
    source, path = run_path(spark, "changes"), run_path(spark, "state")
    for n in range(9):
        deliver(spark, source, [("u", "a", n), ("u", f"k{n % 3}", n)], n)
        state = advance(spark, source, path, merge_every=2)
    assert state == {"a": 8, "k0": 6, "k1": 7, "k2": 8}
    changes, merged = spark.read.parquet(f"{path}/changes"), spark.read.parquet(f"{path}/merged")
    assert changes.select("batch_id").distinct().count() == 4 and changes.count() <= 8
    assert {r["upto"] for r in merged.select("upto").distinct().collect()} == {5, 7} and merged.count() == 8


def test_timer_drops_a_tombstone(spark):
    source, path = run_path(spark, "changes"), run_path(spark, "state")
    for n, events in enumerate([[("c", "a", 1), ("d", "b", 9)], [("c", "x", 2)], [("c", "y", 3)], [("c", "b", 7)]]):
        deliver(spark, source, events, n)
        state = advance(spark, source, path, merge_every=2, retention_ms=1)
    assert state == {"a": 1, "x": 2, "y": 3, "b": 7}  # the delete of b is forgotten, as the retention says
    assert spark.read.parquet(f"{path}/merged").filter("upto = 3 AND deleted").count() == 0


@WITH_AND_WITHOUT_TIMERS
def test_truncate_empties_the_streamed_table(spark, retention_ms):
    source, path = run_path(spark, "changes"), run_path(spark, "state")
    for n, events in enumerate([[("c", "a", 1), ("c", "b", 8)], [("t", None, 5)], [("c", "c", 4), ("c", "d", 6)]]):
        deliver(spark, source, events, n)
        state = advance(spark, source, path, merge_every=2, retention_ms=retention_ms)
    assert state == {"b": 8, "d": 6}


def test_combine_keeps_the_newest_row_of_each_key():
    columns = [*keyed.KEY, *keyed.EVENT]
    rows = [("t", key, "u", False, None, 0, lsn, offset) for key, lsn, offset in [("a", 2, 1), ("a", 2, 3), ("a", 1, 9), (None, 1, 4), (None, 3, 2)]]
    (kept,) = keyed.newest_per_batch(iter([pd.DataFrame(rows, columns=columns)]))
    assert {(r.id, r.lsn, r.kafka_offset) for r in kept.itertuples()} == {("a", 2, 3), (None, 3, 2)}
