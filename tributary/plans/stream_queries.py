"""Streaming queries: given tables are written as files and streamed to completion."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F

from tributary.operators import cdc
from tributary.plans.derived import BILLION, change_messages, source_orders
from tributary.plans.registry import query
from tributary.plans.sql import cte, with_
from tributary.sources import scans
from tributary.storage import remove, run_path, write_and_read
from tributary.streaming import jobs, keyed
from tributary.tables import Tables

DELIVERIES = 4
ROW_GROUP = 16 << 20  # bytes; a batch of few files is then read by many tasks
EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING"

cte(
    "cdc_events",
    """SELECT topic, part, off, lsn, op, k, TIMESTAMP '2023-11-14 22:13:20' + INTERVAL 1 MILLISECOND * (lsn % 1000000000) AS ts FROM
    (SELECT b.topic, b.part, b.off, e.lsn, e.op, e.k FROM cdc_raw b JOIN cdc_ev e ON b.off = e.lsn)""",
    "cdc_raw",
    "cdc_ev",
)


def event_files(t: Tables, fmt: str = "parquet") -> str:
    path = run_path(t.spark, "event-files")
    rows = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    rows.repartition(8).write.format(fmt).save(path)
    return path


def deliveries(rows: DataFrame, time: str, again: Column | None = None) -> Iterator[str]:
    """Write rows into one folder in DELIVERIES parts by ascending ``time``; yields the folder after each.

    Rows of a part that meet ``again`` are delivered a second time with the next part.
    """
    path = run_path(rows.sparkSession, "deliveries")
    kept = [c for c in rows.columns if c not in ("arrival", "time")]
    rows = write_and_read(rows, "undelivered")
    cuts = rows.agg(F.percentile_approx(time, [i / DELIVERIES for i in range(1, DELIVERIES)], 100)).first()[0] or []
    bounds = [None, *cuts, None]
    previous = None
    for low, high in zip(bounds, bounds[1:]):
        part = rows if low is None else rows.filter(F.col(time) > F.lit(low))
        part = part if high is None else part.filter(F.col(time) <= F.lit(high))
        sent = part if previous is None or again is None else part.unionByName(previous.filter(again))
        sent.select(*kept).write.mode("append").parquet(path)
        previous = part
        yield path


def event_deliveries(t: Tables) -> Iterator[str]:
    return deliveries(t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type"), "ts")


def event_stream(t: Tables, files_per_batch: int | None = 2) -> DataFrame:
    return scans.file_stream(t.spark, event_files(t), EVENT_SCHEMA, files_per_batch=files_per_batch)


def ntz(*columns: str):
    return [F.col(c).cast("timestamp_ntz").alias(c) for c in columns]


@query(
    "stm_01_tumbling_windows",
    'SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS "end", count(*) AS n FROM events GROUP BY 1, 2',
)
def tumbling_windows(t: Tables) -> DataFrame:
    """Update mode: each batch writes the windows it changed. Deliveries come in event-time order,
    so a short delay loses nothing, however long the history."""
    path = run_path(t.spark, "tumbling")
    for source in event_deliveries(t):
        counts = jobs.window_counts(scans.file_stream(t.spark, source, EVENT_SCHEMA), "ts", "1 minute", "1 hour")
        jobs.run_available(counts, jobs.batch_folder(f"{path}/out"), f"{path}/checkpoint", "update")
    final = jobs.latest_updates(t.spark.read.parquet(f"{path}/out"), ["start", "end"], ["n"])
    return final.select(*ntz("start", "end"), "n")


@query(
    "stm_02_sliding_windows",
    """SELECT s AS start, s + INTERVAL 2 HOUR AS "end", event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 1 HOUR, ts),
    time_bucket(INTERVAL 1 HOUR, ts) - INTERVAL 1 HOUR]) AS s FROM events) GROUP BY 1, 2, 3""",
)
def sliding_windows(t: Tables) -> DataFrame:
    path = run_path(t.spark, "sliding")
    for source in event_deliveries(t):
        counts = jobs.window_counts(scans.file_stream(t.spark, source, EVENT_SCHEMA), "ts", "1 minute", "2 hours", "1 hour", ("event_type",))
        jobs.run_available(counts, jobs.batch_folder(f"{path}/out"), f"{path}/checkpoint", "update")
    final = jobs.latest_updates(t.spark.read.parquet(f"{path}/out"), ["start", "end", "event_type"], ["n"])
    return final.select(*ntz("start", "end"), "event_type", "n")


@query("stm_03_run_to_completion", "SELECT event_type, count(*) AS n, CAST(4 AS INTEGER) AS batches FROM events GROUP BY 1")
def run_to_completion(t: Tables) -> DataFrame:
    """JSON files in four batches; the cumulative result is rewritten by each."""
    path = run_path(t.spark, "cumulative")
    source = event_files(t, "json")
    files = len(t.spark.read.schema(EVENT_SCHEMA).json(source).inputFiles())
    stream = scans.file_stream(t.spark, source, EVENT_SCHEMA, "json", files_per_batch=math.ceil(files / 4))
    counted = stream.groupBy("event_type").agg(F.count("*").alias("n"))
    done = jobs.run_available(counted, jobs.complete_folder(f"{path}/out"), f"{path}/checkpoint", "complete")
    return t.spark.read.parquet(f"{path}/out").withColumn("batches", F.lit(jobs.data_batches(done)))


@query("stm_04_restart", "SELECT CAST(1 AS INTEGER) AS run, (SELECT count(*) FROM events) AS n UNION ALL SELECT 2, 0")
def restart(t: Tables) -> DataFrame:
    """The second run finds nothing new behind its checkpoint."""
    path = run_path(t.spark, "restart")
    source = event_files(t)

    def run(n: int) -> DataFrame:
        stream = scans.file_stream(t.spark, source, EVENT_SCHEMA).withColumn("run", F.lit(n))
        jobs.run_available(stream, jobs.batch_folder(f"{path}/out"), f"{path}/checkpoint")
        return t.spark.read.parquet(f"{path}/out").filter(F.col("run") == n).agg(F.lit(n).alias("run"), F.count("*").alias("n"))

    first, second = run(1), run(2)
    return first.unionByName(second)


@query(
    "stm_05_output_modes",
    """SELECT 'append' AS mode, 'STREAMING_OUTPUT_MODE.UNSUPPORTED_OPERATION' AS outcome, CAST(0 AS BIGINT) AS groups
    UNION ALL SELECT 'update', 'ok', count(DISTINCT event_type) FROM events UNION ALL SELECT 'complete', 'ok', count(DISTINCT event_type) FROM events""",
)
def output_modes(t: Tables) -> DataFrame:
    """An aggregate without a watermark can be updated or completed, never appended."""
    path = run_path(t.spark, "modes")
    source = event_files(t)
    results = []
    for mode in ("append", "update", "complete"):
        counted = scans.file_stream(t.spark, source, EVENT_SCHEMA).groupBy("event_type").agg(F.count("*").alias("n"))
        try:
            jobs.run_available(counted, jobs.complete_folder(f"{path}/{mode}"), f"{path}/checkpoint-{mode}", mode)
            stored = t.spark.read.parquet(f"{path}/{mode}").agg(F.count("*").alias("groups"))
            results.append(stored.select(F.lit(mode).alias("mode"), F.lit("ok").alias("outcome"), "groups"))
        except AnalysisException as error:
            none = t.events.agg(F.count_if(F.lit(False)).alias("groups"))
            results.append(none.select(F.lit(mode).alias("mode"), F.lit(error.getCondition()).alias("outcome"), "groups"))
    return results[0].unionByName(results[1]).unionByName(results[2])


MESSAGE_SCHEMA = scans.MESSAGES


def message_files(t: Tables, *parts) -> str:
    """Messages as files of one folder, one write per part of the log."""
    path = run_path(t.spark, "messages")
    messages = change_messages(t)
    for part in parts or (F.lit(True),):
        messages.filter(part).write.option("parquet.block.size", ROW_GROUP).mode("append").parquet(path)
    return path


@query(
    "stm_06_bounded_disorder",
    with_("cdc_events", "SELECT time_bucket(INTERVAL 5 SECOND, ts) AS start, op, count(*) AS n FROM cdc_events GROUP BY 1, 2"),
)
def bounded_disorder(t: Tables) -> DataFrame:
    """Append mode on source time, 5 s behind the newest event. Every second change is delivered
    as if 3 s later, so each delivery goes back behind the one before; a closing event far
    ahead moves the watermark past every window."""
    path = run_path(t.spark, "disorder")

    def run(source: str) -> None:
        changes = cdc.flatten(cdc.parse_envelopes(scans.file_stream(t.spark, source, MESSAGE_SCHEMA)))
        timed = changes.withColumn("ts", F.timestamp_millis("source_ts_ms"))
        counts = jobs.window_counts(timed, "ts", "5 seconds", "5 seconds", keys=("op",))
        jobs.run_available(counts, jobs.batch_folder(f"{path}/out"), f"{path}/checkpoint")

    arrival = F.col("offset") % BILLION + 3000 * (F.col("offset") % 2)
    for source in deliveries(change_messages(t).withColumn("arrival", arrival), "arrival"):
        run(source)
    closing = F.lit('{"before":null,"after":null,"source":{},"op":"closing","ts_ms":4000000000000}')
    t.spark.range(1).select(F.lit("shop.public.orders").alias("topic"), F.lit(0).alias("partition"), F.lit(9 * BILLION).alias("offset"), closing.alias("value")).write.mode("append").parquet(source)
    run(source)
    return t.spark.read.parquet(f"{path}/out").select(*ntz("start"), "op", "n")


@query(
    "stm_07_late_rows",
    with_(
        "cdc_events",
        """SELECT time_bucket(INTERVAL 5 SECOND, ts) AS start, 'public.orders' AS source_table, op, count(*) FILTER (WHERE NOT late) AS on_time,
        count(*) FILTER (WHERE late) AS late FROM (SELECT *, lsn >= 2000000000 AND ts < (SELECT max(ts) FROM cdc_events WHERE lsn < 2000000000) - INTERVAL 5 SECOND AS late
        FROM cdc_events) GROUP BY 1, 2, 3""",
    ),
)
def late_rows(t: Tables) -> DataFrame:
    """Two deliveries; the second goes back in time, and what lies 5 s behind is late."""
    path = run_path(t.spark, "late")
    source = run_path(t.spark, "deliveries")
    for part in (F.col("offset") < 2 * BILLION, F.col("offset") >= 2 * BILLION):
        change_messages(t).filter(part).write.mode("append").parquet(source)
        changes = cdc.flatten(cdc.parse_envelopes(scans.file_stream(t.spark, source, MESSAGE_SCHEMA)))
        timed = changes.withColumn("ts", F.timestamp_millis("source_ts_ms"))
        jobs.windowed_with_late(timed, "ts", "5 SECONDS", "5 seconds", ["source_table", "op"], path, f"{path}/checkpoint")
    totals = jobs.window_totals(path, t.spark, ["source_table", "op"])
    return totals.select(*ntz("start"), "source_table", "op", "on_time", "late")


@query("stm_08_bronze_ingestion", with_("bronze", "SELECT source_table, op, kafka_partition, kafka_offset, lsn, row_json FROM bronze"))
def bronze_ingestion(t: Tables) -> DataFrame:
    path = run_path(t.spark, "bronze")
    messages = scans.file_stream(t.spark, message_files(t), MESSAGE_SCHEMA)
    jobs.bronze_stream(messages, f"{path}/table", f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/table").select("source_table", "op", "kafka_partition", "kafka_offset", "lsn", "row_json")


@query("stm_09_streaming_dedup", with_("bronze_once", "SELECT kafka_partition, kafka_offset, op FROM bronze_once"))
def streaming_dedup(t: Tables) -> DataFrame:
    """Deliveries in time order; each brings some messages of the one before again."""
    path = run_path(t.spark, "dedup")
    messages = change_messages(t).withColumn("time", F.col("offset") % BILLION)
    for source in deliveries(messages, "time", again=F.col("offset") % 7 == 0):
        changes = cdc.flatten(cdc.parse_envelopes(scans.file_stream(t.spark, source, MESSAGE_SCHEMA)))
        jobs.run_available(jobs.drop_redelivered_stream(changes, "1 hour"), jobs.batch_folder(f"{path}/out"), f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").select("kafka_partition", "kafka_offset", "op")


@query("stm_10_keyed_state", with_("current_state", "SELECT id, lsn, row_json ->> '$.status' AS status FROM current_state"))
def keyed_state(t: Tables) -> DataFrame:
    """Newer changes are delivered first, so later batches bring older lsn values, also behind
    a merge of the batches before."""
    path = run_path(t.spark, "state")
    source = message_files(t, F.col("offset") >= 2 * BILLION, F.col("offset") < 2 * BILLION)
    keyed.keyed_state(scans.file_stream(t.spark, source, MESSAGE_SCHEMA, files_per_batch=4), f"{path}/out", f"{path}/checkpoint", merge_every=2)
    state = keyed.read_keyed_state(t.spark, f"{path}/out")
    return state.select(F.col("id").cast("bigint").alias("id"), "lsn", F.get_json_object("row_json", "$.status").alias("status"))


@query("stm_11_exactly_once", "SELECT event_type, count(*) AS n, CAST(1 AS INTEGER) AS replayed FROM events GROUP BY 1")
def exactly_once(t: Tables) -> DataFrame:
    """The last batch loses its commit, as in a crash after its write; the restarted query
    plans and writes it again, and nothing doubles."""
    path = run_path(t.spark, "replay")
    source = event_files(t)
    write = jobs.batch_folder(f"{path}/out")
    run = lambda: jobs.run_available(scans.file_stream(t.spark, source, EVENT_SCHEMA, files_per_batch=2), write, f"{path}/checkpoint")
    last = run().lastProgress["batchId"]
    for name in (f"{last}", f".{last}.crc"):
        remove(t.spark, f"{path}/checkpoint/commits/{name}")
    replayed = jobs.data_batches(run())
    counted = t.spark.read.parquet(f"{path}/out").groupBy("event_type").agg(F.count("*").alias("n"))
    return counted.withColumn("replayed", F.lit(replayed))


@query("snk_07_bronze_append", with_("bronze", "SELECT op, 2 * count(*) AS n FROM bronze GROUP BY 1"))
def bronze_append(t: Tables) -> DataFrame:
    """The folder appears with the first append; a second delivery adds to it."""
    path = run_path(t.spark, "bronze-append")
    for delivery in range(2):
        rows = cdc.to_bronze(cdc.flatten(cdc.parse_envelopes(change_messages(t)))).withColumn("ingest_date", F.to_date("ingest_ts"))
        rows.write.mode("append").partitionBy("ingest_date").parquet(path)
    return t.spark.read.parquet(path).groupBy("op").agg(F.count("*").alias("n"))


@query("snk_08_batch_writer", "SELECT count(*) AS n, count(DISTINCT event_id) AS ids, true AS all_in_batches FROM events")
def batch_writer(t: Tables) -> DataFrame:
    path = run_path(t.spark, "batches")
    jobs.run_available(event_stream(t, 2), jobs.batch_folder(f"{path}/out"), f"{path}/checkpoint")
    stored = t.spark.read.parquet(f"{path}/out")
    return stored.agg(
        F.count("*").alias("n"), F.count_distinct("event_id").alias("ids"), (F.count_distinct("batch_id") > 1).alias("all_in_batches")
    )


@query("snk_09_memory_sink", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def memory_sink(t: Tables) -> DataFrame:
    """Only for results as small as this one: the table lives in the driver."""
    name = run_path(t.spark, "memory").rsplit("/", 1)[-1].replace("-", "_")
    counted = event_stream(t, 4).groupBy("event_type").agg(F.count("*").alias("n"))
    done = counted.writeStream.format("memory").queryName(name).outputMode("complete").trigger(availableNow=True).start()
    done.awaitTermination()
    return t.spark.table(name)


@query("src_07_file_stream", "SELECT count(*) AS n, CAST(4 AS INTEGER) AS batches FROM events")
def file_stream(t: Tables) -> DataFrame:
    path = run_path(t.spark, "file-stream")
    done = jobs.run_available(event_stream(t, 2), jobs.batch_folder(f"{path}/out"), f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").agg(F.count("*").alias("n")).withColumn("batches", F.lit(jobs.data_batches(done)))


@query("src_09_message_stream", with_("cdc_raw", 'SELECT topic, part AS partition, off AS "offset", v AS value FROM cdc_raw'))
def message_stream(t: Tables) -> DataFrame:
    """The four message columns through a stream; the broker source yields the same ones."""
    path = run_path(t.spark, "message-stream")
    jobs.run_available(scans.file_stream(t.spark, message_files(t), MESSAGE_SCHEMA), jobs.batch_folder(f"{path}/out"), f"{path}/checkpoint")
    return t.spark.read.parquet(f"{path}/out").drop("batch_id")


@query(
    "pip_09_change_capture",
    with_("source_orders", "SELECT 'same' AS verdict, count(*) AS n FROM source_orders"),
)
def change_capture(t: Tables) -> DataFrame:
    """Message stream → bronze files → deduplicated → current state → compared with the source."""
    path = run_path(t.spark, "capture")
    jobs.bronze_stream(scans.file_stream(t.spark, message_files(t), MESSAGE_SCHEMA), f"{path}/bronze", f"{path}/checkpoint")
    bronze = t.spark.read.parquet(f"{path}/bronze")
    lake = cdc.order_fields(cdc.current_state(bronze))
    verdicts = cdc.reconcile(lake, source_orders(t), "id", ["customer_id", "status", "amount"])
    return verdicts.groupBy("verdict").agg(F.count("*").alias("n"))

