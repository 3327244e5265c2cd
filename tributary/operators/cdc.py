"""Change-data capture: envelopes, the append-only bronze log, current state and history.

Input messages carry ``topic, partition, offset, value``; ``value`` is one JSON
envelope ``{before, after, source{schema, table, lsn}, op, ts_ms}``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tributary.operators.ordered import HOT_ROWS, ordered_scan

# Numbers stay text until cast, so 20-digit values survive; before/after stay raw JSON.
ENVELOPE = (
    "before STRING, after STRING, source STRUCT<schema: STRING, `table`: STRING, lsn: STRING>, "
    "op STRING, ts_ms STRING, _corrupt_record STRING"
)

# Operation codes and their names.
OP_NAMES = {"c": "create", "u": "update", "d": "delete", "r": "snapshot", "t": "truncate"}

BRONZE_COLUMNS = [
    "source_table", "op", "deleted", "source_ts_ms", "lsn", "kafka_topic", "kafka_partition",
    "kafka_offset", "row_json", "before_json", "after_json", "ingest_ts",
]


def parse_envelopes(messages: DataFrame, strict: bool = True, blank_is_tombstone: bool = True) -> DataFrame:
    """Add parsed fields and ``status`` in {ok, tombstone, malformed}; never fails on bad input.

    strict: ``source`` is required besides ``op``.
    """
    value = F.col("value").cast("string")
    envelope = F.from_json(value, ENVELOPE, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    empty = F.trim(value) == "" if blank_is_tombstone else value == ""
    rejected = F.col("e").isNull() | F.col("e._corrupt_record").isNotNull() | F.col("e.op").isNull()
    if strict:
        rejected = rejected | F.col("e.source").isNull()
    text = lambda c: F.coalesce(c, F.lit(""))
    number = lambda c: F.coalesce(c.try_cast("bigint"), F.lit(0).cast("bigint"))
    # As the output of a generator each envelope is parsed once; inlined into the columns
    # and filters below, it would be parsed once for every field.
    once = messages.select(
        "topic", "partition", "offset", (value.isNull() | empty).alias("empty"), F.explode(F.array(envelope)).alias("e")
    )
    return once.select(
        "topic",
        "partition",
        "offset",
        F.when(F.col("empty"), "tombstone").when(rejected, "malformed").otherwise("ok").alias("status"),
        F.col("e.op").alias("op"),
        F.concat(text(F.col("e.source.schema")), F.lit("."), text(F.col("e.source.table"))).alias("source_table"),
        number(F.col("e.source.lsn")).alias("lsn"),
        number(F.col("e.ts_ms")).alias("ts_ms"),
        F.col("e.before").alias("before_json"),
        F.col("e.after").alias("after_json"),
    )


def op_name(op: Column, with_truncate: bool = True) -> Column:
    """Readable operation name; an unknown code passes through."""
    names = {k: v for k, v in OP_NAMES.items() if with_truncate or k != "t"}
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, op), op)


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == "ok")


def flatten(parsed: DataFrame) -> DataFrame:
    """Fixed columns plus message coordinates; the row image is ``before`` of a delete, else ``after``."""
    deleted = F.col("op") == "d"
    return accepted(parsed).select(
        "source_table",
        "op",
        deleted.alias("deleted"),
        F.col("ts_ms").alias("source_ts_ms"),
        "lsn",
        F.col("topic").alias("kafka_topic"),
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.when(deleted, F.col("before_json")).otherwise(F.col("after_json")).alias("row_json"),
        "before_json",
        "after_json",
    )


def skip_snapshots(changes: DataFrame, skip: bool = True) -> DataFrame:
    return changes.filter(F.col("op") != "r") if skip else changes


def to_bronze(changes: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    stamped = changes.withColumn("ingest_ts", F.current_timestamp() if ingest_ts is None else ingest_ts)
    return stamped.select(*BRONZE_COLUMNS)


def drop_redelivered(bronze: DataFrame) -> DataFrame:
    """At-least-once delivery: one row per message coordinate."""
    return bronze.dropDuplicates(["kafka_topic", "kafka_partition", "kafka_offset"])


def row_key(key_fields: str | list[str]) -> Column:
    """Key of a row image as text: the JSON text of the field, or a JSON list of the texts of
    several fields. NULL where any of them is missing or null."""
    names = [key_fields] if isinstance(key_fields, str) else list(key_fields)
    parts = [F.get_json_object("row_json", f"$['{name}']") for name in names]
    if len(parts) == 1:
        return parts[0]
    return F.when(reduce(Column.__and__, [p.isNotNull() for p in parts]), F.to_json(F.array(*parts)))


def keyed(bronze: DataFrame, key_fields: str | list[str] = "id") -> DataFrame:
    """Rows that name a key (a truncate does not), with the key as text in ``id``.

    ``keyless_counts`` counts the others.
    """
    return bronze.withColumn("id", row_key(key_fields)).filter(F.col("id").isNotNull())


def keyless_counts(bronze: DataFrame, key_fields: str | list[str] = "id") -> DataFrame:
    """Rows without a key, by table and operation: no state or history holds them."""
    return bronze.filter(row_key(key_fields).isNull()).groupBy("source_table", "op").count()


def latest_events(bronze: DataFrame, key_fields: str | list[str] = "id") -> DataFrame:
    """Newest event per table and key; a partial aggregate, so one hot key is no hot task.

    Redelivered copies are identical, so they need no separate pass.
    """
    newest = F.max_by(
        F.struct("op", "deleted", "row_json", "source_ts_ms", "lsn", "kafka_offset"), F.struct("lsn", "kafka_offset")
    )
    return keyed(bronze, key_fields).groupBy("source_table", "id").agg(newest.alias("e")).select("source_table", "id", "e.*")


def current_state(bronze: DataFrame, key_fields: str | list[str] = "id") -> DataFrame:
    """Latest event per key first, deleted keys dropped afterwards, and keys not seen since their table was truncated."""
    return since_truncate(latest_events(bronze, key_fields).filter(~F.col("deleted")), bronze)


def since_truncate(latest: DataFrame, bronze: DataFrame) -> DataFrame:
    """Events that come after the last truncate of their table; one row per truncated table is joined.

    These rows, as many as the catalog has tables at most, are sent to the events: dealt out by table, all events of one table would meet in one task.
    """
    emptied = bronze.filter(F.col("op") == "t").groupBy(F.col("source_table").alias("_table")).agg(F.max(F.struct("lsn", "kafka_offset")).alias("_emptied"))
    joined = latest.join(F.broadcast(emptied), F.col("source_table").eqNullSafe(F.col("_table")), "left")
    return joined.filter(F.col("_emptied").isNull() | (F.struct("lsn", "kafka_offset") > F.col("_emptied"))).drop("_table", "_emptied")


def as_of_state(
    bronze: DataFrame, lsn: int | None = None, ts_ms: int | None = None, key_fields: str | list[str] = "id"
) -> DataFrame:
    seen = bronze
    if lsn is not None:
        seen = seen.filter(F.col("lsn") <= lsn)
    if ts_ms is not None:
        seen = seen.filter(F.col("source_ts_ms") <= ts_ms)
    return current_state(seen, key_fields)


def states_at(bronze: DataFrame, lsns: list[int], key_fields: str | list[str] = "id") -> DataFrame:
    """The state at several versions at once: one shuffle, one conditional aggregate per version."""
    event = F.struct("deleted", "row_json", "lsn", "kafka_offset")
    aggs = [F.max_by(event, F.when(F.col("lsn") <= at, F.struct("lsn", "kafka_offset"))).alias(f"_{i}") for i, at in enumerate(lsns)]
    states = keyed(bronze, key_fields).groupBy("source_table", "id").agg(*aggs)
    versions = F.array(*[F.struct(F.lit(at).cast("bigint").alias("at"), F.col(f"_{i}").alias("e")) for i, at in enumerate(lsns)])
    rows = states.select("source_table", "id", F.explode(versions).alias("v"))
    rows = rows.filter(F.col("v.e").isNotNull() & ~F.col("v.e.deleted")).select("v.at", "source_table", "id", "v.e.row_json", "v.e.lsn", "v.e.kafka_offset")
    place = F.struct("lsn", "kafka_offset")
    cuts = bronze.filter(F.col("op") == "t").groupBy("source_table").agg(*[F.max(F.when(F.col("lsn") <= at, place)).alias(f"_{i}") for i, at in enumerate(lsns)])
    each = F.array(*[F.struct(F.lit(at).cast("bigint").alias("at"), F.col(f"_{i}").alias("cut")) for i, at in enumerate(lsns)])
    cuts = cuts.select(F.col("source_table").alias("_table"), F.explode(each).alias("c")).select("_table", F.col("c.at").alias("_at"), F.col("c.cut").alias("_cut"))
    joined = rows.join(F.broadcast(cuts), F.col("source_table").eqNullSafe(F.col("_table")) & (F.col("at") == F.col("_at")), "left")
    return joined.filter(F.col("_cut").isNull() | (place > F.col("_cut"))).select("at", "source_table", "id", "row_json", "lsn")


def key_history(bronze: DataFrame, key: str | int | list, limit: int = 10, key_fields: str | list[str] = "id") -> DataFrame:
    """Newest changes of one key, which is a list where the key has several fields."""
    wanted = F.to_json(F.array(*[F.lit(str(k)) for k in key])) if isinstance(key, list) else F.lit(str(key))
    return (
        drop_redelivered(keyed(bronze, key_fields).filter(F.col("id") == wanted))
        .orderBy(F.desc("lsn"), F.desc("kafka_offset"))
        .limit(limit)
    )


def op_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("source_table", "op").count()


def order_fields(rows: DataFrame) -> DataFrame:
    """Typed fields of an order row image."""
    row = F.from_json("row_json", "id BIGINT, customer_id BIGINT, status STRING, amount STRING")
    return rows.withColumn("row", row).select(
        *[c for c in rows.columns if c not in ("row_json", "id")],
        F.col("row.id").alias("id"),
        F.col("row.customer_id").alias("customer_id"),
        F.col("row.status").alias("status"),
        F.col("row.amount").cast("decimal(12,2)").alias("amount"),
    )


def reconcile(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Classify every key as same, differs, left_only or right_only."""
    a = left.select(key, F.struct(*columns).alias("a"))
    b = right.select(key, F.struct(*columns).alias("b"))
    verdict = (
        F.when(F.col("b").isNull(), "left_only")
        .when(F.col("a").isNull(), "right_only")
        .when(F.col("a").eqNullSafe(F.col("b")), "same")
        .otherwise("differs")
    )
    return a.join(b, key, "full").select(key, verdict.alias("verdict"))


def status_events(bronze: DataFrame, key_fields: str | list[str] = "id") -> DataFrame:
    """The status each event sets, once per message; NULL after a delete."""
    return drop_redelivered(keyed(bronze, key_fields)).select(
        "source_table",
        "id",
        "lsn",
        "kafka_offset",
        F.when(~F.col("deleted"), F.get_json_object("row_json", "$.status")).alias("status"),
    )


def status_changes(events: DataFrame, hot_rows: int = HOT_ROWS, slices: int | None = None) -> DataFrame:
    """One row whenever the status of a table's key differs from its previous event (null-safe).

    Reads ``events`` several times, so store them if they are costly to compute.
    """
    scanned = ordered_scan(
        events, ["source_table", "id"], ["lsn", "kafka_offset"], row_number="n", lags={"old_status": "status"}, hot_rows=hot_rows, slices=slices
    )
    changed = (F.col("n") > 1) & ~F.col("old_status").eqNullSafe(F.col("status"))
    return scanned.filter(changed).select("source_table", "id", "lsn", "old_status", F.col("status").alias("new_status"))
