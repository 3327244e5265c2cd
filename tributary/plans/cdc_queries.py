"""Change-data capture queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.operators import cdc
from tributary.plans.derived import bronze_changes, change_messages, source_orders
from tributary.plans.registry import query
from tributary.plans.sql import with_
from tributary.storage import write_and_read
from tributary.tables import Tables

PARSED = "topic, part AS partition, off AS offset, op, source_table, lsn, ts_ms, before_json, after_json"
STRICT = "CASE WHEN empty THEN 'tombstone' WHEN op IS NULL OR NOT has_source THEN 'malformed' ELSE 'ok' END"
LENIENT = "CASE WHEN empty THEN 'tombstone' WHEN op IS NULL THEN 'malformed' ELSE 'ok' END"


@query("cdc_01_parse_strict", with_("cdc_parsed", f'SELECT {PARSED.replace("offset", chr(34) + "offset" + chr(34))} FROM cdc_parsed WHERE {STRICT} = \'ok\''))
def parse_strict(t: Tables) -> DataFrame:
    return cdc.accepted(cdc.parse_envelopes(change_messages(t), strict=True)).drop("status")


@query("cdc_02_parse_lenient", with_("cdc_parsed", f'SELECT {PARSED.replace("offset", chr(34) + "offset" + chr(34))} FROM cdc_parsed WHERE {LENIENT} = \'ok\''))
def parse_lenient(t: Tables) -> DataFrame:
    return cdc.accepted(cdc.parse_envelopes(change_messages(t), strict=False)).drop("status")


@query(
    "cdc_03_op_names",
    with_(
        "cdc_parsed",
        """SELECT op, CASE op WHEN 'c' THEN 'create' WHEN 'u' THEN 'update' WHEN 'd' THEN 'delete' WHEN 'r' THEN 'snapshot' ELSE op END AS op_name,
        count(*) AS n FROM cdc_parsed WHERE op IS NOT NULL GROUP BY 1""",
    ),
)
def op_names(t: Tables) -> DataFrame:
    parsed = cdc.accepted(cdc.parse_envelopes(change_messages(t), strict=False))
    return parsed.groupBy("op").agg(F.count("*").alias("n")).withColumn("op_name", cdc.op_name(F.col("op")))


@query("cdc_04_route_by_status", with_("cdc_parsed", f"SELECT {STRICT} AS status, part AS partition, count(*) AS n FROM cdc_parsed GROUP BY 1, 2"))
def route_by_status(t: Tables) -> DataFrame:
    return cdc.parse_envelopes(change_messages(t)).groupBy("status", "partition").agg(F.count("*").alias("n"))


@query(
    "cdc_05_flatten",
    with_("bronze", "SELECT source_table, op, deleted, source_ts_ms, lsn, kafka_topic, kafka_partition, kafka_offset FROM bronze"),
)
def flatten(t: Tables) -> DataFrame:
    flat = cdc.flatten(cdc.parse_envelopes(change_messages(t)))
    return flat.drop("row_json", "before_json", "after_json")


@query("cdc_06_row_image", with_("bronze", "SELECT lsn, deleted, row_json FROM bronze"))
def row_image(t: Tables) -> DataFrame:
    return cdc.flatten(cdc.parse_envelopes(change_messages(t))).select("lsn", "deleted", "row_json")


@query("cdc_07_skip_snapshots", with_("bronze", "SELECT op, lsn, row_json FROM bronze WHERE op <> 'r'"))
def skip_snapshots(t: Tables) -> DataFrame:
    return cdc.skip_snapshots(cdc.flatten(cdc.parse_envelopes(change_messages(t)))).select("op", "lsn", "row_json")


@query("cdc_08_bronze_rows", with_("bronze", "SELECT * FROM bronze"))
def bronze_rows(t: Tables) -> DataFrame:
    return bronze_changes(t).withColumn("ingest_ts", F.col("ingest_ts").cast("timestamp_ntz"))


@query("cdc_09_drop_redelivered", with_("bronze_once", "SELECT kafka_topic, kafka_partition, kafka_offset, op, lsn, row_json FROM bronze_once"))
def drop_redelivered(t: Tables) -> DataFrame:
    return cdc.drop_redelivered(bronze_changes(t)).select("kafka_topic", "kafka_partition", "kafka_offset", "op", "lsn", "row_json")


@query(
    "cdc_10_current_state",
    with_(
        "current_state",
        """SELECT id, CAST(row_json ->> '$.customer_id' AS BIGINT) AS customer_id, row_json ->> '$.status' AS status,
        CAST(row_json ->> '$.amount' AS DOUBLE) AS amount, lsn FROM current_state""",
    ),
)
def current_state(t: Tables) -> DataFrame:
    rows = cdc.order_fields(cdc.current_state(bronze_changes(t)))
    return rows.select("id", "customer_id", "status", F.col("amount").cast("double").alias("amount"), "lsn")


@query(
    "cdc_10_composite_keys",
    with_(
        "bronze_once",
        """SELECT id, row_json ->> '$.status' AS status, lsn FROM (SELECT row_json, lsn,
        '["' || (row_json ->> '$.customer_id') || '","' || (row_json ->> '$.id') || '"]' AS id,
        row_number() OVER (PARTITION BY row_json ->> '$.customer_id', row_json ->> '$.id' ORDER BY lsn DESC, kafka_offset DESC) AS rn
        FROM bronze_once WHERE row_json ->> '$.customer_id' IS NOT NULL) WHERE rn = 1""",
    ),
)
def composite_keys(t: Tables) -> DataFrame:
    """Keys of two fields; a delete names only one of them, so it has no such key."""
    state = cdc.current_state(bronze_changes(t), ["customer_id", "id"])
    return state.select("id", F.get_json_object("row_json", "$.status").alias("status"), "lsn")


@query(
    "cdc_10_keyless_rows",
    with_("bronze", "SELECT source_table, op, count(*) AS n FROM bronze WHERE row_json ->> '$.customer_id' IS NULL GROUP BY 1, 2"),
)
def keyless_rows(t: Tables) -> DataFrame:
    return cdc.keyless_counts(bronze_changes(t), ["customer_id", "id"]).withColumnRenamed("count", "n")


@query(
    "cdc_11_key_history",
    with_("bronze_once", "SELECT id, op, lsn, row_json ->> '$.status' AS status FROM bronze_once WHERE id = 300 ORDER BY lsn DESC LIMIT 10"),
)
def key_history(t: Tables) -> DataFrame:
    newest = cdc.key_history(bronze_changes(t), key=300)
    return newest.select(F.col("id").cast("bigint").alias("id"), "op", "lsn", F.get_json_object("row_json", "$.status").alias("status"))


@query("cdc_12_op_counts", with_("bronze", "SELECT source_table, op, count(*) AS n FROM bronze GROUP BY 1, 2"))
def op_counts(t: Tables) -> DataFrame:
    return cdc.op_counts(bronze_changes(t)).withColumnRenamed("count", "n")


@query(
    "cdc_13_reconcile",
    with_(
        "current_state source_orders",
        """SELECT CASE WHEN s.id IS NULL THEN 'left_only' WHEN l.id IS NULL THEN 'right_only'
        WHEN l.customer_id = s.customer_id AND l.status = s.status AND l.amount = s.amount THEN 'same' ELSE 'differs' END AS verdict,
        count(*) AS n FROM (SELECT id, CAST(row_json ->> '$.customer_id' AS BIGINT) AS customer_id, row_json ->> '$.status' AS status,
        CAST(row_json ->> '$.amount' AS DECIMAL(12,2)) AS amount FROM current_state) l
        FULL JOIN source_orders s ON l.id = s.id GROUP BY 1""",
    ),
)
def reconcile(t: Tables) -> DataFrame:
    lake = cdc.order_fields(cdc.current_state(bronze_changes(t)))
    verdicts = cdc.reconcile(lake, source_orders(t), "id", ["customer_id", "status", "amount"])
    return verdicts.groupBy("verdict").agg(F.count("*").alias("n"))


@query(
    "cdc_14_status_audit",
    with_(
        "bronze_once",
        """SELECT id, lsn, old_status, new_status FROM (SELECT id, lsn, lag(status) OVER w AS old_status, status AS new_status,
        row_number() OVER w AS n FROM (SELECT id, lsn, kafka_offset, CASE WHEN NOT deleted THEN row_json ->> '$.status' END AS status
        FROM bronze_once) WINDOW w AS (PARTITION BY id ORDER BY lsn, kafka_offset))
        WHERE n > 1 AND old_status IS DISTINCT FROM new_status""",
    ),
)
def status_audit(t: Tables) -> DataFrame:
    changes = cdc.status_changes(write_and_read(cdc.status_events(bronze_changes(t)), "status-events"))
    return changes.select(F.col("id").cast("bigint").alias("id"), "lsn", "old_status", "new_status")


@query(
    "cdc_15_json_fields",
    with_(
        "bronze",
        """SELECT kafka_offset, CAST(row_json ->> '$.id' AS BIGINT) AS id, row_json ->> '$.status' AS status,
        CAST(row_json ->> '$.amount' AS DOUBLE) AS amount FROM bronze""",
    ),
)
def json_fields(t: Tables) -> DataFrame:
    field = lambda name: F.get_json_object("row_json", f"$.{name}")
    return bronze_changes(t).select(
        "kafka_offset", field("id").cast("bigint").alias("id"), field("status").alias("status"), field("amount").cast("double").alias("amount")
    )


