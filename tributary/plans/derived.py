"""Inputs that Spark derives from the given tables: change log, membership, segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.operators import cdc
from tributary.storage import write_and_read
from tributary.tables import MONEY, Tables, spread

BILLION = 1_000_000_000


def change_messages(t: Tables) -> DataFrame:
    """Order changes as envelope messages, in one pass over ``orders``: snapshot, updates,
    deletes that carry only the key, re-creations, redeliveries, tombstones and broken text."""
    k = F.col("k")
    none = F.lit(None).cast("string")

    def event(when, step, op, status):
        return F.when(when, F.struct((F.lit(step * BILLION) + k).alias("lsn"), F.lit(op).alias("op"), status.alias("s"), none.alias("raw"), k.cast("bigint").alias("part3")))

    def junk(when, step, part, raw):
        return F.when(
            when,
            F.struct((F.lit(step * BILLION) + k).alias("lsn"), none.alias("op"), none.alias("s"), F.lit(raw).alias("raw"), F.lit(part).cast("bigint").alias("part3")),
        )

    events = F.array(
        event(F.lit(True), 0, "r", F.col("s0")),
        event(k % 3 == 0, 1, "u", F.lit("PAID")),
        event(k % 15 == 0, 2, "u", F.lit("SHIPPED")),
        event(k % 20 == 0, 3, "d", F.col("s0")),
        event(k % 100 == 0, 4, "c", F.lit("NEW")),
        junk(k % 500 == 0, 5, 0, ""),
        junk(k % 500 == 1, 6, 1, "{"),
        junk(k % 500 == 2, 7, 2, '{"op":"u"}'),
    )
    rows = spread(t.orders).select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("cu"),
        F.col("o_orderstatus").alias("s0"),
        F.col("o_totalprice").cast(MONEY).cast("string").alias("amt"),
    ).select("*", F.explode(F.filter(events, lambda e: e.isNotNull())).alias("e"))
    deleted = F.col("e.op") == "d"
    after = F.to_json(F.struct(k.alias("id"), F.col("cu").alias("customer_id"), F.col("e.s").alias("status"), F.col("amt").alias("amount")))
    source = F.to_json(F.struct(F.lit("public").alias("schema"), F.lit("orders").alias("table"), F.col("e.lsn").alias("lsn")))
    value = F.concat(
        F.lit('{"before":'),
        F.when(deleted, F.to_json(F.struct(k.alias("id")))).otherwise("null"),
        F.lit(',"after":'),
        F.when(deleted, "null").otherwise(after),
        F.lit(',"source":'),
        source,
        F.lit(',"op":"'),
        F.col("e.op"),
        F.lit('","ts_ms":'),
        (F.lit(1_700_000_000_000) + F.col("e.lsn") % BILLION).cast("string"),
        F.lit("}"),
    )
    copies = F.when(F.col("e.raw").isNull() & (F.col("e.lsn") % 50 == 0), 2).otherwise(1)
    return rows.select(
        F.lit("shop.public.orders").alias("topic"),
        (F.col("e.part3") % 3).cast("int").alias("partition"),
        F.col("e.lsn").alias("offset"),
        F.explode(F.array_repeat(F.coalesce("e.raw", value), copies)).alias("value"),
    )


def bronze_changes(t: Tables) -> DataFrame:
    """Bronze log with the ingest time set to the source time, so that runs repeat."""
    changes = cdc.flatten(cdc.parse_envelopes(change_messages(t)))
    return cdc.to_bronze(changes, F.timestamp_millis("source_ts_ms"))


def stored_bronze(t: Tables) -> DataFrame:
    """The bronze log as the table it is in practice, for jobs that read it more than once."""
    return write_and_read(bronze_changes(t), "bronze-log")


def source_orders(t: Tables) -> DataFrame:
    """The source table after all changes, computed from ``orders`` without any message."""
    k = F.col("o_orderkey")
    status = (
        F.when(k % 100 == 0, "NEW").when(k % 15 == 0, "SHIPPED").when(k % 3 == 0, "PAID").otherwise(F.col("o_orderstatus"))
    )
    return t.orders.filter((k % 100 == 0) | (k % 20 != 0)).select(
        k.alias("id"), F.col("o_custkey").alias("customer_id"), status.alias("status"), F.col("o_totalprice").cast(MONEY).alias("amount")
    )


def signal_log(t: Tables) -> DataFrame:
    """Every tag signal an actor ever got: 1 = add, -1 = remove."""
    tag = (F.lit(1) + F.col("l_partkey") % 20).cast("int")
    return spread(t.lineitem).select(
        (F.floor((tag - 1) / 5) + 1).cast("int").alias("attribute_id"),
        F.col("l_orderkey").alias("actor_id"),
        tag.alias("tag_id"),
        F.when(F.col("l_linenumber") % 4 == 0, -1).otherwise(1).alias("signal"),
        F.col("l_shipdate").alias("ts"),
        F.struct("l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice").alias("event_id"),
    )
