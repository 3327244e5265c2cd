"""Shared SQL fragments of the oracle queries (plain ANSI-style SQL over the given tables)."""

from __future__ import annotations

CTES: dict[str, tuple[str, list[str]]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTES[name] = (body, list(needs))


def with_(names: str, body: str) -> str:
    """Prefix ``body`` with the named fragments and all they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for need in CTES[name][1]:
            visit(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        visit(name)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in ordered) + "\n" + body


# --- online shop -------------------------------------------------------------------------------
cte(
    "shop_customers",
    """SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE n_name END AS city,
    CASE c_custkey % 5 WHEN 3 THEN 'silver' WHEN 4 THEN 'gold' ELSE 'free' END AS tier,
    CASE WHEN c_custkey % 97 = 0 THEN 'bad' || c_custkey ELSE 'user' || c_custkey || '@example.com' END AS email,
    c_acctbal AS balance, c_mktsegment AS segment
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
cte(
    "shop_products",
    """SELECT p_partkey AS product_id, p_name AS name, p_type AS category, p_brand AS brand,
    CAST(p_retailprice AS DECIMAL(12,2)) AS price,
    '{"brand":"' || p_brand || '","size":' || p_size || ',"warranty_months":' || (p_partkey % 4 * 12) || '}' AS attrs,
    string_split(p_name, ' ') AS tags FROM part""",
)
cte(
    "shop_orders",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
    CAST(o_totalprice AS DECIMAL(12,2)) AS total, o_orderdate AS created_at, o_orderpriority AS priority FROM orders""",
)
cte(
    "shop_items",
    """SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS product_id, l_suppkey AS supplier_id,
    CAST(l_quantity AS INTEGER) AS qty, CAST(l_extendedprice AS DECIMAL(12,2)) AS line_total,
    CAST(l_discount AS DECIMAL(4,2)) AS discount, l_returnflag AS return_flag, l_shipdate AS shipped_at FROM lineitem""",
)
cte(
    "categories",
    """SELECT 0 AS id, CAST(NULL AS INTEGER) AS parent_id, 'world' AS name
    UNION ALL SELECT r_regionkey + 1, 0, r_name FROM region
    UNION ALL SELECT n_nationkey + 100, n_regionkey + 1, n_name FROM nation""",
)
cte(
    "clicks",
    """SELECT event_id, ts, user_id, event_type,
    CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device,
    event_id % (SELECT count(*) FROM part) AS product_id FROM events""",
)
cte(
    "events_raw",
    """SELECT event_id, CASE WHEN event_id % 33 <> 0 THEN user_id END AS user_id, event_type, product_id, device,
    strftime(ts + INTERVAL 1 SECOND * copy_no, '%Y-%m-%dT%H:%M:%S') AS ts
    FROM clicks JOIN (VALUES (0), (1)) c(copy_no) ON copy_no = 0 OR event_id % 100 = 0""",
    "clicks",
)
cte(
    "events_silver",
    """SELECT * EXCLUDE (rn, event_ts), event_ts, CAST(event_ts AS DATE) AS event_date FROM (
    SELECT *, CAST(ts AS TIMESTAMP) AS event_ts,
    row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS rn FROM events_raw)
    WHERE rn = 1 AND user_id IS NOT NULL""",
    "events_raw",
)
cte(
    "promotions",
    """SELECT p_partkey AS product_id, 'A' AS promo, DATE '2000-01-01' + CAST(p_partkey % 100 AS INTEGER) AS valid_from,
    DATE '2000-01-01' + CAST(p_partkey % 100 + 30 AS INTEGER) AS valid_to FROM part
    UNION ALL SELECT p_partkey, 'B', DATE '2000-01-01' + CAST(p_partkey % 100 + 10 + p_partkey % 40 AS INTEGER),
    DATE '2000-01-01' + CAST(p_partkey % 100 + 40 + p_partkey % 40 AS INTEGER) FROM part""",
)
cte(
    "search_docs",
    """SELECT doc_id, lang, source, string_split(text, chr(10))[1] AS title, text AS body FROM documents""",
)

# --- change log --------------------------------------------------------------------------------
cte(
    "cdc_st",
    """SELECT o_orderkey AS k, o_custkey AS cu, o_orderstatus AS s0,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS amt FROM orders""",
)
cte(
    "cdc_ev",
    """SELECT k, k AS lsn, 'r' AS op, s0 AS s, cu, amt FROM cdc_st
    UNION ALL SELECT k, 1000000000 + k, 'u', 'PAID', cu, amt FROM cdc_st WHERE k % 3 = 0
    UNION ALL SELECT k, 2000000000 + k, 'u', 'SHIPPED', cu, amt FROM cdc_st WHERE k % 15 = 0
    UNION ALL SELECT k, 3000000000 + k, 'd', s0, cu, amt FROM cdc_st WHERE k % 20 = 0
    UNION ALL SELECT k, 4000000000 + k, 'c', 'NEW', cu, amt FROM cdc_st WHERE k % 100 = 0""",
    "cdc_st",
)
cte(
    "cdc_good",
    """SELECT 'shop.public.orders' AS topic, CAST(k % 3 AS INTEGER) AS part, lsn AS off,
    '{"before":' || CASE WHEN op = 'd' THEN '{"id":' || k || '}' ELSE 'null' END ||
    ',"after":' || CASE WHEN op = 'd' THEN 'null' ELSE '{"id":' || k || ',"customer_id":' || cu ||
      ',"status":"' || s || '","amount":"' || amt || '"}' END ||
    ',"source":{"schema":"public","table":"orders","lsn":' || lsn || '},"op":"' || op ||
    '","ts_ms":' || (1700000000000 + lsn % 1000000000) || '}' AS v FROM cdc_ev""",
    "cdc_ev",
)
cte(
    "cdc_raw",
    """SELECT * FROM cdc_good UNION ALL SELECT * FROM cdc_good WHERE off % 50 = 0
    UNION ALL SELECT 'shop.public.orders', 0, 5000000000 + k, '' FROM cdc_st WHERE k % 500 = 0
    UNION ALL SELECT 'shop.public.orders', 1, 6000000000 + k, '{' FROM cdc_st WHERE k % 500 = 1
    UNION ALL SELECT 'shop.public.orders', 2, 7000000000 + k, '{"op":"u"}' FROM cdc_st WHERE k % 500 = 2""",
    "cdc_good",
    "cdc_st",
)
cte(
    "cdc_json",
    """SELECT *, CASE WHEN json_valid(v) THEN CAST(v AS JSON) END AS j,
    trim(v) = '' AS empty FROM cdc_raw""",
    "cdc_raw",
)
cte(
    "cdc_parsed",
    """SELECT topic, part, off, empty, (j ->> '$.op') AS op, (j -> '$.source') IS NOT NULL AS has_source,
    coalesce(j ->> '$.source.schema', '') || '.' || coalesce(j ->> '$.source.table', '') AS source_table,
    coalesce(CAST(j ->> '$.source.lsn' AS BIGINT), 0) AS lsn, coalesce(CAST(j ->> '$.ts_ms' AS BIGINT), 0) AS ts_ms,
    CASE WHEN json_type(j, '$.before') <> 'NULL' THEN CAST(j -> '$.before' AS VARCHAR) END AS before_json,
    CASE WHEN json_type(j, '$.after') <> 'NULL' THEN CAST(j -> '$.after' AS VARCHAR) END AS after_json FROM cdc_json""",
    "cdc_json",
)
cte(
    "bronze",
    """SELECT source_table, op, op = 'd' AS deleted, ts_ms AS source_ts_ms, lsn, topic AS kafka_topic, part AS kafka_partition,
    off AS kafka_offset, CASE WHEN op = 'd' THEN before_json ELSE after_json END AS row_json, before_json, after_json,
    epoch_ms(ts_ms) AS ingest_ts FROM cdc_parsed WHERE op IS NOT NULL AND has_source""",
    "cdc_parsed",
)
cte(
    "bronze_once",
    "SELECT DISTINCT ON (kafka_topic, kafka_partition, kafka_offset) *, CAST(row_json ->> '$.id' AS BIGINT) AS id FROM bronze",
    "bronze",
)
cte(
    "current_state",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source_table, id ORDER BY lsn DESC, kafka_offset DESC) AS rn
    FROM bronze_once) WHERE rn = 1 AND NOT deleted""",
    "bronze_once",
)
cte(
    "source_orders",
    """SELECT o_orderkey AS id, o_custkey AS customer_id, CASE WHEN o_orderkey % 100 = 0 THEN 'NEW'
    WHEN o_orderkey % 15 = 0 THEN 'SHIPPED' WHEN o_orderkey % 3 = 0 THEN 'PAID' ELSE o_orderstatus END AS status,
    CAST(o_totalprice AS DECIMAL(12,2)) AS amount FROM orders WHERE o_orderkey % 100 = 0 OR o_orderkey % 20 <> 0""",
)

# --- membership --------------------------------------------------------------------------------
cte(
    "membership",
    """SELECT CAST((tag_id - 1 - (tag_id - 1) % 5) / 5 + 1 AS INTEGER) AS attribute_id, actor_id, tag_id, latest_signal, last_persist_time
    FROM (SELECT l_orderkey AS actor_id, CAST(1 + l_partkey % 20 AS INTEGER) AS tag_id,
    CASE WHEN l_linenumber % 4 = 0 THEN -1 ELSE 1 END AS latest_signal, l_shipdate AS last_persist_time,
    row_number() OVER (PARTITION BY l_orderkey, l_partkey % 20
      ORDER BY l_shipdate DESC, l_linenumber DESC, l_suppkey DESC, l_partkey DESC, l_extendedprice DESC) AS rn
    FROM lineitem) x WHERE rn = 1""",
)
cte("active", "SELECT actor_id, tag_id FROM membership WHERE latest_signal = 1", "membership")
