"""Quality checks, upserts, merges and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.operators import cdc, quality, versions
from tributary.operators.segments import union_all
from tributary.plans.derived import BILLION, bronze_changes, stored_bronze
from tributary.plans.registry import query
from tributary.plans.sql import cte, with_
from tributary.sources import sinks
from tributary.storage import run_path
from tributary.tables import Tables

EVENT_TYPES = ["view", "click", "signup", "purchase", "error"]


@query(
    "dq_01_event_gate",
    with_(
        "events_silver",
        """SELECT 'unique_event_id' AS "check", count(*) - count(DISTINCT event_id) AS violations, 'PASS' AS result FROM events_silver
        UNION ALL SELECT 'user_present', count(*) FILTER (WHERE user_id IS NULL), 'PASS' FROM events_silver
        UNION ALL SELECT 'known_type', count(*) FILTER (WHERE event_type NOT IN ('view', 'click', 'signup', 'purchase', 'error')), 'PASS' FROM events_silver
        UNION ALL SELECT 'time_in_range', count(*) FILTER (WHERE event_ts NOT BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-12-31'), 'PASS' FROM events_silver""",
    ),
)
def event_gate(t: Tables) -> DataFrame:
    return quality.event_gate(quality.clean_events(t.events_raw), EVENT_TYPES, "2024-01-01", "2024-12-31")


@query(
    "dq_02_rules",
    with_(
        "shop_customers shop_products shop_orders",
        """SELECT 'email' AS rule, count(*) AS checked, count(*) FILTER (WHERE NOT regexp_matches(email, '^[^@ ]+@[^@ ]+\\.[a-z]+$')) AS violations FROM shop_customers
        UNION ALL SELECT 'tier', count(*), count(*) FILTER (WHERE tier NOT IN ('free', 'silver', 'gold')) FROM shop_customers
        UNION ALL SELECT 'balance_not_negative', count(*), count(*) FILTER (WHERE balance < 0) FROM shop_customers
        UNION ALL SELECT 'price_positive', count(*), count(*) FILTER (WHERE price <= 0) FROM shop_products
        UNION ALL SELECT 'shipped_after_created', count(*), count(*) FILTER (WHERE l_shipdate < o_orderdate) FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
)
def rules(t: Tables) -> DataFrame:
    customers = quality.check_rules(
        t.shop_customers,
        {
            "email": F.col("email").rlike(r"^[^@ ]+@[^@ ]+\.[a-z]+$"),
            "tier": F.col("tier").isin("free", "silver", "gold"),
            "balance_not_negative": F.col("balance") >= 0,
        },
    )
    products = quality.check_rules(t.shop_products, {"price_positive": F.col("price") > 0})
    dated = t.shop_items.select("order_id", "shipped_at").join(t.shop_orders.select("order_id", "created_at"), "order_id")
    orders = quality.check_rules(dated, {"shipped_after_created": F.col("shipped_at") >= F.col("created_at")})
    return union_all([customers, products, orders])


@query(
    "dq_03_orphans",
    """SELECT 'orders_without_lines' AS relation, count(*) AS n FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT 'lines_without_order', count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL SELECT 'documents_without_label', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def orphans(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_orderkey").alias("order_id"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("order_id"))
    relations = {
        "orders_without_lines": quality.orphans(orders, lines, "order_id"),
        "lines_without_order": quality.orphans(lines, orders, "order_id"),
        "documents_without_label": quality.orphans(t.documents.select("doc_id"), t.labels, "doc_id"),
    }
    return union_all([df.agg(F.lit(name).alias("relation"), F.count("*").alias("n")) for name, df in relations.items()])


@query("dq_04_composite_key", with_("shop_items", "SELECT order_id, line_no, count(*) AS n FROM shop_items GROUP BY 1, 2 HAVING count(*) > 1"))
def composite_key(t: Tables) -> DataFrame:
    return quality.duplicates(t.shop_items, ["order_id", "line_no"])


@query("dq_04_single_key", with_("events_raw", "SELECT event_id, count(*) AS n FROM events_raw GROUP BY 1 HAVING count(*) > 1"))
def single_key(t: Tables) -> DataFrame:
    return quality.duplicates(t.events_raw, ["event_id"])


@query(
    "dq_05_overlapping_periods",
    with_(
        "promotions",
        """SELECT b.product_id, b.promo, CAST(b.valid_from AS VARCHAR) AS valid_from FROM promotions a JOIN promotions b
        ON a.product_id = b.product_id AND a.promo = 'A' AND b.promo = 'B' AND b.valid_from < a.valid_to""",
    ),
)
def overlapping_periods(t: Tables) -> DataFrame:
    clash = quality.overlaps(t.promotions, "product_id", "valid_from", "valid_to")
    return clash.select("product_id", "promo", F.col("valid_from").cast("string").alias("valid_from"))


def _profile_sql(columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", (SELECT count(DISTINCT {c}) FROM shop_customers) AS n_distinct,
        (SELECT avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FROM shop_customers) AS null_frac,
        (SELECT string_agg({c}, ',' ORDER BY n DESC, {c}) FROM (SELECT {c}, count(*) AS n FROM shop_customers WHERE {c} IS NOT NULL
        GROUP BY 1 ORDER BY n DESC, {c} LIMIT 3)) AS most_common"""
        for c in columns
    )


@query("dq_06_column_profile", with_("shop_customers", _profile_sql(["city", "tier", "segment"])))
def column_profile(t: Tables) -> DataFrame:
    profile = quality.column_profile(t.shop_customers, ["city", "tier", "segment"])
    return profile.withColumn("most_common", F.array_join("most_common", ","))


@query(
    "dq_06_position_correlation",
    "SELECT round(corr(CAST(rn AS DOUBLE), CAST(event_id AS DOUBLE)), 6) AS correlation FROM (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS rn FROM events)",
)
def position_correlation(t: Tables) -> DataFrame:
    return quality.position_correlation(t.events, "event_id", "ts").select(F.round("correlation", 6).alias("correlation"))


@query(
    "dq_07_dependency",
    with_(
        "shop_customers",
        """SELECT city, tier, n, n / total AS joint, (n_city / total) * (n_tier / total) AS independent FROM (SELECT city, tier, count(*) AS n FROM shop_customers
        WHERE city IS NOT NULL GROUP BY 1, 2)
        JOIN (SELECT city, count(*) AS n_city FROM shop_customers GROUP BY 1) USING (city) JOIN (SELECT tier, count(*) AS n_tier FROM shop_customers WHERE city IS NOT NULL GROUP BY 1) USING (tier),
        (SELECT count(*) AS total FROM shop_customers WHERE city IS NOT NULL)""",
    ),
)
def dependency(t: Tables) -> DataFrame:
    return quality.dependency(t.shop_customers.filter(F.col("city").isNotNull()), "city", "tier")


@query("dq_08_approximate_count", "SELECT count(*) AS exact, true AS within_bound FROM lineitem")
def approximate_count(t: Tables) -> DataFrame:
    """The estimate from a tenth of the rows lies within six standard deviations."""
    counts = quality.sampled_count(t.lineitem, 0.1)
    bound = 6 * F.sqrt(F.col("exact") * (1 - 0.1) / 0.1)
    return counts.select("exact", (F.abs(F.col("estimate") - F.col("exact")) <= bound).alias("within_bound"))


# --- upserts and versions ----------------------------------------------------------------------

cte("upsert_target", "SELECT order_id, status, CAST(total AS DOUBLE) AS total FROM shop_orders WHERE created_at < TIMESTAMP '1999-01-01'", "shop_orders")
cte(
    "upsert_source",
    """SELECT order_id, CASE WHEN status = 'O' THEN 'SHIPPED' ELSE status END AS status, CAST(total + 1 AS DOUBLE) AS total FROM shop_orders
    WHERE created_at >= TIMESTAMP '1998-07-01'""",
    "shop_orders",
)
cte(
    "upserted",
    """SELECT coalesce(s.order_id, t.order_id) AS order_id, coalesce(s.status, t.status) AS status, coalesce(s.total, t.total) AS total,
    CASE WHEN s.order_id IS NULL THEN 'kept' WHEN t.order_id IS NULL THEN 'inserted' ELSE 'updated' END AS action
    FROM upsert_target t FULL JOIN upsert_source s ON t.order_id = s.order_id""",
    "upsert_target",
    "upsert_source",
)


def upsert_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A stored table and a later batch that overlap by half a year."""
    day = lambda text: F.lit(text).cast("timestamp_ntz")
    target = t.shop_orders.filter(F.col("created_at") < day("1999-01-01"))
    source = t.shop_orders.filter(F.col("created_at") >= day("1998-07-01"))
    shipped = F.when(F.col("status") == "O", "SHIPPED").otherwise(F.col("status"))
    return (
        target.select("order_id", "status", F.col("total").cast("double").alias("total")),
        source.select("order_id", shipped.alias("status"), (F.col("total") + 1).cast("double").alias("total")),
    )


@query(
    "ups_01_insert_if_absent",
    with_(
        "shop_items",
        """SELECT product_id, supplier_id, origin, count(*) AS n FROM (SELECT DISTINCT product_id, supplier_id, 'kept' AS origin FROM shop_items WHERE shipped_at < TIMESTAMP '1998-01-01'
        UNION ALL SELECT DISTINCT product_id, supplier_id, 'inserted' FROM shop_items WHERE shipped_at >= TIMESTAMP '1998-01-01'
        AND (product_id, supplier_id) NOT IN (SELECT (product_id, supplier_id) FROM shop_items WHERE shipped_at < TIMESTAMP '1998-01-01')) GROUP BY 1, 2, 3""",
    ),
)
def insert_if_absent(t: Tables) -> DataFrame:
    """One row per product and supplier; repeats are ignored."""
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    offers = t.shop_items.select("product_id", "supplier_id", "shipped_at", "order_id", "line_no")
    stored = offers.filter(F.col("shipped_at") < cut).dropDuplicates(["product_id", "supplier_id"])
    batch = offers.filter(F.col("shipped_at") >= cut)
    merged = versions.insert_if_absent(stored, batch, ["product_id", "supplier_id"], ["shipped_at", "order_id", "line_no"])
    return merged.groupBy("product_id", "supplier_id", "origin").agg(F.count("*").alias("n"))


@query("ups_02_upsert", with_("upserted", "SELECT * FROM upserted"))
def upsert(t: Tables) -> DataFrame:
    return versions.upsert(*upsert_sides(t), ["order_id"])


@query("ups_03_merge", with_("upserted", "SELECT * FROM upserted WHERE NOT (status = 'P' AND total < 100000)"))
def merge(t: Tables) -> DataFrame:
    return versions.merge(*upsert_sides(t), ["order_id"], (F.col("status") == "P") & (F.col("total") < 100000))


@query(
    "ups_04_move_rows",
    with_(
        "shop_orders",
        """SELECT CASE WHEN status = 'F' AND created_at < TIMESTAMP '1997-01-01' THEN 'archived' ELSE 'remaining' END AS side, count(*) AS n,
        CAST(sum(total) AS DOUBLE) AS total FROM shop_orders GROUP BY 1""",
    ),
)
def move_rows(t: Tables) -> DataFrame:
    """One pass writes both sides; together they are the original."""
    old = (F.col("status") == "F") & (F.col("created_at") < F.lit("1997-01-01").cast("timestamp_ntz"))
    path = run_path(t.spark, "moved-orders")
    versions.split_rows(t.shop_orders, old).write.partitionBy("side").parquet(path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy("side").agg(F.count("*").alias("n"), F.sum("total").cast("double").alias("total"))


@query(
    "ups_05_cancel_stale",
    with_(
        "shop_orders",
        """SELECT order_id, CASE WHEN c THEN 'CANCELLED' ELSE status END AS status, c AS changed FROM (SELECT *, status = 'O' AND
        created_at < TIMESTAMP '2002-01-01' - INTERVAL 700 DAY AS c FROM shop_orders)""",
    ),
)
def cancel_stale(t: Tables) -> DataFrame:
    stale = (F.col("status") == "O") & (F.col("created_at") < F.expr("TIMESTAMP_NTZ '2002-01-01 00:00:00' - INTERVAL '700' DAY"))
    return versions.change_where(t.shop_orders.select("order_id", "status", "created_at"), "status", "CANCELLED", stale).select("order_id", "status", "changed")


@query(
    "ups_06_allocate_stock",
    """WITH RECURSIVE asked AS (SELECT l_orderkey, l_partkey, CAST(l_quantity AS INTEGER) AS qty, row_number() OVER (PARTITION BY l_partkey
    ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_quantity) AS n FROM lineitem),
    served AS (SELECT p_partkey AS product_id, CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS order_id, 0 AS qty, false AS accepted, p_size * 20 AS rest FROM part
    UNION ALL SELECT product_id, a.n, l_orderkey, a.qty, a.qty <= rest, CASE WHEN a.qty <= rest THEN rest - a.qty ELSE rest END
    FROM served s JOIN asked a ON l_partkey = product_id AND a.n = s.n + 1)
    SELECT order_id, product_id, qty, accepted FROM served WHERE n > 0""",
)
def allocate_stock(t: Tables) -> DataFrame:
    """Each request in time order takes its quantity if that much is left; a refused one takes nothing."""
    requests = t.shop_items.select("order_id", "product_id", "qty", "shipped_at", "line_no", "supplier_id", "line_total")
    stock = t.part.select(F.col("p_partkey").alias("product_id"), (F.col("p_size") * 20).alias("stock"))
    order = ["shipped_at", "order_id", "line_no", "supplier_id", "line_total", "qty"]
    allocated = versions.allocate(requests, stock, "product_id", "qty", order)
    return allocated.select("order_id", "product_id", "qty", "accepted")


STATE_AT = """SELECT v, id, row_json FROM (SELECT v, id, deleted, row_json, row_number() OVER (PARTITION BY v, id ORDER BY lsn DESC) AS rn FROM bronze_once
    JOIN (VALUES (CAST(0 AS BIGINT)), (1), (2), (3), (4)) x(v) ON lsn < (v + 1) * 1000000000) WHERE rn = 1 AND NOT deleted"""


@query("ups_07_as_of_read", with_("bronze_once", f"SELECT CAST(v AS INTEGER) AS version, row_json ->> '$.status' AS status, count(*) AS n FROM ({STATE_AT}) GROUP BY 1, 2"))
def as_of_read(t: Tables) -> DataFrame:
    """The table as of the end of each of five versions of the change log, in one job."""
    states = cdc.states_at(bronze_changes(t), [(v + 1) * BILLION - 1 for v in range(5)])
    version = F.floor(F.col("at") / BILLION).cast("int")
    return states.groupBy(version.alias("version"), F.get_json_object("row_json", "$.status").alias("status")).agg(F.count("*").alias("n"))


@query(
    "ups_08_roll_back",
    with_(
        "bronze_once",
        f"""SELECT difference, count(*) AS n FROM (SELECT CASE WHEN a.id IS NULL THEN 'removed' WHEN b.id IS NULL THEN 'restored'
        WHEN a.row_json <> b.row_json THEN 'changed' ELSE 'same' END AS difference FROM (SELECT * FROM ({STATE_AT}) WHERE v = 4) b
        FULL JOIN (SELECT * FROM ({STATE_AT}) WHERE v = 1) a ON a.id = b.id) GROUP BY 1""",
    ),
)
def roll_back(t: Tables) -> DataFrame:
    """Write the state of an older version as the new table and report what that changes."""
    bronze = stored_bronze(t)
    path = run_path(t.spark, "rolled-back")
    sinks.write(cdc.as_of_state(bronze, lsn=2 * BILLION - 1).select("id", "row_json"), path)
    compared = versions.compare_versions(cdc.current_state(bronze).select("id", "row_json"), t.spark.read.parquet(path), "id")
    return compared.groupBy("difference").agg(F.count("*").alias("n"))


@query(
    "ups_09_version_history",
    with_("bronze_once", "SELECT version, added, CAST(sum(added) OVER (ORDER BY version) AS BIGINT) AS total FROM (SELECT lsn // 1000000000 AS version, count(*) AS added FROM bronze_once GROUP BY 1)"),
)
def version_history(t: Tables) -> DataFrame:
    return versions.version_history(cdc.drop_redelivered(bronze_changes(t)), F.floor(F.col("lsn") / BILLION))


@query("ups_10_schema_change", with_("shop_orders", "SELECT order_id, CAST(total AS DOUBLE) AS amount, CASE WHEN created_at >= TIMESTAMP '1998-01-01' THEN priority END AS priority FROM shop_orders"))
def schema_change(t: Tables) -> DataFrame:
    """Old files know ``total`` and no ``priority``; new ones call it ``amount``. Nothing is rewritten."""
    path = run_path(t.spark, "evolving-orders")
    cut = F.col("created_at") < F.lit("1998-01-01").cast("timestamp_ntz")
    t.shop_orders.filter(cut).select("order_id", "total").write.parquet(f"{path}/batch=1")
    t.shop_orders.filter(~cut).select("order_id", F.col("total").alias("amount"), "priority").write.parquet(f"{path}/batch=2")
    stored = t.spark.read.option("mergeSchema", True).parquet(path)
    current = versions.renamed(stored, {"total": "amount"}, ["order_id", "amount", "priority"])
    return current.withColumn("amount", F.col("amount").cast("double"))


@query("ups_11_layout_change", with_("shop_orders", "SELECT order_id, customer_id, CAST(created_at AS VARCHAR)[1:10] AS day FROM shop_orders"))
def layout_change(t: Tables) -> DataFrame:
    """Old data by year, new data by year and customer bucket; one reader over both."""
    path = run_path(t.spark, "layouts")
    rows = t.shop_orders.select("order_id", "customer_id", F.to_date("created_at").alias("day")).withColumn("year", F.year("day"))
    old = F.col("day") < F.lit("1998-01-01").cast("date")
    sinks.write_partitioned(rows.filter(old), f"{path}/by_year", "year")
    bucketed = rows.filter(~old).withColumn("bucket", F.pmod(F.hash("customer_id"), F.lit(16)))
    sinks.write_partitioned(bucketed, f"{path}/by_year_and_bucket", "year", "bucket")
    schema = "order_id bigint, customer_id bigint, day date, year int"
    both = t.spark.read.schema(schema).parquet(f"{path}/by_year").unionByName(
        t.spark.read.schema(schema + ", bucket int").parquet(f"{path}/by_year_and_bucket").drop("bucket")
    )
    return both.select("order_id", "customer_id", F.col("day").cast("string").alias("day"))
