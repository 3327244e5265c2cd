"""Projection, filter and cleaning queries; sorting, paging, set operations, recursion."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.operators import quality, segments, trees
from tributary.plans.registry import query
from tributary.plans.segment_queries import membership
from tributary.plans.sql import with_
from tributary.tables import ORDER_STATUS, Tables

AS_OF = "2002-01-01"


@query(
    "prj_01_select_columns",
    with_(
        "shop_orders",
        """SELECT order_id, age_days, CASE WHEN age_days < 1000 THEN 'recent' WHEN age_days < 2000 THEN 'mid' ELSE 'old' END AS age,
        upper(status) || '-' || substr(priority, 1, 1) AS code
        FROM (SELECT *, CAST(date_diff('day', CAST(created_at AS DATE), DATE '2002-01-01') AS INTEGER) AS age_days FROM shop_orders)""",
    ),
)
def select_columns(t: Tables) -> DataFrame:
    days = F.col("age_days")
    return (
        t.shop_orders.withColumn("age_days", F.date_diff(F.lit(AS_OF), "created_at"))
        .withColumn("age", F.when(days < 1000, "recent").when(days < 2000, "mid").otherwise("old"))
        .drop("total")
        .selectExpr("order_id", "age_days", "age", "upper(status) || '-' || substr(priority, 1, 1) AS code")
    )


@query(
    "prj_02_compound_filter",
    with_("shop_orders", "SELECT order_id, status FROM shop_orders WHERE status = 'O' AND (total > 100000 OR NOT (priority LIKE '5%'))"),
)
def compound_filter(t: Tables) -> DataFrame:
    keep = (F.col("status") == "O") & ((F.col("total") > 100000) | ~F.col("priority").startswith("5"))
    return t.shop_orders.filter(keep).select("order_id", "status")


@query(
    "prj_03_case_buckets",
    with_(
        "shop_orders",
        """SELECT CASE WHEN total < 50000 THEN 'small' WHEN total < 200000 THEN 'medium' ELSE 'large' END AS size, count(*) AS n
        FROM shop_orders GROUP BY 1""",
    ),
)
def case_buckets(t: Tables) -> DataFrame:
    size = F.when(F.col("total") < 50000, "small").when(F.col("total") < 200000, "medium").otherwise("large")
    return t.shop_orders.groupBy(size.alias("size")).agg(F.count("*").alias("n"))


@query(
    "prj_04_null_logic",
    with_(
        "shop_customers",
        """SELECT count(*) FILTER (WHERE city <> 'NATION_1') AS not_equal, count(*) FILTER (WHERE city IS DISTINCT FROM 'NATION_1') AS is_distinct,
        count(*) FILTER (WHERE city = 'NATION_1') AS equal, count(*) AS n FROM shop_customers""",
    ),
)
def null_logic(t: Tables) -> DataFrame:
    city = F.col("city")
    return t.shop_customers.agg(
        F.count_if(city != "NATION_1").alias("not_equal"),
        F.count_if(~city.eqNullSafe("NATION_1")).alias("is_distinct"),
        F.count_if(city == "NATION_1").alias("equal"),
        F.count("*").alias("n"),
    )


@query(
    "prj_05_defaults",
    with_("shop_customers", "SELECT customer_id, coalesce(city, 'unknown') AS city, nullif(tier, 'free') AS paid_tier FROM shop_customers"),
)
def defaults(t: Tables) -> DataFrame:
    return t.shop_customers.select(
        "customer_id", F.coalesce("city", F.lit("unknown")).alias("city"), F.nullif("tier", F.lit("free")).alias("paid_tier")
    )


RAW_COLUMNS = ["event_id", "user_id", "event_type", "product_id", "device", "ts"]


@query(
    "prj_06_null_rates",
    with_("events_raw", "SELECT " + ", ".join(f"avg(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS {c}" for c in RAW_COLUMNS) + " FROM events_raw"),
)
def null_rates(t: Tables) -> DataFrame:
    return quality.null_rates(t.events_raw)


@query("prj_07_fill_missing", with_("shop_customers", "SELECT customer_id, coalesce(city, 'unknown') AS city FROM shop_customers"))
def fill_missing(t: Tables) -> DataFrame:
    return t.shop_customers.na.fill("unknown", subset=["city"]).select("customer_id", "city")


@query("prj_07_drop_missing", with_("events_raw", "SELECT event_id, user_id, device FROM events_raw WHERE user_id IS NOT NULL"))
def drop_missing(t: Tables) -> DataFrame:
    return t.events_raw.na.drop(subset=["user_id"]).select("event_id", "user_id", "device")


@query("prj_08_drop_duplicates", with_("events_raw", "SELECT event_type, count(DISTINCT event_id) AS n FROM events_raw GROUP BY 1"))
def drop_duplicates(t: Tables) -> DataFrame:
    return t.events_raw.select("event_id", "event_type").dropDuplicates(["event_id"]).groupBy("event_type").agg(F.count("*").alias("n"))


@query(
    "prj_09_stuck_orders",
    with_(
        "shop_orders",
        """SELECT order_id, customer_id, created_at FROM shop_orders
        WHERE status = 'P' AND created_at < TIMESTAMP '2000-01-01 00:00:00' - INTERVAL 30 DAY""",
    ),
)
def stuck_orders(t: Tables) -> DataFrame:
    limit = F.expr("TIMESTAMP_NTZ '2000-01-01 00:00:00' - INTERVAL '30' DAY")
    return t.shop_orders.filter((F.col("status") == "P") & (F.col("created_at") < limit)).select("order_id", "customer_id", "created_at")


@query(
    "prj_10_key_list",
    with_("shop_orders", "SELECT order_id, customer_id FROM shop_orders WHERE customer_id IN (1, 3, 7, 20, 42, 64, 97, 100)"),
)
def key_list(t: Tables) -> DataFrame:
    return t.shop_orders.filter(F.col("customer_id").isin(1, 3, 7, 20, 42, 64, 97, 100)).select("order_id", "customer_id")


@query(
    "prj_10_key_table",
    with_(
        "shop_orders shop_customers",
        "SELECT order_id, customer_id FROM shop_orders WHERE customer_id IN (SELECT customer_id FROM shop_customers WHERE segment = 'BUILDING')",
    ),
)
def key_table(t: Tables) -> DataFrame:
    keys = t.shop_customers.filter(F.col("segment") == "BUILDING").select("customer_id")
    return t.shop_orders.join(keys, "customer_id", "left_semi").select("order_id", "customer_id")


@query(
    "prj_11_line_total",
    with_(
        "shop_items shop_products",
        """SELECT order_id, line_no, product_id, qty, CAST(price * qty AS DOUBLE) AS line_total
        FROM shop_items JOIN shop_products USING (product_id)""",
    ),
)
def line_total(t: Tables) -> DataFrame:
    priced = t.shop_items.drop("line_total").join(t.shop_products.select("product_id", "price"), "product_id")
    total = (F.col("price") * F.col("qty")).cast("decimal(12,2)")
    return priced.select("order_id", "line_no", "product_id", "qty", total.cast("double").alias("line_total"))


@query(
    "prj_12_case_insensitive",
    with_(
        "shop_customers",
        """SELECT customer_id, lower(email) = lower('USER5@Example.COM') AS is_user5, segment ILIKE '%BUILD%' AS builds FROM shop_customers
        WHERE email ILIKE '%@EXAMPLE.com'""",
    ),
)
def case_insensitive(t: Tables) -> DataFrame:
    return t.shop_customers.filter(F.col("email").ilike("%@EXAMPLE.com")).select(
        "customer_id", (F.lower("email") == "user5@example.com").alias("is_user5"), F.col("segment").ilike("%BUILD%").alias("builds")
    )


@query(
    "prj_14_clean_events",
    with_(
        "events_raw events_silver",
        """SELECT (SELECT count(*) FROM events_raw) AS raw, (SELECT count(try_cast(ts AS TIMESTAMP)) FROM events_raw) AS parsed,
        (SELECT count(DISTINCT event_id) FROM events_raw) AS deduplicated, (SELECT count(*) FROM events_silver) AS clean""",
    ),
)
def clean_events(t: Tables) -> DataFrame:
    return quality.cleaning_counts(t.events_raw)


@query(
    "prj_15_reject_reasons",
    with_(
        "events_raw",
        """SELECT reason, count(*) AS n FROM (SELECT CASE WHEN try_cast(ts AS TIMESTAMP) IS NULL THEN 'bad_time'
        WHEN row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) > 1 THEN 'duplicate'
        WHEN user_id IS NULL THEN 'no_user' ELSE 'kept' END AS reason FROM events_raw) GROUP BY 1""",
    ),
)
def reject_reasons(t: Tables) -> DataFrame:
    return quality.reject_reasons(t.events_raw)


# --- sorting and paging ------------------------------------------------------------------------


@query("srt_01_nulls_last", with_("shop_customers", "SELECT city, customer_id FROM shop_customers ORDER BY city DESC NULLS LAST, customer_id"))
def nulls_last(t: Tables) -> DataFrame:
    return t.shop_customers.select("city", "customer_id").orderBy(F.desc_nulls_last("city"), "customer_id")


@query("srt_02_top_k", with_("shop_orders", "SELECT order_id, CAST(total AS DOUBLE) AS total FROM shop_orders ORDER BY shop_orders.total DESC, order_id LIMIT 20"))
def top_k(t: Tables) -> DataFrame:
    return t.shop_orders.orderBy(F.desc("total"), "order_id").limit(20).select("order_id", F.col("total").cast("double").alias("total"))


@query("srt_03_offset_page", with_("shop_orders", "SELECT order_id, created_at FROM shop_orders ORDER BY created_at DESC, order_id DESC LIMIT 20 OFFSET 200"))
def offset_page(t: Tables) -> DataFrame:
    newest = t.shop_orders.orderBy(F.desc("created_at"), F.desc("order_id"))
    return newest.offset(200).limit(20).select("order_id", "created_at")


@query(
    "srt_04_keyset_page",
    with_(
        "shop_orders",
        """SELECT order_id, created_at FROM shop_orders WHERE (created_at, order_id) < (TIMESTAMP '1998-06-01', 700)
        ORDER BY created_at DESC, order_id DESC LIMIT 20""",
    ),
)
def keyset_page(t: Tables) -> DataFrame:
    at = F.lit("1998-06-01").cast("timestamp_ntz")
    after = (F.col("created_at") <= at) & ((F.col("created_at") < at) | (F.col("order_id") < 700))
    return t.shop_orders.filter(after).orderBy(F.desc("created_at"), F.desc("order_id")).limit(20).select("order_id", "created_at")


@query(
    "srt_05_enum_order",
    with_(
        "shop_orders",
        """SELECT order_id, status, CAST(list_position(['O', 'P', 'F'], status) AS BIGINT) AS place FROM shop_orders
        ORDER BY list_position(['O', 'P', 'F'], status) DESC, order_id""",
    ),
)
def enum_order(t: Tables) -> DataFrame:
    place = F.array_position(F.array(*map(F.lit, ORDER_STATUS)), F.col("status"))
    return t.shop_orders.select("order_id", "status", place.alias("place")).orderBy(F.desc("place"), "order_id")


# --- set operations ----------------------------------------------------------------------------


@query(
    "set_01_union_by_name",
    "SELECT c_custkey AS id, c_acctbal AS balance, 'customer' AS kind FROM customer UNION ALL SELECT s_suppkey, s_acctbal, 'supplier' FROM supplier",
)
def union_by_name(t: Tables) -> DataFrame:
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.lit("customer").alias("kind"))
    suppliers = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("balance"), F.col("s_suppkey").alias("id"))
    return customers.unionByName(suppliers)


@query(
    "set_03_member_sets",
    with_(
        "active",
        """SELECT 'and' AS op, actor_id FROM active WHERE tag_id = 1 AND actor_id IN (SELECT actor_id FROM active WHERE tag_id = 2)
        UNION ALL SELECT 'or', actor_id FROM (SELECT DISTINCT actor_id FROM active WHERE tag_id IN (1, 2))
        UNION ALL SELECT 'and_not', actor_id FROM active WHERE tag_id = 1 AND actor_id NOT IN (SELECT actor_id FROM active WHERE tag_id = 2)""",
    ),
)
def member_sets(t: Tables) -> DataFrame:
    rows = segments.active(membership(t))
    a = rows.filter(F.col("tag_id") == 1).select("actor_id")
    b = rows.filter(F.col("tag_id") == 2).select("actor_id")
    named = {"and": a.intersect(b), "or": a.union(b).distinct(), "and_not": a.subtract(b)}
    return segments.union_all([df.select(F.lit(op).alias("op"), "actor_id") for op, df in named.items()])


@query(
    "set_04_array_containment",
    with_(
        "shop_products",
        """SELECT product_id, list_has_all(tags, ['red', 'widget']) AS has_all, list_has_any(tags, ['small', 'ring']) AS has_any FROM shop_products""",
    ),
)
def array_containment(t: Tables) -> DataFrame:
    wanted = F.array(F.lit("red"), F.lit("widget"))
    return t.shop_products.select(
        "product_id",
        (F.size(F.array_except(wanted, "tags")) == 0).alias("has_all"),
        F.arrays_overlap("tags", F.array(F.lit("small"), F.lit("ring"))).alias("has_any"),
    )


# --- recursion ---------------------------------------------------------------------------------

@query(
    "rec_01_category_tree",
    with_(
        "categories",
        """SELECT * FROM (WITH RECURSIVE tree(id, name, depth, path) AS (SELECT id, name, 1, name FROM categories WHERE parent_id IS NULL
        UNION ALL SELECT c.id, c.name, depth + 1, path || ' > ' || c.name FROM categories c JOIN tree ON c.parent_id = tree.id)
        SELECT * FROM tree)""",
    ),
)
def category_tree(t: Tables) -> DataFrame:
    return trees.paths(t.categories, "id", "parent_id", "name")


@query(
    "rec_02_revenue_rollup",
    with_(
        "categories shop_orders",
        """SELECT a.id, a.name, CAST(coalesce(sum(o.total), 0) AS DOUBLE) AS revenue, count(o.order_id) AS orders FROM categories a
        LEFT JOIN (SELECT n_nationkey + 100 AS nation, n_regionkey + 1 AS region, 0 AS world, total, order_id
        FROM shop_orders JOIN customer ON customer_id = c_custkey JOIN nation ON c_nationkey = n_nationkey) o
        ON a.id IN (o.nation, o.region, o.world) GROUP BY 1, 2""",
    ),
)
def revenue_rollup(t: Tables) -> DataFrame:
    """Revenue per nation first, then pushed up to every ancestor."""
    spent = t.shop_orders.groupBy("customer_id").agg(F.sum("total").alias("revenue"), F.count("*").alias("orders"))
    by_nation = (
        spent.join(t.customer.select(F.col("c_custkey").alias("customer_id"), "c_nationkey"), "customer_id")
        .groupBy((F.col("c_nationkey") + 100).alias("id"))
        .agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    )
    closure = trees.closure(t.categories, "id", "parent_id")
    rolled = closure.join(by_nation, "id").groupBy(F.col("ancestor").alias("id")).agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
    return t.categories.join(rolled, "id", "left").select(
        "id", "name", F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"), F.coalesce("orders", F.lit(0)).alias("orders")
    )


@query("rec_03_leaf_flag", with_("categories", "SELECT id, name, id NOT IN (SELECT parent_id FROM categories WHERE parent_id IS NOT NULL) AS is_leaf FROM categories"))
def leaf_flag(t: Tables) -> DataFrame:
    parents = t.categories.select(F.col("parent_id").alias("id")).filter(F.col("id").isNotNull()).distinct().withColumn("is_parent", F.lit(True))
    return t.categories.join(parents, "id", "left").select("id", "name", F.col("is_parent").isNull().alias("is_leaf"))
