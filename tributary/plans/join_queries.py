"""Join queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.operators import joins
from tributary.plans.registry import query
from tributary.plans.sql import cte, with_
from tributary.tables import ORDER_STATUS, Tables

cte(
    "skewed_orders",
    """SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 20 = 0 THEN 1 ELSE o_custkey END AS customer_id FROM orders""",
)


def skewed_orders(t: Tables) -> DataFrame:
    """One customer takes 5 % of all orders."""
    customer = F.when(F.col("o_orderkey") % 20 == 0, F.lit(1).cast("bigint")).otherwise(F.col("o_custkey"))
    return t.orders.select(F.col("o_orderkey").alias("order_id"), customer.alias("customer_id"))


@query(
    "joi_01_revenue_per_category",
    with_(
        "shop_items shop_products",
        """SELECT category, CAST(sum(line_total) AS DOUBLE) AS revenue, CAST(sum(qty) AS BIGINT) AS units FROM shop_items
        JOIN shop_products USING (product_id) GROUP BY 1""",
    ),
)
def revenue_per_category(t: Tables) -> DataFrame:
    """Lines are summed per product before the join, so a best-seller is one row there."""
    sold = t.shop_items.groupBy("product_id").agg(F.sum("line_total").alias("revenue"), F.sum("qty").alias("units"))
    return (
        sold.join(t.shop_products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("revenue").cast("double").alias("revenue"), F.sum("units").alias("units"))
    )


@query(
    "joi_02_left_without_match",
    with_(
        "shop_customers shop_orders",
        """SELECT c.customer_id, c.tier FROM shop_customers c LEFT JOIN (SELECT DISTINCT customer_id FROM shop_orders WHERE status = 'F'
        AND created_at >= TIMESTAMP '2000-01-01') o ON c.customer_id = o.customer_id WHERE o.customer_id IS NULL""",
    ),
)
def left_without_match(t: Tables) -> DataFrame:
    recent = t.shop_orders.filter((F.col("status") == "F") & (F.col("created_at") >= F.lit("2000-01-01").cast("timestamp_ntz")))
    buyers = recent.select("customer_id").distinct().withColumn("bought", F.lit(True))
    return t.shop_customers.join(buyers, "customer_id", "left").filter(F.col("bought").isNull()).select("customer_id", "tier")


@query(
    "joi_02_customers_without_orders",
    """SELECT (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders) ON c_custkey = o_custkey
    WHERE o_custkey IS NULL) AS without_orders""",
)
def customers_without_orders(t: Tables) -> DataFrame:
    """The plain form, counted: the given tables may hold no such customer."""
    buyers = t.shop_orders.select("customer_id").distinct().withColumn("bought", F.lit(True))
    return t.shop_customers.join(buyers, "customer_id", "left").agg(
        F.count("*").alias("customers"), F.count_if(F.col("bought").isNull()).alias("without_orders")
    )


@query(
    "joi_03_on_versus_where",
    with_(
        "shop_customers shop_orders",
        """SELECT (SELECT count(*) FROM shop_customers c LEFT JOIN shop_orders o ON c.customer_id = o.customer_id AND o.status = 'P') AS on_rows,
        (SELECT count(*) FROM shop_customers c LEFT JOIN shop_orders o ON c.customer_id = o.customer_id WHERE o.status = 'P') AS where_rows""",
    ),
)
def on_versus_where(t: Tables) -> DataFrame:
    """A right-side predicate after a left join drops the unmatched rows again."""
    c = t.shop_customers.select("customer_id")
    o = t.shop_orders.select("customer_id", "status")
    paid = o.filter(F.col("status") == "P")
    where = c.join(o, "customer_id", "left").filter(F.col("status") == "P").agg(F.count("*"))
    return c.join(paid, "customer_id", "left").agg(F.count("*").alias("on_rows")).withColumn("where_rows", where.scalar())


@query(
    "joi_04_right_never_sold",
    with_(
        "shop_items shop_products",
        """SELECT product_id, name FROM shop_products WHERE product_id NOT IN (SELECT product_id FROM shop_items WHERE return_flag = 'R' AND qty >= 45)""",
    ),
)
def right_never_sold(t: Tables) -> DataFrame:
    """Products without any large returned line."""
    sold = t.shop_items.filter((F.col("return_flag") == "R") & (F.col("qty") >= 45)).select("product_id").distinct().withColumn("sold", F.lit(True))
    return sold.join(t.shop_products, "product_id", "right").filter(F.col("sold").isNull()).select("product_id", "name")


@query(
    "joi_04_products_never_sold",
    "SELECT (SELECT count(*) FROM part) AS products, (SELECT count(*) FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem)) AS never_sold",
)
def products_never_sold(t: Tables) -> DataFrame:
    """The plain form, counted."""
    sold = t.shop_items.select("product_id").distinct().withColumn("sold", F.lit(True))
    return sold.join(t.shop_products, "product_id", "right").agg(F.count("*").alias("products"), F.count_if(F.col("sold").isNull()).alias("never_sold"))


@query(
    "joi_05_full_reconciliation",
    with_(
        "shop_orders",
        """SELECT coalesce(a.customer_id, b.customer_id) AS customer_id, CASE WHEN b.customer_id IS NULL THEN 'only_a'
        WHEN a.customer_id IS NULL THEN 'only_b' ELSE 'both' END AS side
        FROM (SELECT DISTINCT customer_id FROM shop_orders WHERE status = 'P' AND total > 250000) a
        FULL JOIN (SELECT DISTINCT customer_id FROM shop_orders WHERE status = 'F' AND total > 250000) b ON a.customer_id = b.customer_id""",
    ),
)
def full_reconciliation(t: Tables) -> DataFrame:
    large = t.shop_orders.filter(F.col("total") > 250000)
    a = large.filter(F.col("status") == "P").select("customer_id").distinct().withColumn("a", F.lit(True))
    b = large.filter(F.col("status") == "F").select("customer_id").distinct().withColumn("b", F.lit(True))
    side = F.when(F.col("b").isNull(), "only_a").when(F.col("a").isNull(), "only_b").otherwise("both")
    return a.join(b, "customer_id", "full").select("customer_id", side.alias("side"))


@query(
    "joi_06_report_grid",
    with_(
        "shop_customers shop_orders",
        """SELECT g.tier, g.status, count(o.order_id) AS n FROM (SELECT * FROM (SELECT DISTINCT tier FROM shop_customers)
        CROSS JOIN (VALUES ('O'), ('P'), ('F'), ('X')) s(status)) g LEFT JOIN (SELECT tier, status, order_id FROM shop_orders JOIN shop_customers USING (customer_id)) o
        ON g.tier = o.tier AND g.status = o.status GROUP BY 1, 2""",
    ),
)
def report_grid(t: Tables) -> DataFrame:
    """Every tier with every declared status, counted cells or zero."""
    statuses = F.array(*map(F.lit, [*ORDER_STATUS, "X"]))
    tiers = t.shop_customers.select("customer_id", "tier")
    grid = tiers.select("tier").distinct().withColumn("status", F.explode(statuses))
    per_customer = t.shop_orders.groupBy("customer_id", "status").agg(F.count("*").alias("n"))
    cells = per_customer.join(tiers, "customer_id").groupBy("tier", "status").agg(F.sum("n").alias("n"))
    return grid.join(cells, ["tier", "status"], "left").na.fill(0, ["n"])


@query("joi_07_self_parent", with_("categories", "SELECT c.id, c.name, p.name AS parent FROM categories c LEFT JOIN categories p ON c.parent_id = p.id"))
def self_parent(t: Tables) -> DataFrame:
    child, parent = t.categories.alias("c"), t.categories.alias("p")
    return child.join(parent, F.col("c.parent_id") == F.col("p.id"), "left").select("c.id", "c.name", F.col("p.name").alias("parent"))


@query(
    "joi_08_lateral_top3",
    with_(
        "shop_products",
        """SELECT category, product_id, CAST(price AS DOUBLE) AS price FROM (SELECT *, row_number() OVER (PARTITION BY category
        ORDER BY price DESC, product_id) AS rn FROM shop_products) WHERE rn <= 3""",
    ),
)
def lateral_top3(t: Tables) -> DataFrame:
    return t.spark.sql(
        """SELECT c.category, p.product_id, CAST(p.price AS DOUBLE) AS price FROM (SELECT DISTINCT category FROM {products}) c,
        LATERAL (SELECT product_id, price FROM {products} x WHERE x.category = c.category ORDER BY price DESC, product_id LIMIT 3) p""",
        products=t.shop_products,
    )


@query(
    "joi_09_semi",
    with_("shop_customers shop_orders", "SELECT customer_id, tier FROM shop_customers c WHERE EXISTS (SELECT 1 FROM shop_orders o WHERE o.customer_id = c.customer_id AND o.status = 'P' AND o.total > 300000)"),
)
def semi(t: Tables) -> DataFrame:
    wanted = t.shop_orders.filter((F.col("status") == "P") & (F.col("total") > 300000))
    return t.shop_customers.join(wanted, "customer_id", "left_semi").select("customer_id", "tier")



@query(
    "joi_10_anti_and_not_in",
    with_(
        "shop_customers shop_orders",
        """SELECT (SELECT count(*) FROM shop_customers c WHERE NOT EXISTS (SELECT 1 FROM shop_orders o WHERE o.customer_id = c.customer_id
        AND o.status = 'P' AND o.total > 300000)) AS not_exists,
        (SELECT count(*) FROM shop_customers c WHERE c.city NOT IN (SELECT city FROM shop_customers WHERE tier = 'gold')) AS not_in""",
    ),
)
def anti_and_not_in(t: Tables) -> DataFrame:
    """NOT IN over a list that holds a NULL is never true."""
    wanted = t.shop_orders.filter((F.col("status") == "P") & (F.col("total") > 300000))
    missing = t.shop_customers.join(wanted, "customer_id", "left_anti").agg(F.count("*").alias("not_exists"))
    cities = t.shop_customers.filter(F.col("tier") == "gold").select("city").distinct()
    not_in = t.spark.sql("SELECT count(*) AS n FROM {c} c WHERE c.city NOT IN (SELECT city FROM {cities})", c=t.shop_customers, cities=cities)
    return missing.withColumn("not_in", not_in.scalar())


@query(
    "joi_11_fan_out_guard",
    with_(
        "shop_orders shop_items",
        """SELECT w.status, w.multiplied, r.correct FROM (SELECT status, CAST(sum(total) AS DOUBLE) AS multiplied FROM shop_orders
        JOIN shop_items USING (order_id) GROUP BY 1) w JOIN (SELECT status, CAST(sum(total) AS DOUBLE) AS correct FROM shop_orders
        WHERE order_id IN (SELECT order_id FROM shop_items) GROUP BY 1) r ON w.status = r.status""",
    ),
)
def fan_out_guard(t: Tables) -> DataFrame:
    """Lines collapse to one row per order, so a parent column is summed once; the
    naive sum over the joined lines stands beside it."""
    lines = t.shop_items.groupBy("order_id").agg(F.count("*").alias("lines"))
    joined = t.shop_orders.join(lines, "order_id")
    return joined.groupBy("status").agg(
        F.sum(F.col("total") * F.col("lines")).cast("double").alias("multiplied"), F.sum("total").cast("double").alias("correct")
    )


TIERED = """SELECT o.order_id, customer_id, tier FROM {orders} o JOIN shop_customers USING (customer_id)"""


@query("joi_12_broadcast", with_("shop_orders shop_customers", TIERED.format(orders="shop_orders")))
def broadcast(t: Tables) -> DataFrame:
    """The small side is broadcast while its size in bytes is below Spark's own threshold."""
    tiers = t.shop_customers.select("customer_id", "tier")
    return t.shop_orders.join(tiers, "customer_id").select("order_id", "customer_id", "tier")


@query("joi_13_sort_merge", with_("shop_orders shop_customers", TIERED.format(orders="shop_orders")))
def sort_merge(t: Tables) -> DataFrame:
    tiers = t.shop_customers.select("customer_id", "tier").hint("merge")
    return t.shop_orders.join(tiers, "customer_id").select("order_id", "customer_id", "tier")


@query("joi_13_shuffle_hash", with_("shop_orders shop_customers", TIERED.format(orders="shop_orders")))
def shuffle_hash(t: Tables) -> DataFrame:
    tiers = t.shop_customers.select("customer_id", "tier").hint("shuffle_hash")
    return t.shop_orders.join(tiers, "customer_id").select("order_id", "customer_id", "tier")


@query("joi_14_salted", with_("skewed_orders shop_customers", TIERED.format(orders="skewed_orders")))
def salted(t: Tables) -> DataFrame:
    return joins.salted_join(skewed_orders(t), t.shop_customers.select("customer_id", "tier"), "customer_id", "order_id").select(
        "order_id", "customer_id", "tier"
    )


@query("joi_15_hot_split", with_("skewed_orders shop_customers", TIERED.format(orders="skewed_orders")))
def hot_split(t: Tables) -> DataFrame:
    return joins.hot_split_join(skewed_orders(t), t.shop_customers.select("customer_id", "tier"), "customer_id").select(
        "order_id", "customer_id", "tier"
    )


@query(
    "joi_16_skew_profile",
    with_("skewed_orders", "SELECT customer_id, count(*) AS n, count(*) / (SELECT count(*) FROM skewed_orders) AS share FROM skewed_orders GROUP BY 1"),
)
def skew_profile(t: Tables) -> DataFrame:
    return joins.skew_profile(skewed_orders(t), "customer_id")


@query(
    "joi_16_partition_profile",
    with_("skewed_orders", "SELECT CAST(count(*) AS BIGINT) AS n, true AS holds_hot_key FROM skewed_orders"),
)
def partition_profile(t: Tables) -> DataFrame:
    """All rows are counted, and the fullest partition holds at least the hottest key."""
    orders = skewed_orders(t)
    hottest = orders.groupBy("customer_id").count().agg(F.max("count")).scalar()
    profile = joins.partition_profile(orders.repartition("customer_id"))
    return profile.agg(F.sum("n").alias("n"), F.max("n").alias("fullest")).select("n", (F.col("fullest") >= hottest).alias("holds_hot_key"))


@query("joi_17_by_name", with_("shop_orders shop_customers", "SELECT customer_id, order_id, tier FROM shop_orders JOIN shop_customers USING (customer_id)"))
def by_name(t: Tables) -> DataFrame:
    """Joining by name keeps one key column."""
    return t.shop_orders.select("customer_id", "order_id").join(t.shop_customers.select("customer_id", "tier"), "customer_id")


@query(
    "joi_17_by_expression",
    with_("shop_orders shop_customers", "SELECT o.customer_id AS buyer, o.order_id, c.customer_id, c.tier FROM shop_orders o JOIN shop_customers c ON o.customer_id = c.customer_id"),
)
def by_expression(t: Tables) -> DataFrame:
    """Joining by expression keeps both; one is renamed so that neither is ambiguous."""
    o = t.shop_orders.select(F.col("customer_id").alias("buyer"), "order_id")
    c = t.shop_customers.select("customer_id", "tier")
    return o.join(c, o["buyer"] == c["customer_id"])


@query(
    "joi_18_range_containment",
    with_(
        "shop_items promotions",
        """SELECT order_id, line_no, i.product_id, promo, CAST(line_total AS DOUBLE) AS line_total FROM shop_items i JOIN promotions p
        ON i.product_id = p.product_id AND i.shipped_at >= p.valid_from AND i.shipped_at < p.valid_to""",
    ),
)
def range_containment(t: Tables) -> DataFrame:
    """Lines shipped inside a promotion of their product."""
    inside = joins.range_join(t.shop_items, t.promotions, "product_id", "shipped_at", "valid_from", "valid_to")
    return inside.select("order_id", "line_no", "product_id", "promo", F.col("line_total").cast("double").alias("line_total"))


@query(
    "joi_19_update_from",
    with_(
        "shop_orders shop_items",
        """SELECT o.order_id, CAST(coalesce(s.total, 0) AS DOUBLE) AS total, CAST(o.total AS DOUBLE) AS old_total FROM shop_orders o
        LEFT JOIN (SELECT order_id, sum(line_total) AS total FROM shop_items GROUP BY 1) s ON o.order_id = s.order_id""",
    ),
)
def update_from(t: Tables) -> DataFrame:
    sums = t.shop_items.groupBy("order_id").agg(F.sum("line_total").alias("new_total"))
    total = F.coalesce(F.col("new_total").cast("double"), F.lit(0.0))
    return t.shop_orders.join(sums, "order_id", "left").select("order_id", total.alias("total"), F.col("total").cast("double").alias("old_total"))


@query(
    "joi_20_theta",
    with_(
        "shop_orders",
        """SELECT band, count(*) AS n, CAST(sum(total) AS DOUBLE) AS revenue FROM shop_orders JOIN (VALUES ('small', 0, 50000), ('medium', 50000, 200000),
        ('large', 200000, 100000000)) b(band, lo, hi) ON total >= lo AND total < hi GROUP BY 1""",
    ),
)
def theta(t: Tables) -> DataFrame:
    """Non-equi join against a fixed list of three price bands."""
    bands = t.spark.sql("SELECT * FROM VALUES ('small', 0, 50000), ('medium', 50000, 200000), ('large', 200000, 100000000) AS b(band, lo, hi)")
    inside = (F.col("total") >= F.col("lo")) & (F.col("total") < F.col("hi"))
    joined = t.shop_orders.join(F.broadcast(bands), inside)
    return joined.groupBy("band").agg(F.count("*").alias("n"), F.sum("total").cast("double").alias("revenue"))
