"""Aggregation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.operators import materialised
from tributary.operators.ordered import exact_percentiles
from tributary.plans.registry import query
from tributary.plans.sql import cte, with_
from tributary.sources import sinks
from tributary.storage import run_path
from tributary.tables import FUNNEL, MONEY, ORDER_STATUS, Tables

SPEND_PARTITIONS = 16

cte(
    "order_totals",
    """SELECT order_id, customer_id, status, created_at, s.total FROM shop_orders JOIN (SELECT order_id, sum(line_total) AS total
    FROM shop_items GROUP BY 1) s USING (order_id)""",
    "shop_orders",
    "shop_items",
)


def order_totals(t: Tables) -> DataFrame:
    """Orders with their total computed from the lines."""
    sums = t.shop_items.groupBy("order_id").agg(F.sum("line_total").alias("total"))
    return t.shop_orders.drop("total").join(sums, "order_id").select("order_id", "customer_id", "status", "created_at", "total")


def month(column: str = "created_at"):
    return F.date_format(column, "yyyy-MM")


@query(
    "agg_01_monthly_revenue",
    with_(
        "order_totals",
        """SELECT strftime(created_at, '%Y-%m') AS month, count(*) AS orders, CAST(sum(total) AS DOUBLE) AS revenue,
        CAST(sum(total) AS DOUBLE) / count(*) AS average, count(DISTINCT customer_id) AS customers FROM order_totals WHERE status <> 'P' GROUP BY 1""",
    ),
)
def monthly_revenue(t: Tables) -> DataFrame:
    kept = order_totals(t).filter(F.col("status") != "P")
    return kept.groupBy(month().alias("month")).agg(
        F.count("*").alias("orders"),
        F.sum("total").cast("double").alias("revenue"),
        (F.sum("total").cast("double") / F.count("*")).alias("average"),
        F.count_distinct("customer_id").alias("customers"),
    )


@query(
    "agg_02_conditional",
    with_(
        "shop_orders",
        """SELECT priority, count(*) FILTER (WHERE status = 'F') AS finished, CAST(coalesce(sum(total) FILTER (WHERE status = 'O'), 0) AS DOUBLE) AS open_total,
        avg(CASE WHEN total > 200000 THEN 1 ELSE 0 END) AS large_share FROM shop_orders GROUP BY 1""",
    ),
)
def conditional(t: Tables) -> DataFrame:
    return t.shop_orders.groupBy("priority").agg(
        F.count_if(F.col("status") == "F").alias("finished"),
        F.sum(F.when(F.col("status") == "O", F.col("total")).otherwise(0)).cast("double").alias("open_total"),
        F.avg((F.col("total") > 200000).cast("int")).alias("large_share"),
    )


@query(
    "agg_03_having",
    with_("shop_orders", "SELECT customer_id, CAST(sum(total) AS DOUBLE) AS spent FROM shop_orders GROUP BY 1 HAVING sum(shop_orders.total) > 2500000"),
)
def having(t: Tables) -> DataFrame:
    spent = t.shop_orders.groupBy("customer_id").agg(F.sum("total").alias("spent"))
    return spent.filter(F.col("spent") > 2500000).withColumn("spent", F.col("spent").cast("double"))


def spend_by_customer(t: Tables) -> DataFrame:
    """Orders collapse per customer before the attributes are joined."""
    spent = t.shop_orders.groupBy("customer_id").agg(F.sum("total").alias("spent"), F.count("*").alias("orders"))
    return spent.join(t.shop_customers, "customer_id")


GROUPED = "CAST(sum(total) AS DOUBLE) AS spent, count(*) AS orders, CAST(grouping(city) * 2 + grouping(tier) AS BIGINT) AS level FROM shop_orders JOIN shop_customers USING (customer_id)"


@query("agg_04_rollup", with_("shop_orders shop_customers", f"SELECT city, tier, {GROUPED} GROUP BY ROLLUP (city, tier)"))
def rollup(t: Tables) -> DataFrame:
    return spend_by_customer(t).rollup("city", "tier").agg(
        F.sum("spent").cast("double").alias("spent"), F.sum("orders").alias("orders"), F.grouping_id().alias("level")
    )


@query("agg_05_cube", with_("shop_orders shop_customers", f"SELECT city, tier, {GROUPED} GROUP BY CUBE (city, tier)"))
def cube(t: Tables) -> DataFrame:
    return spend_by_customer(t).cube("city", "tier").agg(
        F.sum("spent").cast("double").alias("spent"), F.sum("orders").alias("orders"), F.grouping_id().alias("level")
    )


@query("agg_06_grouping_sets", with_("clicks", "SELECT device, count(*) AS n FROM clicks GROUP BY GROUPING SETS ((device), ())"))
def grouping_sets(t: Tables) -> DataFrame:
    return t.clicks.groupingSets([["device"], []], "device").agg(F.count("*").alias("n"))


@query(
    "agg_07_exact_distinct",
    "SELECT event_type, count(DISTINCT user_id) AS users, count(DISTINCT props) AS props FROM events GROUP BY 1",
)
def exact_distinct(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(F.count_distinct("user_id").alias("users"), F.count_distinct("props").alias("props"))


@query("agg_08_approx_distinct", "SELECT count(DISTINCT l_partkey) AS exact, true AS within_bound FROM lineitem")
def approx_distinct(t: Tables) -> DataFrame:
    """HyperLogLog++ at 2 % standard error, within three of them of the exact count.

    Each count is an aggregate of its own: beside an exact count a plan would keep one sketch per distinct value.
    """
    exact = t.lineitem.agg(F.count_distinct("l_partkey").alias("exact"))
    counts = exact.crossJoin(t.lineitem.agg(F.approx_count_distinct("l_partkey", 0.02).alias("approx")))
    return counts.select("exact", (F.abs(F.col("approx") - F.col("exact")) <= 0.06 * F.col("exact")).alias("within_bound"))


@query(
    "agg_09_exact_percentiles",
    with_(
        "shop_orders",
        " UNION ALL ".join(
            f"SELECT status, CAST({q} AS DOUBLE) AS q, round(quantile_cont(CAST(total AS DOUBLE), {q}), 4) AS value FROM shop_orders GROUP BY 1"
            for q in (0.5, 0.9, 0.99)
        ),
    ),
)
def exact_percentile_values(t: Tables) -> DataFrame:
    values = exact_percentiles(t.shop_orders, ["status"], "total", [0.5, 0.9, 0.99], interpolate=True)
    return values.withColumn("value", F.round("value", 4))


@query(
    "agg_10_approx_percentiles",
    with_("shop_orders", "SELECT status, CAST(unnest([0.5, 0.9, 0.99]) AS DOUBLE) AS q, true AS within_bound FROM shop_orders GROUP BY 1"),
)
def approx_percentiles(t: Tables) -> DataFrame:
    """The rank of each estimate lies within 1/1000 of all rows of the wanted one (accuracy 10,000)."""
    wanted = [0.5, 0.9, 0.99]
    estimates = t.shop_orders.groupBy("status").agg(F.percentile_approx("total", wanted, 10000).alias("p"))
    ranks = [F.struct(F.count_if(F.col("total") < F.col("p")[i]).alias("below"), F.count_if(F.col("total") <= F.col("p")[i]).alias("upto"), F.lit(q).alias("q")) for i, q in enumerate(wanted)]
    counted = t.shop_orders.join(estimates, "status").groupBy("status").agg(F.count("*").alias("n"), F.array(*ranks).alias("ranks"))
    slack = F.col("n") / 1000 + 1
    at = F.col("r.q") * F.col("n")
    checked = counted.select("status", "n", F.explode("ranks").alias("r"))
    return checked.select("status", "r.q", ((F.col("r.below") <= at + slack) & (F.col("r.upto") >= at - slack)).alias("within_bound"))


@query(
    "agg_11_collect",
    """SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS types, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS counts
    FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1""",
)
def collect(t: Tables) -> DataFrame:
    """Counted per type first, so a user's list is as long as the type list, not as the history."""
    counted = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    listed = F.sort_array(F.collect_list(F.concat_ws(":", "event_type", "n")))
    return counted.groupBy("user_id").agg(
        F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("types"), F.array_join(listed, ",").alias("counts")
    )


@query(
    "agg_12_pivot",
    with_(
        "shop_orders",
        "SELECT strftime(created_at, '%Y-%m') AS month, "
        + ", ".join(f"nullif(count(*) FILTER (WHERE status = '{s}'), 0) AS {s.lower()}" for s in ORDER_STATUS)
        + " FROM shop_orders GROUP BY 1",
    ),
)
def pivot(t: Tables) -> DataFrame:
    wide = t.shop_orders.groupBy(month().alias("month")).pivot("status", ORDER_STATUS).agg(F.count("order_id"))
    return wide.select("month", *[F.col(s).alias(s.lower()) for s in ORDER_STATUS])


FUNNEL_COUNTS = ", ".join(f"count(*) FILTER (WHERE event_type = '{e}') AS {e}s" for e in FUNNEL)


@query(
    "agg_13_device_funnel",
    with_(
        "clicks",
        f"""SELECT *, clicks / views AS click_rate, signups / clicks AS cart_rate, purchases / signups AS buy_rate
        FROM (SELECT device, {FUNNEL_COUNTS} FROM clicks GROUP BY 1)""",
    ),
)
def device_funnel(t: Tables) -> DataFrame:
    counted = t.clicks.groupBy("device").agg(*[F.count_if(F.col("event_type") == e).alias(f"{e}s") for e in FUNNEL])
    rate = lambda a, b: F.try_divide(F.col(a), F.col(b))
    return counted.select(
        "*",
        rate("clicks", "views").alias("click_rate"),
        rate("signups", "clicks").alias("cart_rate"),
        rate("purchases", "signups").alias("buy_rate"),
    )


@query(
    "agg_14_user_funnel",
    """SELECT count(*) FILTER (WHERE v) AS viewers, count(*) FILTER (WHERE v AND p) AS buyers, count(*) FILTER (WHERE v AND p) / count(*) FILTER (WHERE v) AS rate
    FROM (SELECT user_id, bool_or(event_type = 'view') AS v, bool_or(event_type = 'purchase') AS p FROM events GROUP BY 1)""",
)
def user_funnel(t: Tables) -> DataFrame:
    users = t.events.groupBy("user_id").agg(
        F.bool_or(F.col("event_type") == "view").alias("v"), F.bool_or(F.col("event_type") == "purchase").alias("p")
    )
    counted = users.agg(F.count_if("v").alias("viewers"), F.count_if(F.col("v") & F.col("p")).alias("buyers"))
    return counted.withColumn("rate", F.try_divide("buyers", "viewers"))


@query(
    "agg_15_nested_objects",
    with_(
        "shop_orders shop_items",
        """SELECT order_id, '{"order_id":' || order_id || ',"status":"' || status || '","lines":[' ||
        string_agg('{"line_no":' || line_no || ',"product_id":' || product_id || ',"qty":' || qty || ',"line_total":' || line_total || '}', ','
        ORDER BY line_no, shipped_at, product_id, supplier_id, line_total) || ']}' AS doc
        FROM shop_orders JOIN shop_items USING (order_id) GROUP BY order_id, status""",
    ),
)
def nested_objects(t: Tables) -> DataFrame:
    """One JSON object per order with its lines in order: one shuffle, and the object is one cell by definition."""
    line = F.struct("line_no", "shipped_at", "product_id", "supplier_id", "line_total", "qty")
    lines = t.shop_items.groupBy("order_id").agg(F.sort_array(F.collect_list(line)).alias("sorted"))
    joined = lines.join(t.shop_orders.select("order_id", "status"), "order_id")
    shown = F.transform("sorted", lambda x: F.struct(x["line_no"].alias("line_no"), x["product_id"].alias("product_id"), x["qty"].alias("qty"), x["line_total"].alias("line_total")))
    return joined.select("order_id", F.to_json(F.struct("order_id", "status", shown.alias("lines"))).alias("doc"))


@query(
    "agg_16_spend_per_tier",
    with_(
        "shop_orders shop_customers",
        """SELECT tier, CAST(sum(spent) AS DOUBLE) / count(*) AS average, count(*) AS customers FROM (SELECT customer_id, sum(total) AS spent
        FROM shop_orders GROUP BY 1) JOIN shop_customers USING (customer_id) GROUP BY 1""",
    ),
)
def spend_per_tier(t: Tables) -> DataFrame:
    return spend_by_customer(t).groupBy("tier").agg(
        (F.sum("spent").cast("double") / F.count("*")).alias("average"), F.count("*").alias("customers")
    )


@query(
    "agg_17_latest_per_key",
    with_(
        "shop_orders",
        """SELECT customer_id, order_id, created_at, status FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
        ORDER BY created_at DESC, order_id DESC) AS rn FROM shop_orders) WHERE rn = 1""",
    ),
)
def latest_per_key(t: Tables) -> DataFrame:
    newest = F.max(F.struct("created_at", "order_id", "status"))
    return t.shop_orders.groupBy("customer_id").agg(newest.alias("o")).select("customer_id", "o.order_id", "o.created_at", "o.status")


NEAREST = ", ".join(f"max(value) FILTER (WHERE rn = greatest(ceil({q} * n), 1)) AS p{int(q * 100)}" for q in (0.5, 0.9, 0.99))


@query(
    "agg_18_step_summary",
    f"""SELECT step, n, CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) / n AS average, min(value) AS minimum, {NEAREST}, max(value) AS maximum,
    CAST(sum(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total FROM (SELECT event_type AS step, value,
    row_number() OVER (PARTITION BY event_type ORDER BY value) AS rn, count(*) OVER (PARTITION BY event_type) AS n FROM events) GROUP BY step, n""",
)
def step_summary(t: Tables) -> DataFrame:
    """Count, average, extremes, nearest-rank percentiles and sum per step."""
    samples = t.events.select(F.col("event_type").alias("step"), "value")
    stats = samples.groupBy("step").agg(
        F.count("*").alias("n"),
        F.min("value").alias("minimum"),
        F.max("value").alias("maximum"),
        F.sum(F.col("value").cast(MONEY)).cast("double").alias("total"),
    )
    quantiles = exact_percentiles(samples, ["step"], "value", [0.5, 0.9, 0.99], interpolate=False)
    wide = quantiles.groupBy("step").agg(*[F.max(F.when(F.col("q") == q, F.col("value"))).alias(f"p{int(q * 100)}") for q in (0.5, 0.9, 0.99)])
    joined = stats.join(wide, "step")
    return joined.select("step", "n", (F.col("total") / F.col("n")).alias("average"), "minimum", "p50", "p90", "p99", "maximum", "total")


@query("agg_19_group_by_json_field", with_("shop_products", "SELECT attrs ->> '$.brand' AS brand, count(*) AS n FROM shop_products GROUP BY 1"))
def group_by_json_field(t: Tables) -> DataFrame:
    return t.shop_products.groupBy(F.get_json_object("attrs", "$.brand").alias("brand")).agg(F.count("*").alias("n"))


@query(
    "agg_20_top_attribute_row",
    with_(
        "shop_products",
        """SELECT brand, product_id, months FROM (SELECT brand, product_id, CAST(attrs ->> '$.warranty_months' AS INTEGER) AS months, row_number() OVER (PARTITION BY brand
        ORDER BY CAST(attrs ->> '$.warranty_months' AS INTEGER) DESC, price DESC, product_id DESC) AS rn FROM shop_products) WHERE rn = 1""",
    ),
)
def top_attribute_row(t: Tables) -> DataFrame:
    months = F.get_json_object("attrs", "$.warranty_months").cast("int")
    best = F.max(F.struct(months.alias("months"), "price", "product_id"))
    return t.shop_products.groupBy("brand").agg(best.alias("b")).select("brand", "b.product_id", "b.months")


@query(
    "agg_21_customer_spend",
    with_("shop_orders", "SELECT customer_id, count(*) AS orders, CAST(sum(total) AS DOUBLE) AS spent, max(created_at) AS last_order FROM shop_orders GROUP BY 1"),
)
def customer_spend(t: Tables) -> DataFrame:
    """A view stores the plan, not the rows."""
    t.shop_orders.createOrReplaceTempView("v_shop_orders")
    t.spark.sql(
        """CREATE OR REPLACE TEMP VIEW v_customer_spend AS SELECT customer_id, count(*) AS orders, CAST(sum(total) AS DOUBLE) AS spent,
        max(created_at) AS last_order FROM v_shop_orders GROUP BY customer_id"""
    )
    return t.spark.table("v_customer_spend")


@query(
    "agg_21_refreshed_daily_revenue",
    with_("shop_orders", "SELECT strftime(created_at, '%Y-%m') AS month, strftime(created_at, '%Y-%m-%d') AS day, CAST(sum(total) AS DOUBLE) AS revenue, count(*) AS orders FROM shop_orders GROUP BY 1, 2"),
)
def refreshed_daily_revenue(t: Tables) -> DataFrame:
    """Materialised daily revenue; a refresh rebuilds only the months that changed."""
    daily = t.shop_orders.groupBy(month().alias("month"), F.date_format("created_at", "yyyy-MM-dd").alias("day")).agg(
        F.sum("total").alias("revenue"), F.count("*").alias("orders")
    )
    path = run_path(t.spark, "daily-revenue")
    stale = F.col("month") >= "2000-01"
    sinks.write_partitioned(daily.withColumn("revenue", F.when(stale, 0).otherwise(F.col("revenue")).cast("decimal(22,2)")), path, "month")
    sinks.overwrite_partitions(daily.filter(stale).withColumn("revenue", F.col("revenue").cast("decimal(22,2)")), path, "month")
    stored = t.spark.read.schema("day string, revenue decimal(22,2), orders bigint, month string").parquet(path)
    return stored.select("month", "day", F.col("revenue").cast("double").alias("revenue"), "orders")


def before_changes(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An earlier state of the orders, and the changes that lead from it to the present one:
    inserts, updates that also move an order to another day or customer, and deletes."""
    key, gone = F.col("order_id"), F.col("order_id") % 7 == 1
    kept = orders.filter(key % 7 != 0)  # the others are inserted
    moved = key % 7 == 2
    earlier = kept.withColumns(
        {
            "total": F.when(moved, F.col("total") + 1).otherwise(F.col("total")).cast(MONEY),
            "created_at": F.when(moved, F.col("created_at") - F.expr("INTERVAL 40 DAY")).otherwise(F.col("created_at")),
            "customer_id": F.when(moved, F.col("customer_id") + 1).otherwise(F.col("customer_id")),
        }
    )
    deleted = orders.filter(gone).withColumn("order_id", -key - 1)
    newest = orders.filter((key % 7 == 0) | moved).withColumn("deleted", F.lit(False))
    return earlier.unionByName(deleted), newest.unionByName(deleted.withColumn("deleted", F.lit(True)))


@query(
    "agg_21_incremental_daily_revenue",
    with_("shop_orders", "SELECT strftime(created_at, '%Y-%m-%d') AS day, CAST(sum(total) AS DOUBLE) AS revenue, count(*) AS orders FROM shop_orders GROUP BY 1"),
)
def incremental_daily_revenue(t: Tables) -> DataFrame:
    """Daily revenue by months, brought from an earlier state to the present by its changes."""
    earlier, changes = before_changes(t.shop_orders)
    day = F.date_format("created_at", "yyyy-MM-dd")
    view = materialised.SumView(run_path(t.spark, "daily-view"), {"day": day}, {"revenue": F.col("total")}, F.substring("day", 1, 7))
    materialised.build(view, earlier)
    materialised.refresh(view, materialised.signed_changes(earlier, changes, "order_id"), 1)
    stored = materialised.read(t.spark, view, t.shop_orders)
    return stored.select("day", F.col("revenue").cast("double").alias("revenue"), F.col("n_rows").alias("orders"))


@query(
    "agg_21_incremental_spend",
    with_("shop_orders", "SELECT customer_id, CAST(sum(total) AS DOUBLE) AS spent, count(*) AS orders FROM shop_orders GROUP BY 1"),
)
def incremental_spend(t: Tables) -> DataFrame:
    """Spend per customer in hash partitions; the inserts and updates come first, then the deletes."""
    earlier, changes = before_changes(t.shop_orders)
    part = F.pmod(F.xxhash64("customer_id"), F.lit(SPEND_PARTITIONS))
    view = materialised.SumView(run_path(t.spark, "spend-view"), {"customer_id": F.col("customer_id")}, {"spent": F.col("total")}, part)
    materialised.build(view, earlier)
    for version, deleted in enumerate((False, True), 1):
        some = changes.filter(F.col("deleted") == deleted)
        materialised.refresh(view, materialised.signed_changes(earlier, some, "order_id"), version)
    stored = materialised.read(t.spark, view, t.shop_orders)
    return stored.select("customer_id", F.col("spent").cast("double").alias("spent"), F.col("n_rows").alias("orders"))


@query(
    "agg_22_size_distribution",
    """SELECT lang, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS total, min(n_chars) AS smallest, max(n_chars) AS largest,
    CAST(sum(n_chars) AS DOUBLE) / count(*) AS average, arg_max(n_chars, doc_id) AS latest FROM documents GROUP BY 1""",
)
def size_distribution(t: Tables) -> DataFrame:
    return t.documents.groupBy("lang").agg(
        F.count("*").alias("n"),
        F.sum("n_chars").alias("total"),
        F.min("n_chars").alias("smallest"),
        F.max("n_chars").alias("largest"),
        (F.sum("n_chars").cast("double") / F.count("*")).alias("average"),
        F.max_by("n_chars", "doc_id").alias("latest"),
    )
