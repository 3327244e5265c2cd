"""Queries over the bronze, silver and gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.operators import quality
from tributary.plans import medallion
from tributary.plans.registry import query
from tributary.plans.sql import cte, with_
from tributary.sources import sinks
from tributary.storage import run_path
from tributary.tables import Tables

DAY = "2024-01-15"

cte(
    "daily_funnel",
    """SELECT CAST(event_date AS VARCHAR) AS day, category, device, views, clicks, carts, purchases, CASE WHEN views = 0 THEN 0 ELSE purchases / views END AS buy_rate FROM (
    SELECT event_date, category, device, count(*) FILTER (WHERE event_type = 'view') AS views, count(*) FILTER (WHERE event_type = 'click') AS clicks,
    count(*) FILTER (WHERE event_type = 'signup') AS carts, count(*) FILTER (WHERE event_type = 'purchase') AS purchases
    FROM events_silver JOIN shop_products USING (product_id) GROUP BY 1, 2, 3)""",
    "events_silver",
    "shop_products",
)
cte(
    "daily_revenue",
    """SELECT strftime(created_at, '%Y-%m-%d') AS day, category, sum(line_total) AS revenue, count(DISTINCT order_id) AS orders FROM shop_orders
    JOIN shop_items USING (order_id) JOIN shop_products USING (product_id) GROUP BY 1, 2""",
    "shop_orders",
    "shop_items",
    "shop_products",
)


def bronze(t: Tables) -> str:
    raw, path = run_path(t.spark, "raw-events"), run_path(t.spark, "bronze-events")
    t.events_raw.write.json(raw)
    medallion.to_bronze(t.spark, raw, path)
    return path


def silver(t: Tables) -> str:
    path = run_path(t.spark, "silver-events")
    medallion.to_silver(t.spark, bronze(t), path)
    return path


def funnel(t: Tables) -> DataFrame:
    """Gold is built only from silver that passed the gate."""
    events = medallion.read_silver(t.spark, silver(t))
    quality.require(medallion.gate(events, "2024-01-01", "2024-12-31"))
    return medallion.daily_funnel(events, t.shop_products)


def revenue(t: Tables) -> DataFrame:
    return medallion.daily_revenue(t.shop_orders, t.shop_items, t.shop_products)


@query("pip_01_bronze", with_("events_raw", "SELECT event_id, user_id, event_type, ts, true AS stamped FROM events_raw"))
def bronze_events(t: Tables) -> DataFrame:
    stored = medallion.read_bronze(t.spark, bronze(t))
    stamped = F.col("_ingested_at").isNotNull() & F.col("_source_file").endswith(".json") & F.col("ingest_date").isNotNull()
    return stored.select("event_id", "user_id", "event_type", "ts", stamped.alias("stamped"))


@query("pip_02_silver", with_("events_silver", "SELECT event_id, user_id, event_type, product_id, device, event_ts, CAST(event_date AS VARCHAR) AS event_date FROM events_silver"))
def silver_events(t: Tables) -> DataFrame:
    return medallion.read_silver(t.spark, silver(t)).withColumn("event_date", F.col("event_date").cast("string"))


@query(
    "pip_03_gate",
    with_(
        "events_raw",
        """SELECT layer, "check", violations, CASE WHEN violations = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM (
        SELECT 'silver' AS layer, unnest(['unique_event_id', 'user_present', 'known_type', 'time_in_range']) AS "check", CAST(0 AS BIGINT) AS violations
        UNION ALL SELECT 'bronze', 'unique_event_id', count(*) - count(DISTINCT event_id) FROM events_raw
        UNION ALL SELECT 'bronze', 'user_present', count(*) FILTER (WHERE user_id IS NULL) FROM events_raw
        UNION ALL SELECT 'bronze', 'known_type', count(*) FILTER (WHERE event_type NOT IN ('view', 'click', 'signup', 'purchase', 'error')) FROM events_raw
        UNION ALL SELECT 'bronze', 'time_in_range', count(*) FILTER (WHERE NOT (CAST(ts AS TIMESTAMP) BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-12-31')) FROM events_raw)""",
    ),
)
def gate(t: Tables) -> DataFrame:
    """The clean layer passes; the same checks on the raw layer do not."""
    raw = t.events_raw.withColumn("event_ts", quality.parse_time(F.col("ts")))
    layers = {"silver": medallion.read_silver(t.spark, silver(t)), "bronze": raw}
    checked = [medallion.gate(df, "2024-01-01", "2024-12-31").select(F.lit(name).alias("layer"), "*") for name, df in layers.items()]
    return checked[0].unionByName(checked[1])


@query("pip_04_daily_funnel", with_("daily_funnel", "SELECT * FROM daily_funnel"))
def daily_funnel(t: Tables) -> DataFrame:
    return funnel(t).withColumnRenamed("event_date", "day").withColumn("day", F.col("day").cast("string"))


@query("pip_05_daily_revenue", with_("daily_revenue", "SELECT day, category, CAST(revenue AS DOUBLE) AS revenue, orders FROM daily_revenue"))
def daily_revenue(t: Tables) -> DataFrame:
    return revenue(t).select(F.col("day").cast("string").alias("day"), "category", F.col("revenue").cast("double").alias("revenue"), "orders")


@query(
    "pip_06_reload_day",
    with_(
        "events_silver",
        f"""SELECT CAST(event_date AS VARCHAR) AS day, count(*) AS before, count(*) FILTER (WHERE event_date <> DATE '{DAY}' OR event_id % 2 = 1) AS after
        FROM events_silver GROUP BY 1""",
    ),
)
def reload_day(t: Tables) -> DataFrame:
    """Later copies of half of all events take their users away. Reloading one day shows that
    on this day and leaves all others as they were."""
    source, path = bronze(t), run_path(t.spark, "silver-events")
    medallion.to_silver(t.spark, source, path)
    count = lambda name: medallion.read_silver(t.spark, path).groupBy("event_date").agg(F.count("*").alias(name))
    before = run_path(t.spark, "before-reload")
    count("before").write.parquet(before)
    later = run_path(t.spark, "raw-events")
    t.events_raw.filter(F.col("event_id") % 2 == 0).drop("user_id").write.json(later)
    medallion.to_bronze(t.spark, later, source)
    medallion.reload_day(t.spark, source, path, DAY)
    joined = t.spark.read.parquet(before).join(count("after"), "event_date", "full")
    return joined.select(F.col("event_date").cast("string").alias("day"), "before", "after")


@query("pip_07_top_days", with_("daily_revenue", "SELECT day, CAST(sum(revenue) AS DOUBLE) AS revenue FROM daily_revenue GROUP BY 1 ORDER BY sum(daily_revenue.revenue) DESC, day LIMIT 5"))
def top_days(t: Tables) -> DataFrame:
    total = revenue(t).groupBy(F.col("day").cast("string").alias("day")).agg(F.sum("revenue").alias("revenue"))
    return total.orderBy(F.desc("revenue"), "day").limit(5).withColumn("revenue", F.col("revenue").cast("double"))


@query(
    "pip_07_buy_rate",
    with_("daily_funnel", "SELECT category, CAST(sum(views) AS BIGINT) AS views, CAST(sum(purchases) AS BIGINT) AS purchases, sum(purchases) / sum(views) AS buy_rate FROM daily_funnel GROUP BY 1"),
)
def buy_rate(t: Tables) -> DataFrame:
    total = funnel(t).groupBy("category").agg(F.sum("views").alias("views"), F.sum("purchases").alias("purchases"))
    return total.withColumn("buy_rate", medallion.rate("purchases", "views"))


@query(
    "pip_08_viewed_not_bought",
    with_(
        "daily_funnel",
        """SELECT category, device, CAST(sum(views) AS BIGINT) AS views, CAST(sum(purchases) AS BIGINT) AS purchases, sum(purchases) / sum(views) AS buy_rate
        FROM daily_funnel GROUP BY 1, 2 HAVING sum(views) >= 10 AND sum(purchases) / sum(views) < 1""",
    ),
)
def viewed_not_bought(t: Tables) -> DataFrame:
    return medallion.viewed_not_bought(funnel(t), min_views=10, max_rate=1.0)


@query(
    "pip_11_revenue_by_country",
    with_(
        "shop_orders",
        """SELECT strftime(created_at, '%Y-%m-%d') AS day, n_name AS country, CAST(sum(total) AS DOUBLE) AS revenue, count(*) AS orders FROM shop_orders
        JOIN customer ON customer_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2""",
    ),
)
def revenue_by_country(t: Tables) -> DataFrame:
    """Written by country, then read back."""
    countries = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("customer_id"), F.col("n_name").alias("country"))
    path = run_path(t.spark, "revenue-by-country")
    sinks.write_partitioned(medallion.revenue_by_country(t.shop_orders, countries), path, "country")
    stored = t.spark.read.parquet(path)
    return stored.select(F.col("day").cast("string").alias("day"), "country", F.col("revenue").cast("double").alias("revenue"), "orders")
