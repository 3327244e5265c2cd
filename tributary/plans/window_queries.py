"""Window queries. Windows over raw rows use ordered scans; plain windows run on aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tributary.operators.ordered import ordered_scan, sessionise, tiles
from tributary.plans.aggregate_queries import month
from tributary.plans.registry import query
from tributary.plans.sql import cte, with_
from tributary.tables import MONEY, Tables

cte("monthly", "SELECT strftime(created_at, '%Y-%m') AS month, sum(total) AS revenue FROM shop_orders GROUP BY 1", "shop_orders")
cte(
    "sessions",
    """SELECT *, CAST(sum(flag) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session_id FROM (SELECT *, CASE WHEN ts - lag(ts)
    OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS flag FROM clicks)""",
    "clicks",
)


def monthly(t: Tables) -> DataFrame:
    """One row per calendar month: small enough for a window without a partition key."""
    return t.shop_orders.groupBy(month().alias("month")).agg(F.sum("total").alias("revenue"))


def by_month():
    return Window.orderBy("month")


@query(
    "win_01_ranks",
    with_(
        "shop_products",
        """SELECT product_id, category, row_number() OVER (PARTITION BY category ORDER BY price DESC, product_id) AS row_no,
        rank() OVER w AS rank, dense_rank() OVER w AS dense FROM shop_products WINDOW w AS (PARTITION BY category ORDER BY price DESC)""",
    ),
)
def ranks(t: Tables) -> DataFrame:
    priced = t.shop_products.select("product_id", "category", (-F.col("price")).alias("desc_price"))
    ranked = ordered_scan(
        priced, ["category"], ["desc_price", "product_id"], row_number="row_no", rank="rank", dense_rank="dense"
    )
    return ranked.drop("desc_price")


@query(
    "win_02_top_n",
    with_(
        "shop_items shop_products",
        """SELECT category, product_id, CAST(revenue AS DOUBLE) AS revenue, rn FROM (SELECT *, row_number() OVER (PARTITION BY category
        ORDER BY revenue DESC, product_id) AS rn FROM (SELECT category, product_id, sum(line_total) AS revenue FROM shop_items
        JOIN shop_products USING (product_id) GROUP BY 1, 2)) WHERE rn <= 3""",
    ),
)
def top_n(t: Tables) -> DataFrame:
    sold = t.shop_items.groupBy("product_id").agg(F.sum("line_total").alias("revenue"))
    named = sold.join(t.shop_products.select("product_id", "category"), "product_id")
    best = Window.partitionBy("category").orderBy(F.desc("revenue"), "product_id")
    top = named.withColumn("rn", F.row_number().over(best)).filter(F.col("rn") <= 3)
    return top.select("category", "product_id", F.col("revenue").cast("double").alias("revenue"), F.col("rn").cast("bigint").alias("rn"))


@query(
    "win_03_month_over_month",
    with_("monthly", "SELECT month, (CAST(revenue AS DOUBLE) / CAST(lag(revenue) OVER (ORDER BY month) AS DOUBLE) - 1) * 100 AS growth FROM monthly"),
)
def month_over_month(t: Tables) -> DataFrame:
    before = F.lag("revenue").over(by_month()).cast("double")
    return monthly(t).select("month", ((F.col("revenue").cast("double") / before - 1) * 100).alias("growth"))


@query("win_04_running_total", with_("monthly", "SELECT month, CAST(sum(revenue) OVER (ORDER BY month) AS DOUBLE) AS running FROM monthly"))
def running_total(t: Tables) -> DataFrame:
    so_far = by_month().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return monthly(t).select("month", F.sum("revenue").over(so_far).cast("double").alias("running"))


@query(
    "win_05_moving_average",
    with_(
        "monthly",
        """SELECT month, CAST(sum(revenue) OVER w AS DOUBLE) / count(*) OVER w AS average FROM monthly
        WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    ),
)
def moving_average(t: Tables) -> DataFrame:
    last3 = by_month().rowsBetween(-2, 0)
    average = F.sum("revenue").over(last3).cast("double") / F.count("*").over(last3)
    return monthly(t).select("month", average.alias("average"))


@query(
    "win_06_trailing_week",
    with_(
        "shop_orders",
        """SELECT DISTINCT customer_id, strftime(created_at, '%Y-%m-%d') AS day, CAST(sum(total) OVER w AS DOUBLE) AS week_total, count(*) OVER w AS week_orders
        FROM shop_orders WINDOW w AS (PARTITION BY customer_id ORDER BY created_at RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
    ),
)
def trailing_week(t: Tables) -> DataFrame:
    """Orders collapse per customer and day first, so a window holds days, not orders."""
    daily = t.shop_orders.groupBy("customer_id", F.to_date("created_at").alias("day")).agg(F.sum("total").alias("total"), F.count("*").alias("n"))
    week = Window.partitionBy("customer_id").orderBy(F.unix_date("day")).rangeBetween(-6, 0)
    return daily.select(
        "customer_id",
        F.col("day").cast("string").alias("day"),
        F.sum("total").over(week).cast("double").alias("week_total"),
        F.sum("n").over(week).alias("week_orders"),
    )


@query(
    "win_07_range_versus_rows",
    with_(
        "shop_orders",
        """SELECT order_id, CAST(sum(total) OVER (PARTITION BY customer_id ORDER BY created_at, order_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS by_rows,
        CAST(sum(total) OVER (PARTITION BY customer_id ORDER BY created_at) AS DOUBLE) AS by_range FROM shop_orders""",
    ),
)
def range_versus_rows(t: Tables) -> DataFrame:
    """ROWS stops at the row, RANGE takes all its ties; ties are one day of one customer."""
    orders = t.shop_orders.select("order_id", "customer_id", "created_at", "total")
    by_rows = ordered_scan(orders, ["customer_id"], ["created_at", "order_id"], sums={"by_rows": "total"})
    daily = orders.groupBy("customer_id", "created_at").agg(F.sum("total").alias("total"))
    so_far = Window.partitionBy("customer_id").orderBy("created_at").rowsBetween(Window.unboundedPreceding, 0)
    day = F.struct("customer_id", "created_at").alias("day")  # joins a missing customer, too
    by_range = daily.select(day, F.sum("total").over(so_far).alias("by_range"))
    return by_rows.select("*", day).join(by_range, "day").select(
        "order_id", F.col("by_rows").cast("double").alias("by_rows"), F.col("by_range").cast("double").alias("by_range")
    )


@query(
    "win_08_quartiles",
    with_(
        "shop_orders",
        """SELECT customer_id, CAST(ntile(4) OVER (ORDER BY spent, customer_id) AS INTEGER) AS quartile
        FROM (SELECT customer_id, sum(total) AS spent FROM shop_orders GROUP BY 1)""",
    ),
)
def quartiles(t: Tables) -> DataFrame:
    """One global order over all customers without sending them to one task."""
    spent = t.shop_orders.groupBy("customer_id").agg(F.sum("total").alias("spent"))
    placed = ordered_scan(spent, [], ["spent", "customer_id"], row_number="rn", total="n")
    return placed.select("customer_id", tiles(F.col("rn"), F.col("n"), 4).alias("quartile"))


def sessions(t: Tables, gap: str = "6 HOURS") -> DataFrame:
    return sessionise(t.clicks, "user_id", ["ts", "event_id"], gap)


@query("win_09_sessions", with_("sessions", "SELECT event_id, user_id, session_id FROM sessions"))
def session_ids(t: Tables) -> DataFrame:
    return sessions(t).select("event_id", "user_id", "session_id")


@query(
    "win_10_session_length",
    with_("sessions", "SELECT user_id, session_id, count(*) AS events, CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS BIGINT) AS micros FROM sessions GROUP BY 1, 2"),
)
def session_length(t: Tables) -> DataFrame:
    length = F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp"))
    return sessions(t).groupBy("user_id", "session_id").agg(F.count("*").alias("events"), length.alias("micros"))


@query(
    "win_10_sessions_other_gap",
    with_(
        "clicks",
        """SELECT user_id, CAST(sum(flag) AS BIGINT) AS sessions FROM (SELECT user_id, CASE WHEN ts - lag(ts)
        OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL 1 DAY THEN 0 ELSE 1 END AS flag FROM clicks) GROUP BY 1""",
    ),
)
def sessions_other_gap(t: Tables) -> DataFrame:
    return sessions(t, "1 DAY").groupBy("user_id").agg(F.max("session_id").alias("sessions"))


@query(
    "win_11_viewed_before_purchase",
    with_(
        "sessions",
        """SELECT user_id, session_id, product_id, views FROM (SELECT user_id, session_id, product_id, count(*) AS views,
        row_number() OVER (PARTITION BY user_id, session_id ORDER BY count(*) DESC, product_id) AS rn FROM sessions
        JOIN (SELECT user_id, session_id, min(ts) AS bought FROM sessions WHERE event_type = 'purchase' GROUP BY 1, 2) USING (user_id, session_id)
        WHERE event_type = 'view' AND ts < bought GROUP BY 1, 2, 3) WHERE rn = 1""",
    ),
)
def viewed_before_purchase(t: Tables) -> DataFrame:
    """The most viewed product before the first purchase of each session."""
    events = sessions(t).select("user_id", "session_id", "event_type", "product_id", "ts")
    bought = events.filter(F.col("event_type") == "purchase").groupBy("user_id", "session_id").agg(F.min("ts").alias("bought"))
    views = events.filter(F.col("event_type") == "view").join(bought, ["user_id", "session_id"]).filter(F.col("ts") < F.col("bought"))
    counted = views.groupBy("user_id", "session_id", "product_id").agg(F.count("*").alias("views"))
    best = F.max(F.struct("views", (-F.col("product_id")).alias("minus_id")))
    return counted.groupBy("user_id", "session_id").agg(best.alias("b")).select("user_id", "session_id", (-F.col("b.minus_id")).alias("product_id"), "b.views")


@query(
    "win_12_days_since_previous",
    with_(
        "shop_orders",
        """SELECT order_id, customer_id, CAST(date_diff('day', lag(created_at) OVER (PARTITION BY customer_id ORDER BY created_at, order_id), created_at) AS INTEGER) AS days
        FROM shop_orders""",
    ),
)
def days_since_previous(t: Tables) -> DataFrame:
    orders = t.shop_orders.select("order_id", "customer_id", "created_at")
    scanned = ordered_scan(orders, ["customer_id"], ["created_at", "order_id"], lags={"previous": "created_at"})
    return scanned.select("order_id", "customer_id", F.date_diff("created_at", "previous").alias("days"))


@query(
    "win_13_newest_version",
    with_("events_raw", "SELECT event_id, user_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC) AS rn FROM events_raw) WHERE rn = 1"),
)
def newest_version(t: Tables) -> DataFrame:
    """row_number = 1 plans as a per-task group limit before the shuffle."""
    newest = Window.partitionBy("event_id").orderBy(F.desc("ts"))
    ranked = t.events_raw.withColumn("rn", F.row_number().over(newest)).filter(F.col("rn") == 1)
    return ranked.select("event_id", "user_id", "event_type", "ts")


@query(
    "win_14_lead",
    with_("clicks", "SELECT event_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM clicks"),
)
def lead(t: Tables) -> DataFrame:
    scanned = ordered_scan(t.clicks, ["user_id"], ["ts", "event_id"], leads={"next_type": "event_type"})
    return scanned.select("event_id", "next_type")


@query(
    "win_15_counter_increase",
    """SELECT user_id, CAST(sum(CASE WHEN value >= prev THEN value - prev ELSE value END) AS DOUBLE) AS increase FROM (SELECT user_id, CAST(value AS DECIMAL(12,2)) AS value,
    coalesce(lag(CAST(value AS DECIMAL(12,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id), 0) AS prev FROM events) GROUP BY 1""",
)
def counter_increase(t: Tables) -> DataFrame:
    """Growth of a counter that may restart: a drop counts the new value whole."""
    samples = t.events.select("user_id", "ts", "event_id", F.col("value").cast(MONEY).alias("value"))
    scanned = ordered_scan(samples, ["user_id"], ["ts", "event_id"], lags={"previous": "value"})
    before = F.coalesce("previous", F.lit(0).cast(MONEY))
    grown = F.when(F.col("value") >= before, F.col("value") - before).otherwise(F.col("value"))
    return scanned.groupBy("user_id").agg(F.sum(grown).cast("double").alias("increase"))


@query(
    "win_16_global_share",
    with_("monthly", "SELECT month, CAST(revenue AS DOUBLE) / CAST(sum(revenue) OVER () AS DOUBLE) AS share FROM monthly"),
)
def global_share(t: Tables) -> DataFrame:
    """A window without a key, used after aggregation only."""
    return monthly(t).select("month", (F.col("revenue").cast("double") / F.sum("revenue").over(Window.partitionBy()).cast("double")).alias("share"))
