"""Bronze → silver → gate → gold, with a one-day reload."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.operators import quality
from tributary.sources import scans, sinks
from tributary.tables import FUNNEL

EVENT_TYPES = [*FUNNEL, "error"]
BRONZE_SCHEMA = scans.EVENTS_RAW + ", _ingested_at TIMESTAMP, _source_file STRING, ingest_date DATE"
SILVER_SCHEMA = "event_id BIGINT, user_id BIGINT, event_type STRING, product_id BIGINT, device STRING, event_ts TIMESTAMP_NTZ, event_date DATE"


def to_bronze(spark: SparkSession, source: str, target: str) -> None:
    """Raw JSON as it came, with when and from which file."""
    raw = spark.read.schema(scans.EVENTS_RAW).json(source)
    stamped = raw.select(
        "*", F.current_timestamp().alias("_ingested_at"), F.col("_metadata.file_path").alias("_source_file"), F.current_date().alias("ingest_date")
    )
    stamped.write.mode("append").partitionBy("ingest_date").parquet(target)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE_SCHEMA).parquet(path)


def silver_rows(bronze: DataFrame) -> DataFrame:
    """Clean events; of several copies the one ingested last survives."""
    return quality.clean_events(bronze).withColumn("event_date", F.to_date("event_ts"))


def to_silver(spark: SparkSession, source: str, target: str) -> None:
    sinks.write_partitioned(silver_rows(read_bronze(spark, source)), target, "event_date")


def reload_day(spark: SparkSession, source: str, target: str, day: str) -> None:
    """Rebuild one day of silver from bronze, to nothing where no event is left; the other
    days are not touched.

    Bronze folders from the day before on are read: no copy is ingested more than a day before
    its own time, and a copy ingested earlier is older than every copy of the day. Only events
    with a copy on that day are cleaned, but with all their later copies: the newest one may
    lie on another day, which then keeps the event.
    """
    wanted = F.lit(day).cast("date")
    events = read_bronze(spark, source).filter(F.col("ingest_date") >= F.date_sub(wanted, 1))
    ids = events.filter(F.to_date(quality.parse_time(F.col("ts"))) == wanted).select("event_id").distinct()
    rows = silver_rows(events.join(ids, "event_id", "left_semi")).filter(F.col("event_date") == wanted)
    sinks.replace_partitions(rows, target, "event_date", [day])


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SILVER_SCHEMA).parquet(path)


def gate(silver: DataFrame, start: str, end: str) -> DataFrame:
    return quality.event_gate(silver, EVENT_TYPES, start, end)


def rate(part: str, whole: str) -> Column:
    return F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0))


def daily_funnel(silver: DataFrame, products: DataFrame) -> DataFrame:
    """Day × category × device: the funnel counts and the share of views that end in a purchase.

    Events collapse per day, product and device before the category is looked up.
    """
    steps = {"views": "view", "clicks": "click", "carts": "signup", "purchases": "purchase"}
    per_product = silver.groupBy("event_date", "product_id", "device").agg(
        *[F.count_if(F.col("event_type") == e).alias(name) for name, e in steps.items()]
    )
    named = per_product.join(products.select("product_id", "category"), "product_id")
    return (
        named.groupBy("event_date", "category", "device")
        .agg(*[F.sum(name).alias(name) for name in steps])
        .withColumn("buy_rate", rate("purchases", "views"))
    )


def daily_revenue(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Day × category: revenue and orders."""
    lines = items.select("order_id", "product_id", "line_total").join(products.select("product_id", "category"), "product_id")
    per_order = lines.groupBy("order_id", "category").agg(F.sum("line_total").alias("revenue"))
    dated = per_order.join(orders.select("order_id", F.to_date("created_at").alias("day")), "order_id")
    return dated.groupBy("day", "category").agg(F.sum("revenue").alias("revenue"), F.count("*").alias("orders"))


def viewed_not_bought(funnel: DataFrame, min_views: int, max_rate: float) -> DataFrame:
    """Category and device pairs that are looked at often and bought rarely."""
    total = funnel.groupBy("category", "device").agg(F.sum("views").alias("views"), F.sum("purchases").alias("purchases"))
    rated = total.withColumn("buy_rate", rate("purchases", "views"))
    return rated.filter((F.col("views") >= min_views) & (F.col("buy_rate") < max_rate))


def revenue_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Day × country, orders collapsed per day and customer first."""
    spent = orders.groupBy("customer_id", F.to_date("created_at").alias("day")).agg(F.sum("total").alias("revenue"), F.count("*").alias("orders"))
    return spent.join(customers, "customer_id").groupBy("day", "country").agg(F.sum("revenue").alias("revenue"), F.sum("orders").alias("orders"))
