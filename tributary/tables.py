"""The given tables and the online-shop shaped views over them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

MONEY = "decimal(12,2)"
ORDER_STATUS = ["O", "P", "F"]  # declaration order of the status enum
DEVICES = ["mobile", "desktop", "tablet"]
FUNNEL = ["view", "click", "signup", "purchase"]

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has far fewer splits than the cluster has cores, ahead
    of heavy work per row. A large table has splits enough and is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() * 4 <= cores else df


class Tables:
    """Lazy readers; each attribute is a DataFrame over one table or view."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(self.path(name))
        raise AttributeError(name)

    @cached_property
    def part_count(self) -> int:
        return self.part.count()  # answered from parquet footers

    @property
    def shop_customers(self) -> DataFrame:
        key = F.col("c_custkey")
        nations = self.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return self.customer.join(nations, "c_nationkey").select(
            key.alias("customer_id"),
            F.when(key % 20 != 0, F.col("n_name")).alias("city"),
            F.when(key % 5 == 3, "silver").when(key % 5 == 4, "gold").otherwise("free").alias("tier"),
            F.when(key % 97 == 0, F.concat(F.lit("bad"), key))
            .otherwise(F.concat(F.lit("user"), key, F.lit("@example.com")))
            .alias("email"),
            F.col("c_acctbal").alias("balance"),
            F.col("c_mktsegment").alias("segment"),
        )

    @property
    def shop_products(self) -> DataFrame:
        months = (F.col("p_partkey") % 4 * 12).cast("int")
        return self.part.select(
            F.col("p_partkey").alias("product_id"),
            F.col("p_name").alias("name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").cast(MONEY).alias("price"),
            F.to_json(
                F.struct(
                    F.col("p_brand").alias("brand"),
                    F.col("p_size").alias("size"),
                    months.alias("warranty_months"),
                )
            ).alias("attrs"),
            F.split("p_name", " ").alias("tags"),
        )

    @property
    def shop_orders(self) -> DataFrame:
        return self.orders.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").cast(MONEY).alias("total"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderpriority").alias("priority"),
        )

    @property
    def shop_items(self) -> DataFrame:
        qty = F.col("l_quantity").cast("int")
        line_total = F.col("l_extendedprice").cast(MONEY)
        return self.lineitem.select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            qty.alias("qty"),
            line_total.alias("line_total"),
            F.col("l_discount").cast("decimal(4,2)").alias("discount"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_shipdate").alias("shipped_at"),
        )

    @property
    def categories(self) -> DataFrame:
        """Three-level tree: world, regions, nations."""
        root = self.region.select(
            F.lit(0).alias("id"), F.lit(None).cast("int").alias("parent_id"), F.lit("world").alias("name")
        ).distinct()
        regions = self.region.select((F.col("r_regionkey") + 1).alias("id"), F.lit(0).alias("parent_id"), F.col("r_name").alias("name"))
        nations = self.nation.select(
            (F.col("n_nationkey") + 100).alias("id"), (F.col("n_regionkey") + 1).alias("parent_id"), F.col("n_name").alias("name")
        )
        return root.unionByName(regions).unionByName(nations)

    @property
    def clicks(self) -> DataFrame:
        return self.events.select(
            "event_id",
            "ts",
            "user_id",
            "event_type",
            F.element_at(F.array(*map(F.lit, DEVICES)), (F.col("event_id") % 3 + 1).cast("int")).alias("device"),
            (F.col("event_id") % self.part_count).alias("product_id"),
        )

    @property
    def events_raw(self) -> DataFrame:
        """Dirty copy of the events: repeated ids, missing users, time as text."""
        copies = F.when(F.col("event_id") % 100 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return (
            self.clicks.withColumn("copy_no", F.explode(copies))
            .withColumn("ts", F.col("ts") + F.make_dt_interval(secs=F.col("copy_no")))
            .select(
                "event_id",
                F.when(F.col("event_id") % 33 != 0, F.col("user_id")).alias("user_id"),
                "event_type",
                "product_id",
                "device",
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
            )
        )

    @property
    def promotions(self) -> DataFrame:
        """Two half-open 30-day periods per product; some overlap, some touch."""
        key = F.col("p_partkey")
        first = F.date_add(F.lit("2000-01-01").cast("date"), (key % 100).cast("int"))
        second = F.date_add(first, (10 + key % 40).cast("int"))
        periods = F.array(
            F.struct(F.lit("A").alias("promo"), first.alias("valid_from"), F.date_add(first, 30).alias("valid_to")),
            F.struct(F.lit("B").alias("promo"), second.alias("valid_from"), F.date_add(second, 30).alias("valid_to")),
        )
        return self.part.select(key.alias("product_id"), F.explode(periods).alias("p")).select("product_id", "p.*")

    @property
    def search_docs(self) -> DataFrame:
        """Title is the first line of the text, body the whole text."""
        return spread(self.documents).select(
            "doc_id", "lang", "source", F.split("text", "\n").getItem(0).alias("title"), F.col("text").alias("body")
        )
