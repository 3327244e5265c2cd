"""Scalar, array, map and JSON function families; user-defined functions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions import scalars
from tributary.plans.registry import query
from tributary.plans.sql import cte, with_
from tributary.tables import Tables

cte(
    "attrs",
    """SELECT product_id, attrs, attrs ->> '$.brand' AS brand, CAST(attrs ->> '$.size' AS INTEGER) AS size,
    CAST(attrs ->> '$.warranty_months' AS INTEGER) AS months FROM shop_products""",
    "shop_products",
)


@query(
    "str_01_strings",
    """SELECT c_custkey AS id, lower(c_name) AS lowered, regexp_extract(c_name, '#0*([0-9]+)$', 1) AS number, string_split(c_name, '#')[1] AS word,
    concat(c_mktsegment, '/', c_nationkey) AS joined, concat_ws('-', c_mktsegment, NULL, c_name) AS joined_ws FROM customer""",
)
def strings(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.lower("c_name").alias("lowered"),
        F.regexp_extract("c_name", "#0*([0-9]+)$", 1).alias("number"),
        F.split("c_name", "#").getItem(0).alias("word"),
        F.concat("c_mktsegment", F.lit("/"), "c_nationkey").alias("joined"),
        F.concat_ws("-", "c_mktsegment", F.lit(None).cast("string"), "c_name").alias("joined_ws"),
    )


UNIT_SQL = "CASE p_partkey % 10 " + " ".join(f"WHEN {i} THEN '{u}'" for i, u in enumerate(["", *scalars.SIZE_UNITS])) + " ELSE 'parsec' END"
FACTOR_SQL = "CASE p_partkey % 10 " + " ".join(f"WHEN {i} THEN {f}" for i, f in enumerate([0, *scalars.SIZE_UNITS.values()])) + " ELSE 0 END"


@query(
    "str_02_size_text",
    f"SELECT p_partkey AS id, p_size || '.5 ' || {UNIT_SQL} AS text, (p_size + 0.5::DOUBLE) * CAST({FACTOR_SQL} AS DOUBLE) AS bytes FROM part",
)
def size_text(t: Tables) -> DataFrame:
    """Sizes like "7.5 MiB"; a missing or unknown unit gives 0."""
    units = F.array(*map(F.lit, ["", *scalars.SIZE_UNITS, "parsec"]))
    unit = F.element_at(units, (F.col("p_partkey") % 10 + 1).cast("int"))
    text = F.concat("p_size", F.lit(".5 "), unit)
    return t.part.select(F.col("p_partkey").alias("id"), text.alias("text"), scalars.size_in_bytes(text).alias("bytes"))


@query(
    "str_03_base64",
    """SELECT doc_id, CAST(length(b) AS BIGINT) AS encoded, CAST(octet_length(encode(text)) AS BIGINT) AS decoded, CAST(length(b) // 4 * 3 AS BIGINT) AS estimated
    FROM (SELECT doc_id, text, to_base64(encode(text)) AS b FROM documents)""",
)
def base64_lengths(t: Tables) -> DataFrame:
    encoded = F.regexp_replace(F.base64(F.encode("text", "UTF-8")), "\\s", "")
    rows = t.documents.select("doc_id", encoded.alias("b"))
    return rows.select(
        "doc_id",
        F.length("b").cast("bigint").alias("encoded"),
        F.length(F.unbase64("b")).cast("bigint").alias("decoded"),
        scalars.base64_length(F.col("b")).alias("estimated"),
    )


@query(
    "dat_01_dates",
    with_(
        "events_raw",
        """SELECT event_id, ts, date_trunc('month', CAST(ts AS TIMESTAMP)) AS month, CAST(dayofweek(CAST(ts AS TIMESTAMP)) + 1 AS INTEGER) AS weekday,
        strftime(CAST(ts AS TIMESTAMP), '%d/%m/%Y') AS label, strftime(CAST(ts AS DATE) + INTERVAL 30 DAY, '%Y-%m-%d') AS due,
        CAST(ts AS TIMESTAMP) - INTERVAL 90 MINUTE AS earlier, CAST(NULL AS TIMESTAMP) AS dirty FROM events_raw""",
    ),
)
def dates(t: Tables) -> DataFrame:
    ts = F.to_timestamp("ts", "yyyy-MM-dd'T'HH:mm:ss").cast("timestamp_ntz")
    return t.events_raw.withColumn("at", ts).select(
        "event_id",
        "ts",
        F.date_trunc("month", "at").cast("timestamp_ntz").alias("month"),
        F.dayofweek("at").alias("weekday"),
        F.date_format("at", "dd/MM/yyyy").alias("label"),
        F.date_add(F.to_date("at"), 30).cast("string").alias("due"),
        (F.col("at") - F.expr("INTERVAL '90' MINUTE")).alias("earlier"),
        F.try_to_timestamp(F.concat(F.lit("x"), "ts")).cast("timestamp_ntz").alias("dirty"),
    )


@query("dat_02_time_zone", "SELECT event_id, ts + INTERVAL 7 HOUR AS in_hanoi FROM events")
def time_zone(t: Tables) -> DataFrame:
    local = F.from_utc_timestamp(F.col("ts").cast("timestamp"), "Asia/Ho_Chi_Minh")
    return t.events.select("event_id", local.cast("timestamp_ntz").alias("in_hanoi"))


@query(
    "dat_03_epoch",
    "SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS seconds, date_trunc('second', ts) AS from_seconds, date_trunc('millisecond', ts) AS from_millis FROM events",
)
def epoch(t: Tables) -> DataFrame:
    at = F.col("ts").cast("timestamp")
    return t.events.select(
        "event_id",
        F.unix_seconds(at).alias("seconds"),
        F.timestamp_seconds(F.unix_seconds(at)).cast("timestamp_ntz").alias("from_seconds"),
        F.timestamp_millis(F.unix_millis(at)).cast("timestamp_ntz").alias("from_millis"),
    )


@query(
    "mth_01_math",
    """SELECT o_orderkey AS id, CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands, pow(o_orderkey % 100, 2) AS squared,
    abs(o_orderkey - o_custkey) AS distance, o_orderkey % 7 AS remainder, ((o_orderkey - 5000) % 16 + 16) % 16 AS bucket FROM orders""",
)
def math(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        key.alias("id"),
        F.floor(F.col("o_totalprice") / 1000).alias("thousands"),
        F.pow(key % 100, F.lit(2)).alias("squared"),
        F.abs(key - F.col("o_custkey")).alias("distance"),
        (key % 7).alias("remainder"),
        F.pmod(key - 5000, F.lit(16)).alias("bucket"),
    )


@query("mth_01_hash_buckets", "SELECT count(*) AS n, CAST(16 AS BIGINT) AS buckets, true AS in_range, true AS even FROM orders")
def hash_buckets(t: Tables) -> DataFrame:
    """No bucket holds twice its share."""
    counts = t.orders.groupBy(scalars.hash_bucket(F.col("o_orderkey"), buckets=16).alias("bucket")).agg(F.count("*").alias("n"))
    return counts.agg(
        F.sum("n").alias("n"),
        F.count("*").alias("buckets"),
        F.every(F.col("bucket").between(0, 15)).alias("in_range"),
        (F.max("n") * 16 < 2 * F.sum("n")).alias("even"),
    )


@query(
    "arr_01_arrays",
    with_(
        "shop_products",
        """SELECT product_id, CAST(len(tags) AS INTEGER) AS n, list_contains(tags, 'red') AS red, tags[1] AS first, tags[-1] AS last,
        CAST(len(range(1, product_id % 5 + 1)) AS INTEGER) AS steps FROM shop_products""",
    ),
)
def arrays(t: Tables) -> DataFrame:
    steps = F.when(F.col("product_id") % 5 > 0, F.sequence(F.lit(1), F.col("product_id") % 5)).otherwise(F.array().cast("array<bigint>"))
    return t.shop_products.select(
        "product_id",
        F.size("tags").alias("n"),
        F.array_contains("tags", "red").alias("red"),
        F.element_at("tags", 1).alias("first"),
        F.element_at("tags", -1).alias("last"),
        F.size(steps).alias("steps"),
    )


TAGGED = "SELECT product_id, CASE WHEN product_id % 3 > 0 THEN tags END AS tags FROM shop_products"


@query("arr_01_explode", with_("shop_products", f"SELECT product_id, unnest(tags) AS tag FROM ({TAGGED})"))
def explode(t: Tables) -> DataFrame:
    """Drops rows whose array is NULL or empty."""
    tags = F.when(F.col("product_id") % 3 > 0, F.col("tags"))
    return t.shop_products.select("product_id", F.explode(tags).alias("tag"))


@query("arr_01_explode_outer", with_("shop_products", f"SELECT product_id, tag FROM ({TAGGED}) LEFT JOIN LATERAL (SELECT unnest(tags) AS tag) ON true"))
def explode_outer(t: Tables) -> DataFrame:
    """Keeps them with a NULL element."""
    tags = F.when(F.col("product_id") % 3 > 0, F.col("tags"))
    return t.shop_products.select("product_id", F.explode_outer(tags).alias("tag"))


@query(
    "arr_02_higher_order",
    with_(
        "shop_products",
        """SELECT product_id, array_to_string(list_transform(tags, lambda x: upper(x)), ',') AS upper, array_to_string(list_filter(tags, lambda x: length(x) > 4), ',') AS long,
        CAST(list_sum(list_transform(tags, lambda x: length(x))) AS INTEGER) AS letters, len(list_filter(tags, lambda x: x LIKE 's%')) > 0 AS any_s FROM shop_products""",
    ),
)
def higher_order(t: Tables) -> DataFrame:
    return t.shop_products.select(
        "product_id",
        F.array_join(F.transform("tags", lambda x: F.upper(x)), ",").alias("upper"),
        F.array_join(F.filter("tags", lambda x: F.length(x) > 4), ",").alias("long"),
        F.aggregate("tags", F.lit(0), lambda acc, x: acc + F.length(x)).alias("letters"),
        F.exists("tags", lambda x: x.startswith("s")).alias("any_s"),
    )


@query(
    "arr_02_higher_order_sql",
    with_("shop_products", "SELECT product_id, array_to_string(list_transform(tags, lambda x: x || '!'), ',') AS loud FROM shop_products"),
)
def higher_order_sql(t: Tables) -> DataFrame:
    return t.shop_products.selectExpr("product_id", "array_join(transform(tags, x -> x || '!'), ',') AS loud")


@query(
    "map_01_entries",
    with_(
        "attrs",
        """SELECT product_id, 'brand' AS key, brand AS value FROM attrs UNION ALL SELECT product_id, 'size', CAST(size AS VARCHAR) FROM attrs
        UNION ALL SELECT product_id, 'warranty_months', CAST(months AS VARCHAR) FROM attrs""",
    ),
)
def entries(t: Tables) -> DataFrame:
    """Object → key/value rows."""
    return t.shop_products.select("product_id", F.explode(scalars.json_map(F.col("attrs"))))


@query(
    "map_01_build_and_access",
    "SELECT p_partkey AS id, p_brand AS brand, p_size AS size, p_brand || '/' || p_type AS label, CAST(NULL AS VARCHAR) AS missing FROM part",
)
def build_and_access(t: Tables) -> DataFrame:
    pair = lambda key, value: F.struct(F.lit(key).alias("key"), F.col(value).alias("value"))
    pairs = F.array(pair("brand", "p_brand"), pair("type", "p_type"))
    built = t.part.select(F.col("p_partkey").alias("id"), F.map_from_entries(pairs).alias("m"), F.struct(F.col("p_size").alias("size")).alias("s"))
    return built.select(
        "id",
        F.col("m")["brand"].alias("brand"),
        F.col("s.size").alias("size"),
        F.concat_ws("/", F.map_values("m")).alias("label"),
        F.try_element_at("m", F.lit("color")).alias("missing"),
    )


@query("map_01_variant_rows", with_("attrs", "SELECT product_id, CAST(3 AS BIGINT) AS fields, size FROM attrs"))
def variant_rows(t: Tables) -> DataFrame:
    """A variant value opened to rows, one per field."""
    rows = t.spark.sql(
        "SELECT product_id, v.key, v.value FROM {p}, LATERAL variant_explode(parse_json(attrs)) AS v(pos, key, value)", p=t.shop_products
    )
    return rows.groupBy("product_id").agg(
        F.count("*").alias("fields"), F.max(F.when(F.col("key") == "size", F.expr("variant_get(value, '$', 'int')"))).alias("size")
    )


@query(
    "jsn_01_access",
    with_("attrs", "SELECT product_id, '\"' || brand || '\"' AS as_json, brand AS as_text, size + 1 AS next_size, months FROM attrs"),
)
def json_access(t: Tables) -> DataFrame:
    v = F.parse_json("attrs")
    return t.shop_products.select(
        "product_id",
        F.to_json(F.variant_get(v, "$.brand", "variant")).alias("as_json"),
        F.get_json_object("attrs", "$.brand").alias("as_text"),
        (F.get_json_object("attrs", "$.size").cast("int") + 1).alias("next_size"),
        F.variant_get(v, "$.warranty_months", "int").alias("months"),
    )


@query(
    "jsn_02_predicates",
    with_(
        "attrs",
        """SELECT product_id, brand = 'Brand#2' AND size = 11 AS contains, true AS has_size, false AS has_color, months >= 24 AS long_warranty FROM attrs""",
    ),
)
def json_predicates(t: Tables) -> DataFrame:
    fields = scalars.json_map(F.col("attrs"))
    keys = F.json_object_keys("attrs")
    return t.shop_products.withColumn("f", fields).select(
        "product_id",
        ((F.col("f")["brand"] == "Brand#2") & (F.col("f")["size"] == "11")).alias("contains"),
        F.array_contains(keys, "size").alias("has_size"),
        F.array_contains(keys, "color").alias("has_color"),
        (F.variant_get(F.parse_json("attrs"), "$.warranty_months", "int") >= 24).alias("long_warranty"),
    )


@query(
    "jsn_03_edit",
    with_(
        "attrs",
        """SELECT product_id, '{"brand":"' || brand || '","size":"99","warranty_months":"' || months || '"}' AS set_field,
        '{"brand":"' || brand || '","size":"' || size || '","warranty_months":"' || months || '","color":"red"}' AS merged,
        '{"brand":"' || brand || '","warranty_months":"' || months || '"}' AS without_size FROM attrs""",
    ),
)
def json_edit(t: Tables) -> DataFrame:
    fields = scalars.json_map(F.col("attrs"))
    replaced = F.transform_values(fields, lambda k, v: F.when(k == "size", "99").otherwise(v))
    merged = F.map_concat(fields, F.create_map(F.lit("color"), F.lit("red")))
    return t.shop_products.select(
        "product_id",
        F.to_json(replaced).alias("set_field"),
        F.to_json(merged).alias("merged"),
        F.to_json(F.map_filter(fields, lambda k, v: k != "size")).alias("without_size"),
    )


@query(
    "jsn_04_build",
    """SELECT c_custkey AS id, '{"id":' || c_custkey || ',"name":"' || c_name || '","place":{"nation":' || c_nationkey || '}}' AS doc FROM customer""",
)
def json_build(t: Tables) -> DataFrame:
    place = F.struct(F.col("c_nationkey").alias("nation"))
    doc = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), place.alias("place")))
    return t.customer.select(F.col("c_custkey").alias("id"), doc.alias("doc"))


# --- user-defined functions --------------------------------------------------------------------

SIZED = with_(
    "shop_orders", "SELECT order_id, CASE WHEN total < 50000 THEN 'small' WHEN total < 200000 THEN 'medium' ELSE 'large' END AS size FROM shop_orders"
)


def size_name(total: float | None) -> str | None:
    if total is None:
        return None
    return "small" if total < 50000 else "medium" if total < 200000 else "large"


def size_builtin(total: Column) -> Column:
    return F.when(total < 50000, "small").when(total < 200000, "medium").when(total.isNotNull(), "large")


@query("udf_01_python_udf", f"SELECT order_id, size, size AS builtin FROM ({SIZED})")
def python_udf(t: Tables) -> DataFrame:
    """The row-at-a-time UDF next to the built-in expression, which is the one to use."""
    total = F.col("total").cast("double")
    return t.shop_orders.select("order_id", F.udf(size_name, "string")(total).alias("size"), size_builtin(total).alias("builtin"))


@query("udf_02_registered_for_sql", SIZED)
def registered_for_sql(t: Tables) -> DataFrame:
    t.spark.udf.register("size_name", size_name, "string")
    return t.spark.sql("SELECT order_id, size_name(CAST(total AS DOUBLE)) AS size FROM {o}", o=t.shop_orders)


@query("udf_03_arrow_udf", SIZED)
def arrow_udf(t: Tables) -> DataFrame:
    @F.pandas_udf("string")
    def size_batch(total: pd.Series) -> pd.Series:
        return pd.cut(total, [float("-inf"), 50000, 200000, float("inf")], right=False, labels=["small", "medium", "large"]).astype(str)

    return t.shop_orders.select("order_id", size_batch(F.col("total").cast("double")).alias("size"))


@query(
    "udf_04_sql_scalar_function",
    with_(
        "shop_customers shop_orders",
        """SELECT customer_id, tier, CAST(coalesce(spent, 0) AS DOUBLE) AS ltv FROM shop_customers LEFT JOIN (SELECT customer_id, sum(total) AS spent
        FROM shop_orders WHERE status <> 'P' GROUP BY 1) USING (customer_id)""",
    ),
)
def sql_scalar_function(t: Tables) -> DataFrame:
    """Lifetime value as a SQL function; Catalyst turns its subquery into a join."""
    t.shop_orders.createOrReplaceTempView("ltv_orders")
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION customer_ltv(id BIGINT) RETURNS DOUBLE
        RETURN SELECT CAST(coalesce(sum(total), 0) AS DOUBLE) FROM ltv_orders WHERE customer_id = id AND status <> 'P'"""
    )
    return t.spark.sql("SELECT customer_id, tier, customer_ltv(customer_id) AS ltv FROM {c}", c=t.shop_customers)


@query(
    "udf_05_sql_table_function",
    with_(
        "shop_items",
        """SELECT product_id, CAST(sum(line_total) AS DOUBLE) AS revenue FROM shop_items GROUP BY 1
        ORDER BY sum(shop_items.line_total) DESC, product_id LIMIT 5""",
    ),
)
def sql_table_function(t: Tables) -> DataFrame:
    """Top products as a table function with a default argument."""
    t.shop_items.createOrReplaceTempView("top_items")
    t.spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION top_products(n INT DEFAULT 5) RETURNS TABLE (product_id BIGINT, revenue DOUBLE)
        RETURN SELECT product_id, CAST(revenue AS DOUBLE) FROM (SELECT product_id, sum(line_total) AS revenue,
        row_number() OVER (ORDER BY sum(line_total) DESC, product_id) AS place FROM top_items GROUP BY product_id) WHERE place <= n"""
    )
    return t.spark.sql("SELECT * FROM top_products()")


@query(
    "udf_07_sql_on_views",
    with_(
        "shop_orders shop_customers",
        """SELECT tier, count(*) AS orders, CAST(sum(total) AS DOUBLE) / count(*) AS average FROM shop_orders JOIN shop_customers USING (customer_id) GROUP BY 1""",
    ),
)
def sql_on_views(t: Tables) -> DataFrame:
    """The same plan as the DataFrame form, written as SQL over temp views."""
    t.shop_orders.createOrReplaceTempView("sql_orders")
    t.shop_customers.createOrReplaceTempView("sql_customers")
    return t.spark.sql(
        """WITH tiered AS (SELECT tier, total FROM sql_orders JOIN sql_customers USING (customer_id))
        SELECT tier, count(*) AS orders, CAST(sum(total) AS DOUBLE) / count(*) AS average FROM tiered GROUP BY tier"""
    )


def by_dataframe(t: Tables) -> DataFrame:
    """DataFrame twin of ``sql_on_views``."""
    tiered = t.shop_orders.join(t.shop_customers, "customer_id").select("tier", "total")
    return tiered.groupBy("tier").agg(F.count("*").alias("orders"), (F.sum("total").cast("double") / F.count("*")).alias("average"))
