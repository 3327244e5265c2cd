"""Sources, sinks and generated tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, functions as F

from tributary.operators import generate
from tributary.operators.segments import union_all
from tributary.plans.registry import query
from tributary.plans.sql import cte, with_
from tributary.sources import scans, sinks
from tributary.storage import run_path
from tributary.tables import Tables

# --- sources -----------------------------------------------------------------------------------


@query(
    "src_01_columnar_scan",
    "SELECT l_orderkey, l_extendedprice FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' AND l_returnflag = 'R'",
)
def columnar_scan(t: Tables) -> DataFrame:
    recent = F.col("l_shipdate") >= F.lit("1999-01-01").cast("timestamp_ntz")
    return t.lineitem.filter(recent & (F.col("l_returnflag") == "R")).select("l_orderkey", "l_extendedprice")


@query("src_02_json_lines", with_("events_raw", "SELECT * FROM events_raw"))
def json_lines(t: Tables) -> DataFrame:
    path = run_path(t.spark, "events-json")
    t.events_raw.write.json(path)
    return t.spark.read.schema(scans.EVENTS_RAW).json(path)


BROKEN = "event_id % 50 = 7"


@query(
    "src_03_corrupt_rows",
    with_(
        "events_raw",
        f"""SELECT 'PERMISSIVE' AS mode, count(*) AS n, count(*) FILTER (WHERE {BROKEN}) AS corrupt FROM events_raw
        UNION ALL SELECT 'DROPMALFORMED', count(*) FILTER (WHERE NOT ({BROKEN})), 0 FROM events_raw UNION ALL SELECT 'FAILFAST', 0, 1""",
    ),
)
def corrupt_rows(t: Tables) -> DataFrame:
    """Some lines are cut in half; each mode treats them in its own way."""
    path = run_path(t.spark, "broken-json")
    line = F.to_json(F.struct(*[F.col(c) for c in t.events_raw.columns]))
    cut = F.when(F.expr(BROKEN), F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int"))).otherwise(line)
    t.events_raw.select(cut.alias("value")).write.text(path)
    permissive = scans.read_json(t.spark, path, scans.EVENTS_RAW)
    kept = permissive.agg(
        F.lit("PERMISSIVE").alias("mode"), F.count(F.coalesce(F.col("event_id").cast("string"), F.col("_corrupt_record"))).alias("n"), F.count("_corrupt_record").alias("corrupt")
    )
    dropped = scans.read_json(t.spark, path, scans.EVENTS_RAW, "DROPMALFORMED")
    dropped = dropped.agg(F.lit("DROPMALFORMED").alias("mode"), F.count("event_id").alias("n"), F.lit(0).cast("bigint").alias("corrupt"))
    try:
        scans.read_json(t.spark, path, scans.EVENTS_RAW, "FAILFAST").agg(F.max("event_id")).collect()
        failed = 0
    except (PySparkException, Py4JJavaError) as error:
        if not any(x in str(error) for x in ("FAILED_READ_FILE", "MALFORMED_RECORD_IN_PARSING")):
            raise
        failed = 1
    stopped = t.events.agg(F.lit("FAILFAST").alias("mode"), F.lit(0).cast("bigint").alias("n"), F.lit(failed).cast("bigint").alias("corrupt"))
    return union_all([kept, dropped, stopped])


FORMATS = ["csv", "json", "orc", "parquet"]


@query(
    "src_04_formats",
    with_("shop_orders", " UNION ALL ".join(f"SELECT '{f}' AS format, count(*) AS n, CAST(sum(total) AS DOUBLE) AS total, count(DISTINCT status) AS statuses FROM shop_orders" for f in FORMATS)),
)
def formats(t: Tables) -> DataFrame:
    """The same table through four formats reads back the same."""
    rows = t.shop_orders.select("order_id", "status", "total")
    results = []
    for fmt in FORMATS:
        path = run_path(t.spark, f"orders-{fmt}")
        sinks.write(rows, path, fmt)
        reader = t.spark.read.schema("order_id BIGINT, status STRING, total DECIMAL(12,2)").format(fmt)
        stored = (reader.option("header", True) if fmt == "csv" else reader).load(path)
        results.append(
            stored.agg(
                F.lit(fmt).alias("format"), F.count("*").alias("n"), F.sum("total").cast("double").alias("total"), F.count_distinct("status").alias("statuses")
            )
        )
    return union_all(results)


def orders_by_month(t: Tables) -> str:
    path = run_path(t.spark, "orders-by-month")
    rows = t.shop_orders.withColumn("order_month", F.date_format("created_at", "yyyy-MM"))
    sinks.write_partitioned(rows, path, "order_month")
    return path


@query(
    "src_05_partition_discovery",
    with_("shop_orders", "SELECT order_id, strftime(created_at, '%Y-%m') AS order_month FROM shop_orders WHERE strftime(created_at, '%Y-%m') = '1998-03' AND status = 'F'"),
)
def partition_discovery(t: Tables) -> DataFrame:
    """The directory name becomes a column; a filter on it reads one directory."""
    stored = t.spark.read.parquet(orders_by_month(t))
    march = stored.filter((F.col("order_month") == "1998-03") & (F.col("status") == "F"))
    return march.select("order_id", F.col("order_month").cast("string").alias("order_month"))


@query("src_06_merged_schema", with_("shop_orders", "SELECT order_id, status, CASE WHEN created_at >= TIMESTAMP '1999-01-01' THEN priority END AS priority FROM shop_orders"))
def merged_schema(t: Tables) -> DataFrame:
    path = run_path(t.spark, "growing")
    old = F.col("created_at") < F.lit("1999-01-01").cast("timestamp_ntz")
    t.shop_orders.filter(old).select("order_id", "status").write.parquet(f"{path}/batch=1")
    t.shop_orders.filter(~old).select("order_id", "status", "priority").write.parquet(f"{path}/batch=2")
    return scans.read_merged(t.spark, path).select("order_id", "status", "priority")


@query(
    "src_10_inline_rows",
    with_(
        "shop_orders",
        "SELECT label, count(*) AS n FROM shop_orders JOIN (VALUES ('O', 'open'), ('P', 'paid'), ('F', 'finished')) v(status, label) USING (status) GROUP BY 1",
    ),
)
def inline_rows(t: Tables) -> DataFrame:
    labels = t.spark.createDataFrame([("O", "open"), ("P", "paid"), ("F", "finished")], "status string, label string")
    counted = t.shop_orders.groupBy("status").agg(F.count("*").alias("n"))
    return counted.join(F.broadcast(labels), "status").select("label", "n")


@query(
    "src_11_series",
    """SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS day, count(user_id) AS n FROM (SELECT unnest(generate_series((SELECT min(date_trunc('day', ts)) FROM events),
    (SELECT max(date_trunc('day', ts)) FROM events) + INTERVAL 3 DAY, INTERVAL 1 DAY)) AS d) LEFT JOIN events ON date_trunc('day', ts) = d GROUP BY 1""",
)
def series(t: Tables) -> DataFrame:
    """A calendar from the first event to three days after the last, with empty days as 0."""
    per_day = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    span = per_day.agg(F.min("day").alias("a"), F.date_add(F.max("day"), 3).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b")).alias("day"))
    return days.join(per_day, "day", "left").select(F.col("day").cast("string").alias("day"), F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "src_12_named_table",
    with_(
        "shop_orders",
        "SELECT name, kind, (SELECT count(*) FROM shop_orders) AS n FROM (VALUES ('order_id', 'bigint'), ('status', 'string'), ('total', 'decimal(12,2)')) v(name, kind)",
    ),
)
def named_table(t: Tables) -> DataFrame:
    path = run_path(t.spark, "orders_table")
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    t.shop_orders.select("order_id", "status", "total").write.option("path", path).saveAsTable(table)
    listed = t.spark.createDataFrame(scans.describe_table(t.spark, table), "name string, kind string")
    return listed.withColumn("n", t.spark.table(table).agg(F.count("*")).scalar())


# --- sinks -------------------------------------------------------------------------------------


@query(
    "snk_01_write_modes",
    """SELECT step, n * (SELECT count(*) FROM supplier) AS n, outcome FROM (VALUES (1, 1, 'written'), (2, 1, 'written'), (3, 2, 'written'), (4, 2, 'written'),
    (5, 2, 'PATH_ALREADY_EXISTS')) v(step, n, outcome)""",
)
def write_modes(t: Tables) -> DataFrame:
    """error on an empty place, overwrite, append, ignore, error on an existing one."""
    results = []
    path = run_path(t.spark, "modes")
    for step, mode in enumerate(["error", "overwrite", "append", "ignore", "error"], 1):
        try:
            sinks.write(t.supplier, path, mode=mode)
            outcome = "written"
        except AnalysisException as error:
            outcome = error.getCondition()
        results.append(t.spark.createDataFrame([(step, t.spark.read.parquet(path).count(), outcome)], "step int, n bigint, outcome string"))
    return union_all(results)


CODECS = ["snappy", "gzip", "zstd"]


@query("snk_02_codecs", " UNION ALL ".join(f"SELECT '{c}' AS codec, count(*) AS n, sum(CAST(l_quantity AS BIGINT))::BIGINT AS qty FROM lineitem" for c in CODECS))
def codecs(t: Tables) -> DataFrame:
    results = []
    for codec in CODECS:
        path = run_path(t.spark, f"lines-{codec}")
        sinks.write(t.lineitem, path, codec=codec)
        results.append(t.spark.read.parquet(path).agg(F.lit(codec).alias("codec"), F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("qty")))
    return union_all(results)


@query("snk_03_partitioned_write", with_("shop_orders", "SELECT strftime(created_at, '%Y-%m') AS order_month, count(*) AS n, CAST(sum(total) AS DOUBLE) AS total FROM shop_orders GROUP BY 1"))
def partitioned_write(t: Tables) -> DataFrame:
    stored = t.spark.read.parquet(orders_by_month(t))
    return stored.groupBy(F.col("order_month").cast("string").alias("order_month")).agg(F.count("*").alias("n"), F.sum("total").cast("double").alias("total"))


@query("snk_04_small_files", "SELECT count(*) AS n, count(DISTINCT date_trunc('month', o_orderdate)) AS files FROM orders")
def small_files(t: Tables) -> DataFrame:
    """Clustered by partition column before the write: one file per directory, not one per task."""
    return sinks.file_report(t.spark.read.parquet(orders_by_month(t))).select(F.col("rows").alias("n"), "files")


@query(
    "snk_05_dynamic_overwrite",
    with_(
        "shop_orders",
        """SELECT strftime(created_at, '%Y-%m') AS order_month, count(*) AS n, CAST(sum(CASE WHEN strftime(created_at, '%Y-%m') = '1998-03' THEN 2 * total ELSE total END) AS DOUBLE) AS total
        FROM shop_orders GROUP BY 1""",
    ),
)
def dynamic_overwrite(t: Tables) -> DataFrame:
    """One month is written again with doubled totals; the others stay as they were."""
    path = orders_by_month(t)
    month = F.date_format("created_at", "yyyy-MM")
    again = t.shop_orders.withColumn("order_month", month).filter(F.col("order_month") == "1998-03")
    sinks.overwrite_partitions(again.withColumn("total", (2 * F.col("total")).cast("decimal(12,2)")), path, "order_month")
    stored = t.spark.read.parquet(path)
    return stored.groupBy(F.col("order_month").cast("string").alias("order_month")).agg(F.count("*").alias("n"), F.sum("total").cast("double").alias("total"))


@query("snk_06_bucketed_join", with_("shop_orders shop_customers", "SELECT order_id, customer_id, tier FROM shop_orders JOIN shop_customers USING (customer_id)"))
def bucketed_join(t: Tables) -> DataFrame:
    """Two tables bucketed alike join without a shuffle."""
    tables = {}
    for name, df in (("o", t.shop_orders.select("order_id", "customer_id")), ("c", t.shop_customers.select("customer_id", "tier"))):
        path = run_path(t.spark, f"bucketed_{name}")
        tables[name] = path.rsplit("/", 1)[-1].replace("-", "_")
        sinks.write_bucketed(df, tables[name], path, 8, "customer_id")
    joined = t.spark.table(tables["o"]).join(t.spark.table(tables["c"]).hint("merge"), "customer_id")
    return joined.select("order_id", "customer_id", "tier")


@query("snk_10_file_count", "SELECT count(*) AS n, CAST(4 AS BIGINT) AS files FROM events")
def file_count(t: Tables) -> DataFrame:
    path = run_path(t.spark, "four-files")
    sinks.write_files(t.events, path, 4)
    return sinks.file_report(t.spark.read.parquet(path)).select(F.col("rows").alias("n"), "files")


REPORTED = ["customer", "orders", "lineitem", "events"]


@query("snk_11_dataset_report", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS rows, true AS has_files, true AS has_bytes FROM {n}" for n in REPORTED))
def dataset_report(t: Tables) -> DataFrame:
    """Rows are exact; the numbers of files and bytes depend on the writer, so only their presence is shown."""
    reports = [sinks.file_report(t.spark.read.parquet(t.path(n))).select(F.lit(n).alias("name"), "*") for n in REPORTED]
    return union_all(reports).select("name", "rows", (F.col("files") > 0).alias("has_files"), (F.col("bytes") >= F.col("files")).alias("has_bytes"))


@query("snk_12_compaction", "SELECT count(*) AS n, CAST(1 AS BIGINT) AS files, true AS fewer FROM events")
def compaction(t: Tables) -> DataFrame:
    """Many small files become as many as their bytes need."""
    source, target = run_path(t.spark, "scattered"), run_path(t.spark, "compacted")
    sinks.write_files(t.events, source, 24)
    before = sinks.file_report(t.spark.read.parquet(source))
    sinks.compact(t.spark, source, target, 64 * 1024 * 1024)
    after = sinks.file_report(t.spark.read.parquet(target))
    return after.select(F.col("rows").alias("n"), "files", (F.col("files") < before.select("files").scalar()).alias("fewer"))


# --- generated tables --------------------------------------------------------------------------


def draw_sql(row_id: str, column: str) -> str:
    seed, modulus = generate.seed(column), generate.MODULUS
    x = f"(({row_id}) % {modulus} * {generate.FIRST} + {seed}) % {modulus}"
    y = f"(({x}) * (({x}) % 65536 + 1)) % {modulus}"
    return f"((({y}) * {generate.SECOND} + {seed}) % {modulus})"


def weighted_sql(parts: dict[str, int], row_id: str, column: str) -> str:
    values = ", ".join(f"'{value}'" for value, n in parts.items() for _ in range(n))
    return f"([{values}])[CAST({draw_sql(row_id, column)} % {sum(parts.values())} AS INTEGER) + 1]"


def moment_sql(row_id: str, column: str) -> str:
    return f"make_timestamp(({generate.START} + {draw_sql(row_id, column)} % {generate.TWO_YEARS}) * 1000000)"


def small_ids_sql(row_id: str, column: str, largest: str) -> str:
    u = f"CAST({draw_sql(row_id, column)} AS DOUBLE) / {generate.MODULUS}"
    return f"1 + CAST(floor(({u}) * ({u}) * {largest}) AS BIGINT)"


cte(
    "gen_orders",
    f"""SELECT o_orderkey AS order_id, CASE WHEN {draw_sql('o_orderkey', 'order.customer.hot')} % 100 < 5 THEN 1
    ELSE {small_ids_sql('o_orderkey', 'order.customer', 'b')} END AS customer_id, {weighted_sql(generate.STATUS, 'o_orderkey', 'order.status')} AS status,
    {moment_sql('o_orderkey', 'order.created_at')} AS created_at FROM (SELECT o_orderkey, (SELECT count(*) * 9 // 10 FROM customer) AS b FROM orders)""",
)


def generated_orders(t: Tables) -> DataFrame:
    return generate.orders(t.orders.select(F.col("o_orderkey").alias("id")), t.customer.count() * 9 // 10)


def generated_customers(t: Tables) -> DataFrame:
    return generate.customers(t.customer.select(F.col("c_custkey").alias("id")))


@query("gen_01_weighted_pick", f"SELECT c_custkey AS customer_id, {weighted_sql(generate.TIER, 'c_custkey', 'customer.tier')} AS tier FROM customer")
def weighted_pick(t: Tables) -> DataFrame:
    return generated_customers(t).select("customer_id", "tier")


@query("gen_02_uniform_time", f"SELECT c_custkey AS customer_id, {moment_sql('c_custkey', 'customer.created_at')} AS created_at FROM customer")
def uniform_time(t: Tables) -> DataFrame:
    return generated_customers(t).select("customer_id", "created_at")


@query(
    "gen_03_periodic_nulls",
    f"SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 20 <> 0 THEN {weighted_sql(generate.CITY, 'c_custkey', 'customer.city')} END AS city FROM customer",
)
def periodic_nulls(t: Tables) -> DataFrame:
    return generated_customers(t).select("customer_id", "city")


@query("gen_04_skewed_orders", with_("gen_orders", "SELECT * FROM gen_orders"))
def skewed_orders(t: Tables) -> DataFrame:
    return generated_orders(t)


@query(
    "gen_05_order_lines",
    with_(
        "gen_orders",
        f"""SELECT order_id, line_no, product_id, qty, CAST(qty * CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS line_total FROM (SELECT order_id, line_no,
        {draw_sql('order_id * 4 + line_no', 'line.product')} % (SELECT count(*) * 9 // 10 FROM part) AS product_id,
        CAST({draw_sql('order_id * 4 + line_no', 'line.qty')} % 3 + 1 AS INTEGER) AS qty
        FROM (SELECT order_id, CAST(unnest(range(1, order_id % 4 + 2)) AS INTEGER) AS line_no FROM gen_orders)) JOIN part ON p_partkey = product_id""",
    ),
)
def order_lines(t: Tables) -> DataFrame:
    prices = t.part.select(F.col("p_partkey").alias("product_id"), F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"))
    lines = generate.order_lines(generated_orders(t), prices, t.part_count * 9 // 10)
    return lines.select("order_id", "line_no", "product_id", "qty", F.col("line_total").cast("double").alias("line_total"))


@query(
    "gen_06_dirty_events",
    f"""SELECT event_id, CASE WHEN {draw_sql('event_id', 'event.no_user')} % 100 >= 3 THEN {small_ids_sql('event_id', 'event.user', 'c')} END AS user_id,
    {weighted_sql(generate.EVENT_TYPE, 'event_id', 'event.type')} AS event_type, strftime({moment_sql('event_id', 'event.ts')}, '%Y-%m-%dT%H:%M:%S') AS ts
    FROM (SELECT event_id, (SELECT count(*) FROM customer) AS c FROM events)
    JOIN (VALUES (0), (1)) x(copy_no) ON copy_no = 0 OR {draw_sql('event_id', 'event.copies')} % 100 = 0""",
)
def dirty_events(t: Tables) -> DataFrame:
    return generate.dirty_events(t.events.select(F.col("event_id").alias("id")), t.customer.count())


@query(
    "gen_07_membership",
    f"""SELECT CAST((tag_id - 1) // 5 + 1 AS INTEGER) AS attribute_id, actor_id, tag_id, CASE WHEN h < percent * 100 THEN 1 ELSE -1 END AS latest_signal,
    TIMESTAMP '2026-01-01' + INTERVAL 1 SECOND * (h % 86400) AS last_persist_time FROM (SELECT actor_id, tag_id, 10 + (tag_id * 7) % 11 AS percent,
    {draw_sql('actor_id * 64 + tag_id', 'membership.signal')} % 10000 AS h FROM (SELECT o_orderkey AS actor_id, CAST(unnest(range(1, 21)) AS INTEGER) AS tag_id FROM orders)) WHERE h < (percent + 5) * 100""",
)
def generated_membership(t: Tables) -> DataFrame:
    return generate.membership(t.orders, "o_orderkey")
