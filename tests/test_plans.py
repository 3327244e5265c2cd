import inspect
import os

import duckdb  # noqa: F401
import pytest
from pyspark.sql import functions as F

from compare import TEST_DIR as SF_DIR, connect, difference
from tributary.plans import QUERIES, medallion_queries, scalar_queries
from tributary.sources import scans
from tributary.streaming import jobs
from tributary.storage import run_path

# One or two per family; TRIBUTARY_FULL=1 compares all of them.
SAMPLE = [
    "agg_04_rollup", "agg_09_exact_percentiles", "agg_15_nested_objects", "agg_18_step_summary", "arr_02_higher_order", "bit_01_word_algebra",
    "cdc_01_parse_strict", "cdc_10_current_state", "cdc_13_reconcile", "cdc_14_status_audit", "dat_01_dates", "dq_05_overlapping_periods",
    "fts_01_inverted_index", "fts_03_query_forms", "fts_06_rank", "gen_05_order_lines", "joi_14_salted", "joi_15_hot_split", "joi_18_range_containment",
    "jsn_03_edit", "map_01_entries", "mth_01_math", "pip_04_daily_funnel", "pip_10_segmentation", "prj_14_clean_events", "rec_02_revenue_rollup",
    "seg_08_many_segments", "seg_12_pages", "seg_14_export_roaring", "set_03_member_sets", "snk_05_dynamic_overwrite", "src_03_corrupt_rows",
    "srt_04_keyset_page", "stm_07_late_rows", "stm_10_keyed_state", "str_02_size_text", "udf_04_sql_scalar_function", "ups_06_allocate_stock",
    "ups_08_roll_back", "win_08_quartiles", "win_09_sessions",
]
KEYS = list(QUERIES) if os.environ.get("TRIBUTARY_FULL") else SAMPLE


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_sql(spark, con, key):
    q = QUERIES[key]
    df = q(spark, SF_DIR)
    if q.oracle:
        assert difference(df, con, q.oracle) is None
    else:
        assert df.count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_is_pruned_and_filtered_at_the_source(spark):
    text = QUERIES["src_01_columnar_scan"](spark, SF_DIR)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    assert "PushedFilters" in text and "EqualTo(l_returnflag,R)" in text
    read = next(line for line in text.splitlines() if line.startswith("ReadSchema"))
    assert "l_orderkey" in read and "l_tax" not in read


def test_partition_filter_reads_one_directory(spark):
    assert "PartitionFilters: [isnotnull(order_month" in plan(QUERIES["src_05_partition_discovery"](spark, SF_DIR))


def test_bucketed_join_has_no_exchange(spark):
    assert "Exchange" not in plan(QUERIES["snk_06_bucketed_join"](spark, SF_DIR))


@pytest.mark.parametrize("key", ["win_02_top_n", "win_13_newest_version", "joi_08_lateral_top3"])
def test_top_n_is_limited_before_the_shuffle(spark, key):
    assert "WindowGroupLimit" in plan(QUERIES[key](spark, SF_DIR))


@pytest.mark.parametrize(
    "key, operator",
    [
        ("joi_12_broadcast", "BroadcastHashJoin"),
        ("joi_13_sort_merge", "SortMergeJoin"),
        ("joi_13_shuffle_hash", "ShuffledHashJoin"),
        ("joi_20_theta", "BroadcastNestedLoopJoin"),
        ("srt_02_top_k", "TakeOrderedAndProject"),
    ],
)
def test_physical_operator(spark, key, operator):
    assert operator in plan(QUERIES[key](spark, SF_DIR))


def test_envelope_is_parsed_once(spark):
    assert plan(QUERIES["cdc_05_flatten"](spark, SF_DIR)).count("from_json") == 1


def test_segments_shuffle_once_after_the_latest_signal(spark):
    from tributary.plans.segment_queries import SEGMENTS
    from tributary.operators import segments

    stored = spark.createDataFrame([(1, 1, 1, 1)], "attribute_id int, actor_id bigint, tag_id int, latest_signal int")
    assert plan(segments.evaluate_members(stored, SEGMENTS)).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("key", ["cdc_10_current_state", "seg_07_row_algebra", "win_09_sessions", "joi_14_salted", "agg_09_exact_percentiles"])
def test_hot_paths_stay_in_the_jvm(spark, key):
    text = plan(QUERIES[key](spark, SF_DIR))
    assert not any(word in text for word in ("Python", "MapInArrow", "ArrowEval", "MapInPandas", "FlatMapGroups"))


def test_sql_and_dataframe_forms_have_one_plan(spark, tables):
    by_sql, by_api = scalar_queries.sql_on_views(tables), scalar_queries.by_dataframe(tables)
    assert by_sql._jdf.queryExecution().optimizedPlan().sameResult(by_api._jdf.queryExecution().optimizedPlan())


def test_join_by_name_keeps_one_key(spark):
    assert QUERIES["joi_17_by_name"](spark, SF_DIR).columns.count("customer_id") == 1
    assert {"buyer", "customer_id"} <= set(QUERIES["joi_17_by_expression"](spark, SF_DIR).columns)


def test_nulls_come_last(spark):
    cities = [r["city"] for r in QUERIES["srt_01_nulls_last"](spark, SF_DIR).collect()]
    first_null = cities.index(None)
    assert set(cities[first_null:]) == {None} and cities[:first_null] == sorted(cities[:first_null], reverse=True)


def test_windows_without_a_key_come_after_aggregation(spark):
    for key, q in QUERIES.items():
        if key.startswith("win_") and "Window.orderBy" in inspect.getsource(q.build):
            assert "by_month" in inspect.getsource(q.build), key


def test_rate_stream(spark):
    path = run_path(spark, "rate")
    stream = scans.rate_stream(spark, 50).select(F.col("timestamp").alias("ts"), "value")
    counts = jobs.window_counts(stream, "ts", "10 seconds", "5 seconds")
    running = jobs.run_periodic(counts, jobs.batch_folder(f"{path}/out"), f"{path}/checkpoint", every="1 second")
    try:
        running.awaitTermination(6)
    finally:
        running.stop()
    stored = spark.read.parquet(f"{path}/out")
    assert jobs.latest_updates(stored, ["start", "end"], ["n"]).agg(F.sum("n")).first()[0] > 0


def test_gold_needs_a_clean_silver(tables):
    assert medallion_queries.funnel(tables).count() > 0


def test_registry_is_complete():
    assert len(QUERIES) >= 240
    assert not [key for key, q in QUERIES.items() if q.oracle is None]
