"""Time the headline queries with the no-op sink and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import functions as F

from tributary.operators import generate, segments, stored
from tributary.operators.segments import Segment, tag
from tributary.plans import QUERIES
from tributary.session import local_session
from tributary.storage import run_path, write_and_read
from tributary.tables import Tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = [
    "cdc_01_parse_strict",
    "cdc_10_current_state",
    "cdc_13_reconcile",
    "cdc_14_status_audit",
    "seg_01_most_recent_signal",
    "seg_02_tag_bitmaps",
    "seg_07_row_algebra",
    "seg_08_many_segments",
    "seg_10_contains",
    "seg_11_all_members",
    "seg_12_pages",
    "seg_14_export_roaring",
    "pip_10_segmentation",
    "joi_01_revenue_per_category",
    "joi_14_salted",
    "joi_18_range_containment",
    "agg_01_monthly_revenue",
    "agg_04_rollup",
    "agg_09_exact_percentiles",
    "agg_15_nested_objects",
    "win_01_ranks",
    "win_02_top_n",
    "win_09_sessions",
    "fts_01_inverted_index",
    "fts_03_query_forms",
    "fts_06_rank",
    "fts_10_trigram_match",
    "dq_01_event_gate",
    "ups_03_merge",
    "ups_06_allocate_stock",
    "gen_07_membership",
    "pip_04_daily_funnel",
    "pip_05_daily_revenue",
    "stm_08_bronze_ingestion",
]


def timed(job) -> float:
    start = time.perf_counter()
    job().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def run(spark, key: str) -> float:
    return timed(lambda: QUERIES[key](spark, SF_DIR))


def segment_of(number: int, tags: int, leaves: int) -> Segment:
    """Expression number ``number``: every seventh tag from it on, halves joined by turns of AND, OR and AND NOT."""

    def build(first: int, count: int) -> Segment:
        if count == 1:
            return tag((number + 7 * first) % tags + 1)
        half = count // 2
        return Segment(("or", "and", "and_not")[(number + count) % 3], build(first, half), build(first + half, count - half))

    return build(0, leaves)


def segmentation(spark) -> dict[str, float]:
    """50 tags and 300 ten-leaf segments over twenty actors per order; inputs are stored first."""
    spread = F.sequence(F.col("o_orderkey") * 20, F.col("o_orderkey") * 20 + 19)
    actors = Tables(spark, SF_DIR).orders.select(F.explode(spread).alias("actor_id"))
    gold = write_and_read(generate.membership(actors.repartitionByRange(8, "actor_id"), "actor_id", tags=50), "bench-gold")
    tags = write_and_read(segments.tag_bitmaps(gold), "bench-tags")
    wanted = {i: segment_of(i, 50, 10) for i in range(1, 301)}
    found = write_and_read(segments.evaluate(tags, wanted), "bench-segments")
    sets = stored.store(found, ["segment_id"], run_path(spark, "bench-stored"))
    probes = spark.range(2000).select((F.col("id") % 300 + 1).cast("int").alias("segment_id"), (F.col("id") * 1499).alias("actor_id"))
    cursors = probes.select("segment_id", F.col("actor_id").alias("cursor"))
    jobs = {
        "bulk_build_50_tags": lambda: segments.tag_bitmaps(gold),
        "bulk_300_segments": lambda: segments.evaluate(tags, wanted),
        "bulk_40_full_reads": lambda: stored.members(sets, where=F.col("segment_id") <= 40),
        "bulk_2000_contains": lambda: stored.contains(sets, probes, "actor_id"),
        "bulk_2000_pages": lambda: stored.pages(sets, cursors),
    }
    seconds = {name: round(min(timed(job) for _ in range(2)), 3) for name, job in jobs.items()}
    start = time.perf_counter()
    stored.store(found, ["segment_id"], run_path(spark, "bench-stored"))
    return seconds | {"bulk_store_300_segments": round(time.perf_counter() - start, 3)}


def main() -> None:
    spark = local_session(CPUS, memory=os.environ.get("BENCH_MEMORY", "8g"))
    keys = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    run(spark, "agg_02_conditional")  # start the executors' code paths outside the clock
    seconds = {key: round(min(run(spark, key) for _ in range(2)), 3) for key in keys}
    if keys is HEADLINE:
        seconds |= segmentation(spark)
    print(
        json.dumps(
            {"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": SF_DIR.rsplit("sf", 1)[-1]}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
