import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window, functions as F

from tributary.operators import joins
from tributary.operators.ordered import exact_percentiles, ordered_scan, percentile_parts, sessionise, split_hot, tiles


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows belong to key 1; values repeat and some are NULL, some keys and orders too."""
    rng = random.Random(7)
    rows = [(1 if i % 3 == 0 else rng.choice([None, *range(2, 40)]), rng.choice([None, *range(60)]), i, rng.choice([None, 1, 2, 3])) for i in range(3000)]
    return spark.createDataFrame(rows, "k int, o int, id int, v int").repartition(4).persist()


def same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.mark.parametrize("hot_rows, slices", [(0, 7), (0, 150), (500, 5), (500, None), (10**6, None)])
def test_scan_equals_plain_windows(skewed, hot_rows, slices):
    w = Window.partitionBy("k").orderBy("o", "id")
    by_value = Window.partitionBy("k").orderBy("o")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    plain = skewed.select(
        "*",
        F.row_number().over(w).alias("rn"),
        F.rank().over(by_value).alias("r"),
        F.dense_rank().over(by_value).alias("d"),
        F.count("*").over(Window.partitionBy("k")).alias("n"),
        F.sum("id").over(so_far).alias("s"),
        F.lag("v").over(w).alias("before"),
        F.lead("v").over(w).alias("after"),
        F.max("id").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("m"),
    )
    scanned = ordered_scan(
        skewed, ["k"], ["o", "id"], row_number="rn", rank="r", dense_rank="d", total="n",
        sums={"s": "id"}, lags={"before": "v"}, leads={"after": "v"}, maxes_before={"m": "id"}, hot_rows=hot_rows, slices=slices,
    )
    same(scanned, plain)


@pytest.mark.parametrize("n", [3, 4, 7])
def test_global_tiles(skewed, n):
    ordered = skewed.select("id", "o").filter(f"id < {3000 - n}")
    placed = ordered_scan(ordered, [], ["o", "id"], row_number="rn", total="t", slices=5)
    same(
        placed.select("id", tiles(F.col("rn"), F.col("t"), n)),
        ordered.select("id", F.ntile(n).over(Window.orderBy("o", "id"))),
    )


def test_a_key_is_cut_at_its_own_quantiles(spark):
    """One key, no two rows alike, most of them in a sliver of the range: the slices are even all the same."""
    n = 20_000
    rows = spark.range(n).select(F.lit(1).alias("k"), F.when(F.col("id") % 1000 == 0, F.col("id") * 10**9).otherwise(F.col("id")).alias("o"))
    cold, hot = split_hot(rows, ["k"], ["o"], hot_rows=1000, slices=16)
    sizes = [r["count"] for r in hot.groupBy("_at").count().collect()]
    assert cold.isEmpty() and len(sizes) == 16 and max(sizes) <= 2 * n / 16
    w = Window.partitionBy("k").orderBy("o")
    scanned = ordered_scan(rows, ["k"], ["o"], row_number="rn", lags={"before": "o"}, hot_rows=1000, slices=16)
    same(scanned, rows.select("*", F.row_number().over(w).alias("rn"), F.lag("o").over(w).alias("before")))


def test_ties_over_many_borders(spark):
    """One value of the order fills several slices, beside values that fill none."""
    rows = spark.range(4000).select(F.when(F.col("id") < 3000, 5).when(F.col("id") < 3100, F.lit(None)).otherwise(F.col("id") % 7).cast("int").alias("o"), "id")
    w = Window.orderBy("o")
    scanned = ordered_scan(rows, [], ["o", "id"], rank="r", dense_rank="d", slices=12)
    same(scanned, rows.select("*", F.rank().over(w).cast("bigint").alias("r"), F.dense_rank().over(w).cast("bigint").alias("d")))


def test_facts_are_shuffled_at_most_three_times(skewed):
    """Cold keys: counts and one window. Hot keys, already cut and written: windows and edges by (key, slice)."""
    plain = ordered_scan(skewed, ["k"], ["o", "id"], row_number="rn", hot_rows=10**6)._jdf.queryExecution().executedPlan().toString()
    assert plain.count("Exchange hashpartitioning") == 1 and "Join" not in plain
    cold, hot = split_hot(skewed, ["k"], ["o", "id"], hot_rows=500, slices=4)
    assert {r.k for r in hot.select("k").distinct().collect()} == {1} and cold.filter("k = 1").isEmpty()


@pytest.mark.parametrize("hot_rows", [0, 200, 10**6])
def test_sessions_equal_brute_force(spark, hot_rows):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(1 if i % 3 == 0 else rng.choice([None, 2, 3, 4, 5]), start + dt.timedelta(minutes=rng.randrange(60 * 24 * 12)), i) for i in range(900)]
    df = spark.createDataFrame(rows, "u int, ts timestamp_ntz, id int")
    got = {r["id"]: r["session_id"] for r in sessionise(df, "u", ["ts", "id"], "3 HOURS", hot_rows=hot_rows, slices=6).collect()}
    expected, last = {}, {}
    for u, ts, i in sorted(rows, key=lambda r: r[1:]):
        n, previous = last.get(u, (0, None))
        n += previous is None or ts - previous > dt.timedelta(hours=3)
        last[u] = (n, ts)
        expected[i] = n
    assert got == expected


@pytest.mark.parametrize("interpolate", [True, False])
@pytest.mark.parametrize("accuracy", [7, 100, 10_000])
def test_exact_percentiles(spark, interpolate, accuracy):
    rng = random.Random(5)
    rows = [("a", float(rng.randrange(100))) for _ in range(501)] + [("b", 5.0)] * 400 + [("c", -3.5)] + [("a", None)] + [(None, float(i)) for i in range(7)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {(r["k"], r["q"]): r["value"] for r in exact_percentiles(df, ["k"], "v", [0.0, 0.5, 0.9, 0.99, 1.0], interpolate, accuracy=accuracy).collect()}
    for k in ("a", "b", "c", None):
        v = sorted(x for key, x in rows if key == k and x is not None)
        for q in (0.0, 0.5, 0.9, 0.99, 1.0):
            if interpolate:
                at = q * (len(v) - 1)
                low, high = v[math.floor(at)], v[math.ceil(at)]
                want = low + (high - low) * (at - math.floor(at))
            else:
                want = v[max(math.ceil(q * len(v)) - 1, 0)]
            assert got[k, q] == pytest.approx(want)


def test_skew_joins_equal_plain_join(spark, skewed):
    names = spark.createDataFrame([(k, f"n{k}") for k in range(1, 60)], "k int, name string")
    plain = skewed.select("k", "id").join(names, "k").select("k", "id", "name")
    assert {r["k"] for r in joins.hot_keys(skewed, "k", 0.2).collect()} == {1}
    same(joins.salted_join(skewed.select("k", "id"), names, "k", "id", salts=4, share=0.2).select("k", "id", "name"), plain)
    same(joins.hot_split_join(skewed.select("k", "id"), names, "k", share=0.2).select("k", "id", "name"), plain)


def test_percentiles_of_a_million_values_and_an_outlier(spark):
    """One value of 1e12 and a million different ones: only brackets around the ranks are ordered."""
    n = 1_000_000
    rows = spark.range(n).select(F.pmod(F.xxhash64("id"), F.lit(1 << 40)).alias("v")).unionAll(spark.createDataFrame([(10**12,)], "v bigint"))
    every = sorted(r.v for r in rows.collect())
    got = {r.q: r.value for r in exact_percentiles(rows, [], "v", [0.001, 0.5, 0.99], interpolate=False, accuracy=1000).collect()}
    assert got == {q: float(every[math.ceil(q * len(every)) - 1]) for q in (0.001, 0.5, 0.99)}
    below, inside = percentile_parts(rows, [], "v", [0.5, 0.99], accuracy=1000)
    assert inside.count() <= 2 * 8 * n / 1000
    assert below.count() == 2
