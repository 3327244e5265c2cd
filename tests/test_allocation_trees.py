import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tributary.operators import trees, versions


@pytest.mark.parametrize("hot_rows", [100_000, 40, 5])
def test_allocation_equals_a_sequential_loop(spark, hot_rows):
    """Refused requests take nothing; ``hot_rows`` decides which items go in rounds."""
    rng = random.Random(hot_rows)
    stock = {k: rng.randint(0, 300) for k in range(12)} | {100: 1500}
    rows = [(rng.choice([*stock, 100, 100, 100, 999]), t, rng.choice([None, -3, 0, 1, 2, 5, 20, 60, 200])) for t in range(1500)]
    left, wanted = dict(stock), {}
    for k, t, q in rows:
        if k in left:
            wanted[t] = q is not None and 0 <= q <= left[k]
            left[k] -= q if wanted[t] else 0
    frame = spark.createDataFrame(rows, "item int, t int, q int").repartition(4)
    table = spark.createDataFrame(list(stock.items()), "item int, stock int")
    got = versions.allocate(frame, table, "item", "q", ["t"], hot_rows=hot_rows)
    assert got.columns == ["item", "t", "q", "accepted"]
    assert {r.t: r.accepted for r in got.collect()} == wanted


def test_a_smaller_later_request_is_served(spark):
    rows = spark.createDataFrame([("a", 1, 7), ("a", 2, 5), ("a", 3, 3), ("a", 4, 1)], "item string, t int, q int")
    got = versions.allocate(rows, spark.createDataFrame([("a", 10)], "item string, stock int"), "item", "q", ["t"])
    assert [r.accepted for r in got.orderBy("t").collect()] == [True, False, True, False]


def test_a_chain_of_five_thousand_nodes(spark):
    chain = spark.range(5000).select(F.col("id"), F.when(F.col("id") > 0, F.col("id") - 1).alias("up"), F.lit("n").alias("name"))
    found = trees.paths(chain, "id", "up", "name", "")
    assert found.agg(F.count("*"), F.max("depth"), F.max(F.length("path"))).first() == (5000, 5000, 5000)
    assert found.filter(F.col("depth") != F.length("path")).isEmpty()


def test_closure_above_a_million_rows(spark):
    chain = spark.range(1500).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    pairs = trees.closure(chain, "id", "up")
    assert pairs.agg(F.count("*"), F.count_distinct("id", "ancestor"), F.max("distance")).first() == (1500 * 1501 // 2, 1500 * 1501 // 2, 1499)
    assert pairs.filter(F.col("id") - F.col("ancestor") != F.col("distance")).isEmpty()


def test_random_forest_orphans_and_cycles(spark):
    rng = random.Random(4)
    up = {i: rng.choice([None, rng.randrange(i)]) if i > 5 else None for i in range(300)} | {400: 399, 401: 400}  # 399 does not exist
    frame = spark.createDataFrame([(i, p, f"x{i}") for i, p in up.items()], "id int, up int, name string")
    above = defaultdict(list)
    for i in up:
        at, d = i, 0
        while at in up:
            above[i].append((at, d))
            at, d = up[at], d + 1
    assert sorted((r.id, r.ancestor, r.distance) for r in trees.closure(frame, "id", "up").collect()) == sorted((i, a, d) for i, x in above.items() for a, d in x)
    got = {r.id: (r.depth, r.path) for r in trees.paths(frame, "id", "up", "name").collect()}
    assert got == {i: (len(x), " > ".join(f"x{a}" for a, _ in reversed(x))) for i, x in above.items() if i < 400}
    assert trees.closure(frame.limit(0), "id", "up").count() == trees.paths(frame.limit(0), "id", "up", "name").count() == 0
    ring = spark.createDataFrame([(1, 2, "a"), (2, 3, "b"), (3, 1, "c"), (4, 1, "d")], "id int, up int, name string")
    for build in (lambda: trees.paths(ring, "id", "up", "name"), lambda: trees.closure(ring, "id", "up")):
        with pytest.raises(ValueError, match="cycle"):
            build()
