import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tributary.operators import materialised
from tributary.storage import run_path

ORDERS = "id INT, day DATE, customer INT, total DECIMAL(12,2)"


def daily(spark):
    return materialised.SumView(
        run_path(spark, "view"), {"day": F.col("day")}, {"revenue": F.col("total")}, F.date_format("day", "yyyy-MM")
    )


def rebuilt(rows):
    """day -> (sum, values, rows) of plain Python rows."""
    groups = {}
    for _, day, _, total in rows:
        total_sum, values, n = groups.get(day, (Decimal(0), 0, 0))
        groups[day] = (total_sum + (total or 0), values + (total is not None), n + 1)
    return {d: (s if v else None, n) for d, (s, v, n) in groups.items()}


def stored(spark, view, facts):
    return {r["day"]: (r["revenue"], r["n_rows"]) for r in materialised.read(spark, view, facts).collect()}


def random_order(rng, key):
    day = None if rng.random() < 0.05 else date(2024, 1, 1) + timedelta(days=rng.randrange(120))
    return key, day, rng.randrange(9), None if rng.random() < 0.1 else Decimal(rng.randrange(10**6)) / 100


def test_refresh_equals_a_rebuild_after_inserts_updates_and_deletes(spark):
    rng = random.Random(4)
    rows = {k: random_order(rng, k) for k in range(150)}
    view = daily(spark)
    present = spark.createDataFrame(list(rows.values()), ORDERS)
    materialised.build(view, present)
    assert stored(spark, view, present) == rebuilt(rows.values())
    for version in (1, 2):
        changes = {k: (*random_order(rng, k), rng.random() < 0.4) for k in rng.sample(range(200), 60)}
        delta = materialised.signed_changes(present, spark.createDataFrame(list(changes.values()), ORDERS + ", deleted BOOLEAN"), "id")
        materialised.refresh(view, delta, version)
        for k, (*row, deleted) in changes.items():
            rows.pop(k, None)
            if not deleted:
                rows[k] = tuple(row)
        present = spark.createDataFrame(list(rows.values()), ORDERS)
        assert stored(spark, view, present) == rebuilt(rows.values())


def test_only_changed_partitions_are_read_and_replaced(spark):
    view = daily(spark)
    rows = [(m, date(2024, m, 3), 1, Decimal(10 * m)) for m in range(1, 7)]
    present = spark.createDataFrame(rows, ORDERS)
    materialised.build(view, present)
    files = lambda: {r["part"]: r["f"] for r in spark.read.parquet(view.path).select("part", F.col("_metadata.file_path").alias("f")).collect()}
    before = files()
    changed = spark.createDataFrame([(2, date(2024, 5, 3), 1, Decimal(1), False), (6, None, None, None, True)], ORDERS + ", deleted BOOLEAN")
    replaced = materialised.refresh(view, materialised.signed_changes(present, changed, "id"), 1)
    after = files()
    assert replaced == ["2024-02", "2024-05", "2024-06"]
    assert {p for p in before if before[p] != after[p]} == set(replaced)
    assert stored(spark, view, present) == {
        date(2024, 1, 3): (10, 1), date(2024, 3, 3): (30, 1), date(2024, 4, 3): (40, 1), date(2024, 5, 3): (51, 2),
    }
    plan = materialised.read(spark, view, present, only=["2024-05"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan or "PartitionFilters: [(part" in plan


def test_a_version_counts_once_also_after_half_a_refresh(spark):
    view = daily(spark)
    present = spark.createDataFrame([(1, date(2024, 1, 1), 1, Decimal(5)), (2, date(2024, 2, 1), 1, Decimal(7))], ORDERS)
    materialised.build(view, present)
    new = spark.createDataFrame([(3, date(2024, 1, 1), 1, Decimal(1)), (4, date(2024, 2, 1), 1, Decimal(2))], ORDERS)
    delta = materialised.signed(new, 1)
    # A crash after the first of two partitions.
    assert materialised.refresh(view, delta.filter("id = 3"), 1) == ["2024-01"]
    assert materialised.refresh(view, delta, 1) == ["2024-02"]
    assert materialised.refresh(view, delta, 1) == []
    assert stored(spark, view, present) == {date(2024, 1, 1): (6, 2), date(2024, 2, 1): (9, 2)}


def test_an_emptied_partition_keeps_its_version_and_an_empty_view_starts(spark):
    view = daily(spark)
    none = spark.createDataFrame([], ORDERS)
    materialised.build(view, none)
    one = spark.createDataFrame([(1, date(2024, 1, 1), 1, Decimal(5))], ORDERS)
    assert materialised.refresh(view, materialised.signed(none, 1), 1) == []
    assert materialised.refresh(view, materialised.signed(one, 1), 2) == ["2024-01"]
    assert materialised.refresh(view, materialised.signed(one, -1), 3) == ["2024-01"]
    assert materialised.refresh(view, materialised.signed(one, -1), 3) == []
    assert stored(spark, view, none) == {}


def test_inexact_measures_are_refused(spark):
    view = materialised.SumView(run_path(spark, "view"), {"id": F.col("id")}, {"x": F.col("x")}, F.lit("all"))
    with pytest.raises(TypeError):
        materialised.build(view, spark.createDataFrame([(1, 0.5)], "id INT, x DOUBLE"))
