import datetime as dt

import pytest
from pyspark.sql import functions as F

from tributary.functions import scalars
from tributary.operators import quality, search, versions
from tributary.plans import medallion
from tributary.plans.medallion_queries import bronze
from tributary.storage import run_path


def test_gate_stops_on_dirty_events(tables):
    dirty = tables.events_raw.withColumn("event_ts", quality.parse_time(F.col("ts")))
    with pytest.raises(quality.GateFailed, match="unique_event_id"):
        quality.require(medallion.gate(dirty, "2024-01-01", "2024-12-31"))
    quality.require(medallion.gate(quality.clean_events(tables.events_raw), "2024-01-01", "2024-12-31"))


def test_touching_periods_do_not_overlap(spark):
    d = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    rows = [(1, d(0), d(30)), (1, d(30), d(40)), (2, d(0), d(90)), (2, d(10), d(20)), (2, d(50), d(60)), (3, d(5), d(6))]
    found = quality.overlaps(spark.createDataFrame(rows, "p int, a date, b date"), "p", "a", "b").collect()
    assert sorted((r["p"], r["a"]) for r in found) == [(2, d(10)), (2, d(50))]


def test_reload_touches_one_day(tables, spark):
    source, path = bronze(tables), run_path(spark, "silver")
    medallion.to_silver(spark, source, path)
    files = lambda: {r[0] for r in spark.read.parquet(path).select("_metadata.file_path").distinct().collect()}
    before = files()
    medallion.reload_day(spark, source, path, "2024-01-15")
    after = files()
    assert {f.split("event_date=")[1][:10] for f in before ^ after} == {"2024-01-15"}


def test_survivor_is_the_copy_ingested_last(spark):
    rows = [(1, 7, "2024-05-01T10:00:09", 1), (1, 8, "2024-05-01T10:00:00", 2), (2, 5, "broken", 3), (2, 6, "2024-05-01T10:00:00", 1)]
    rows += [(3, 2, "2024-05-01T10:00:00", 1), (3, 9, "2024-05-01T10:00:00", 1), (4, 1, "2024-05-01T10:00:00", 1), (4, None, "2024-05-01T10:00:00", 2)]
    raw = spark.createDataFrame(rows, "event_id bigint, user_id bigint, ts string, second int").select(
        "*", F.lit("view").alias("event_type"), F.lit(1).alias("product_id"), F.lit("tablet").alias("device"), F.timestamp_seconds("second").alias("_ingested_at")
    )
    assert {r["event_id"]: r["user_id"] for r in quality.clean_events(raw).collect()} == {1: 8, 2: 6, 3: 9}
    by_event_time = quality.clean_events(raw.drop("_ingested_at").filter("event_id = 1")).first()
    assert by_event_time["user_id"] == 7


def test_reload_can_empty_a_day(tables, spark):
    source, path, later = bronze(tables), run_path(spark, "silver"), run_path(spark, "raw")
    medallion.to_silver(spark, source, path)
    days = lambda: {str(r[0]): r[1] for r in medallion.read_silver(spark, path).groupBy("event_date").count().collect()}
    before = days()
    tables.events_raw.filter("ts LIKE '2024-01-15%'").drop("user_id").write.json(later)
    medallion.to_bronze(spark, later, source)
    medallion.reload_day(spark, source, path, "2024-01-15")
    assert "2024-01-15" in before and days() == {day: n for day, n in before.items() if day != "2024-01-15"}


def test_upsert_and_merge(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    source = spark.createDataFrame([(2, "B"), (4, "d"), (3, None)], "id int, v string")
    got = {r["id"]: (r["v"], r["action"]) for r in versions.upsert(target, source, ["id"]).collect()}
    assert got == {1: ("a", "kept"), 2: ("B", "updated"), 3: (None, "updated"), 4: ("d", "inserted")}
    assert {r["id"] for r in versions.merge(target, source, ["id"], F.col("v") == "B").collect()} == {1, 3, 4}


def test_counter_reset_counts_the_new_value(spark):
    from tributary.plans.window_queries import counter_increase

    class Fixture:
        events = spark.createDataFrame(
            [(1, dt.datetime(2024, 1, i + 1), i, v) for i, v in enumerate([10.0, 15.0, 3.0, 4.0])], "user_id int, ts timestamp_ntz, event_id int, value double"
        )

    assert counter_increase(Fixture).first()["increase"] == 10 + 5 + 3 + 1


@pytest.mark.parametrize("text, size", [("1.5GiB", 1.5 * 1024**3), ("2kB", 2000.0), (" 3 MB ", 3e6), ("abc", 0.0), ("", 0.0), ("7", 0.0)])
def test_size_text(spark, text, size):
    assert spark.range(1).select(scalars.size_in_bytes(F.lit(text))).first()[0] == size


@pytest.mark.parametrize(
    "query, expected",
    [
        ("battery life", {1, 2}),
        ('"long battery life"', {1}),
        ("battery -fast", {1, 3}),
        ("sturdy or modern", {3, 4}),
        ("-battery", {4}),
        ("", set()),
    ],
)
def test_search_box_syntax(spark, query, expected):
    docs = spark.createDataFrame(
        [(1, "A LONG battery life!"), (2, "fast battery, long life"), (3, "Sturdy battery"), (4, "modern; batterylife")], "id int, text string"
    )
    got = docs.filter(search.matches(search.normal(F.col("text")), query))
    assert {r["id"] for r in got.collect()} == expected


def test_closeness_covers_all_words(spark):
    text = F.lit("a x x b x a b c x c")
    row = spark.range(1).select(*[search.closeness(text, w).alias("".join(w)) for w in (["a", "b"], ["a", "b", "c"], ["a", "z"])]).first()
    assert tuple(row) == (1, 2, None)


def test_trigram_similarity(spark):
    row = spark.range(1).select(
        F.sort_array(search.trigrams(F.lit("Word"))).alias("g"),
        search.similarity(search.trigrams(F.lit("word")), search.trigrams(F.lit("two words"))).alias("s"),
    ).first()
    assert row["g"] == ["  w", " wo", "ord", "rd ", "wor"]
    assert row["s"] == pytest.approx(4 / 11)


def test_positions_of_every_occurrence(spark):
    docs = spark.createDataFrame([(7, "b a b"), (8, ""), (9, "Ünder a")], "id int, text string")
    got = {(r["id"], r["term"]): r["positions"] for r in search.postings(docs, "text", "id").collect()}
    assert got == {(7, "b"): [1, 3], (7, "a"): [2], (9, "ünder"): [1], (9, "a"): [2]}


def test_null_type_and_time_fail_the_gate(spark):
    rows = spark.createDataFrame([(1, 7, None, None)], "event_id bigint, user_id bigint, event_type string, event_ts timestamp_ntz")
    found = {r["check"]: r["violations"] for r in quality.event_gate(rows, ["view"], "2020-01-01", "2030-01-01").collect()}
    assert found == {"unique_event_id": 0, "user_present": 0, "known_type": 1, "time_in_range": 1}


def test_search_folds_vietnamese_and_splits_like_texts(spark):
    frame = spark.createDataFrame([("Điện thoại foo_bar",)], "t string")
    folded = search.normal(search.unaccent(frame.t))
    row = frame.select(search.matches(folded, "dien thoai").alias("a"), search.matches(search.normal(frame.t), "foo_bar").alias("b")).first()
    assert row["a"] and row["b"]


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.9])
def test_fuzzy_join_equals_brute_force(spark, threshold):
    """A thousand searches against names with typing errors."""
    import random
    import re

    rng = random.Random(int(threshold * 10))
    names = [" ".join("".join(rng.choice("abcdeilnorst") for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(1, 3))) for _ in range(400)] + ["", "!!", None, "Été déjà"]

    def typo(s):
        i = rng.randrange(max(len(s), 1))
        return s[:i] + rng.choice("xyz ") + s[i + rng.randint(0, 1) :]

    searches = [typo(rng.choice(names[:400])) for _ in range(997)] + ["", "-", "ete deja"]

    def grams(s):
        return {f"  {w} "[i : i + 3] for w in re.findall(r"[^\W_]+", (s or "").lower()) for i in range(len(w) + 1)}

    known = {s: grams(s) for s in {*names, *searches}}
    wanted = {(n, s) for n in set(names) for s in set(searches) if known[n] and known[s] and len(known[n] & known[s]) / len(known[n] | known[s]) >= threshold}
    rows = spark.createDataFrame([(i, n) for i, n in enumerate(names)] + [(9999, names[0])], "id int, name string")
    found = search.fuzzy_join(rows, "name", spark.createDataFrame([(s,) for s in searches], "wish string"), "wish", threshold)
    assert found.columns == ["id", "name", "search", "similarity"]
    got = [(r.name, r.search) for r in found.filter("id < 9999").collect()]
    assert set(got) == wanted and len(got) == sum(names.count(n) for n, _ in wanted)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = found._jdf.queryExecution().explainString(mode)
    assert "CartesianProduct" not in text and "NestedLoop" not in text
