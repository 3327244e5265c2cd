import base64
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tributary.functions import roaring
from tributary.storage import run_path
from tributary.operators import bitmaps, segments
from tributary.operators.segments import Segment, tag


def nested_segment(number, tags, leaves):
    """Segment ``number``: consecutive tags split in uneven halves, the operators taken in turn."""

    def over(low, high, step):
        if high - low == 1:
            return tag((number * 7 + low * 4) % tags + 1)
        middle = low + 1 + (number + step) % (high - low - 1) if high - low > 2 else low + 1
        left, right = over(low, middle, step + 1), over(middle, high, step + 2)
        return (left & right, left | right, left - right)[(number + step) % 3]

    return over(0, leaves, 0)


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(42)
    members = {n: {i for i in range(5000) if rng.random() < 1 / 3} for n in range(1, 16)}
    rows = [(1, i, n, 1) for n, ids in members.items() for i in ids]
    df = spark.createDataFrame(rows, "attribute_id int, actor_id bigint, tag_id int, latest_signal int")
    trees = {i: nested_segment(i, 15, 10) for i in range(50)}
    sets = {"and": set.__and__, "or": set.__or__, "and_not": set.__sub__}
    return df, trees, {i: t.fold(members.get, sets) for i, t in trees.items()}


def as_sets(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["segment_id"], set()).add(r["actor_id"])
    return out


def test_random_trees_equal_set_algebra_on_every_path(world):
    df, trees, expected = world
    expected = {i: s for i, s in expected.items() if s}
    words = segments.evaluate(segments.tag_bitmaps(df), trees)
    assert as_sets(bitmaps.members(words, ["segment_id"])) == expected
    assert as_sets(bitmaps.members(segments.evaluate_members(df, trees), ["segment_id"])) == expected
    assert as_sets(segments.evaluate_rows(df, trees)) == expected


def test_few_segments_equal_many(world):
    df, trees, expected = world
    few = {i: trees[i] for i in (3, 17, 41)}
    expected = {i: expected[i] for i in few if expected[i]}
    assert as_sets(bitmaps.members(segments.evaluate(segments.tag_bitmaps(df), few), ["segment_id"])) == expected
    assert as_sets(bitmaps.members(segments.evaluate_members(df, few), ["segment_id"])) == expected


def test_words_that_are_not_merged_give_the_same_answers(spark):
    words = spark.createDataFrame([(1, 0, 1), (1, 0, 2), (1, 0, 2), (2, 0, 4)], "tag_id int, word_no bigint, bits bigint")
    for n in (1, 100):
        found = segments.evaluate(words, {i: Segment("or", tag(1), tag(2)) for i in range(n)}).collect()
        assert sorted(r["segment_id"] for r in found) == list(range(n)) and {r["bits"] for r in found} == {7}
    assert {r["tag_id"]: r["members"] for r in bitmaps.cardinality(words, ["tag_id"]).collect()} == {1: 2, 2: 1}
    probes = spark.createDataFrame([(1, 1)], "tag_id int, actor_id bigint")
    assert [r["found"] for r in bitmaps.contains(words, probes, ["tag_id"], "actor_id").collect()] == [True]
    assert sorted((r["tag_id"], r["actor_id"]) for r in bitmaps.members(words, ["tag_id"]).collect()) == [(1, 0), (1, 1), (2, 2)]
    requests = spark.createDataFrame([(1, 0)], "tag_id int, cursor bigint")
    assert sorted(r["actor_id"] for r in bitmaps.pages(words, requests, ["tag_id"], 5).collect()) == [0, 1]


def test_each_tag_is_used_once():
    tree = nested_segment(1, 15, 10)
    assert len(tree.tags()) == len(set(tree.tags())) == 10


def test_pages_and_contains(spark):
    ids = [0, 1, 63, 64, 127, 4294967295] + list(range(1000, 3000))
    words = bitmaps.bitmap_agg(spark.createDataFrame([(1, i) for i in ids], "s int, actor_id bigint"), ["s"], "actor_id")
    requests = spark.createDataFrame([(1, c) for c in (0, 63, 64, 128, 4294967295)], "s int, cursor bigint")
    got = {}
    for r in bitmaps.pages(words, requests, ["s"], 1000).collect():
        got.setdefault(r["cursor"], []).append(r["actor_id"])
    for cursor in (0, 63, 64, 128, 4294967295):
        assert sorted(got[cursor]) == sorted(i for i in ids if i >= cursor)[:1000]
    probes = spark.createDataFrame([(1, 63), (1, 62), (2, 63), (1, 4294967295)], "s int, actor_id bigint")
    found = {(r["s"], r["actor_id"]): r["found"] for r in bitmaps.contains(words, probes, ["s"], "actor_id").collect()}
    assert found == {(1, 63): True, (1, 62): False, (2, 63): False, (1, 4294967295): True}


def test_wide_ids_are_refused(spark):
    rows = spark.createDataFrame([(1, 4294967296)], "s int, actor_id bigint")
    with pytest.raises(Exception, match="does not fit 32 bits"):
        bitmaps.bitmap_agg(rows, ["s"], "actor_id").collect()


def test_store_vectors():
    assert roaring.decode_store(base64.b64decode("AQcAAAA=")).tolist() == [7]
    two = bytes([10, 2, 0, 0, 0]) + (1).to_bytes(8, "little") + (2).to_bytes(8, "little")
    assert roaring.decode_store(two).tolist() == [1, 2]
    assert roaring.decode_store(b"").tolist() == roaring.decode_store(b"\0").tolist() == []
    for bad in (bytes([4]), bytes([77]), two[:-1], bytes([3]) + (1 << 32).to_bytes(8, "little")):
        with pytest.raises(ValueError):
            roaring.decode_store(bad)


@pytest.mark.parametrize(
    "ids",
    [
        [0],
        [4294967295],
        list(range(0, 20000, 2)),
        list(range(70000)),
        list(range(4096)),
        list(range(0, 2 * 4097, 2)),
        [5, 65536 + 7, 3 * 65536, 9 * 65536 + 1, 10 * 65536 + 65535],
        list(range(100, 60000)) + [200000, 300000, 400001],
        sorted(random.Random(3).sample(range(1 << 22), 60000)),
    ],
)
def test_portable_round_trip(ids):
    values = np.array(ids, dtype=np.int64)
    keys = np.unique(values >> 16)
    parts = [roaring.encode_container((values[values >> 16 == k] & 0xFFFF)) for k in keys]
    sizes = [int((values >> 16 == k).sum()) for k in keys]
    blob = roaring.assemble(keys.tolist(), sizes, [p[0] for p in parts], [p[1] for p in parts])
    assert roaring.decode(blob).tolist() == ids


def test_known_portable_bytes():
    """{1, 2, 3, 100}: no run container pays off, so the plain cookie is used."""
    run, payload = roaring.encode_container(np.array([1, 2, 3, 100]))
    blob = roaring.assemble([0], [4], [run], [payload])
    assert blob.hex() == "3a300000" "01000000" "0000" "0300" "10000000" "0100020003006400"


def test_export_equals_members(spark):
    ids = list(range(0, 200000, 3)) + list(range(300000, 300500))
    words = bitmaps.bitmap_agg(spark.createDataFrame([(1, i) for i in ids], "s int, actor_id bigint"), ["s"], "actor_id")
    blobs = roaring.export_bitmaps(words, "s")
    assert blobs.first()["members"] == len(ids)
    store = blobs.select("s", F.concat(F.unhex(F.lit("02")), "data").alias("data"))
    back = roaring.import_bitmaps(store, "s", "data")
    assert sorted(r["member"] for r in back.collect()) == ids


@pytest.mark.parametrize("size, chunks", [(20_000_001, 3), (6_300_000, 1), (0, 1), (8_000_000, 1), (8_000_001, 2)])
def test_blob_chunks(spark, size, chunks):
    blob = spark.range(1).select(F.lit("a").alias("name"), F.expr(f"CAST(repeat('x', {size}) AS BINARY)").alias("data"))
    cut = segments.split_blobs(blob, "name", "data", 8_000_000)
    assert cut.count() == chunks
    whole = segments.join_blobs(cut, "name").select(F.length("data").alias("n"), F.md5("data").alias("h")).first()
    assert (whole["n"], whole["h"]) == tuple(blob.select(F.length("data"), F.md5("data")).first())


def test_missing_chunk_is_noticed(spark):
    blob = spark.range(1).select(F.lit("a").alias("name"), F.expr("CAST(repeat('x', 10) AS BINARY)").alias("data"))
    cut = segments.split_blobs(blob, "name", "data", 4).filter("chunk <> 1")
    assert segments.join_blobs(cut, "name").first()["data"] is None


def test_estimate_matches_formula(spark):
    rows = [(1, i, 1, 1) for i in range(0, 100)] + [(1, i, 2, 1) for i in range(50, 200)]
    df = spark.createDataFrame(rows, "attribute_id int, actor_id bigint, tag_id int, latest_signal int")
    got = {r["segment_id"]: r["share"] for r in segments.estimate(segments.tag_bitmaps(df), {1: tag(1) & tag(2), 2: tag(1) | tag(2), 3: tag(1) - tag(2)}).collect()}
    assert got == pytest.approx({1: 0.375, 2: 1 - 0.5 * 0.25, 3: 0.125})


def test_replacement_by_nothing_clears_the_tag(spark):
    path = run_path(spark, "tags")
    words = spark.createDataFrame([(1, 0, 1), (2, 0, 6), (2, 5, 1)], "tag_id int, word_no int, bits bigint")
    words.write.partitionBy("tag_id").parquet(path)
    segments.replace_tag(words.filter("tag_id <> 2"), path, 2)
    assert {r["tag_id"]: r["n"] for r in spark.read.parquet(path).groupBy("tag_id").agg(F.count("*").alias("n")).collect()} == {1: 1}
    segments.replace_tag(words, path, 2)
    assert spark.read.parquet(path).filter("tag_id = 2").count() == 2


def test_empty_and_missing_blobs_round_trip(spark):
    blobs = spark.createDataFrame([("a", b""), ("b", b"12345678"), ("c", b"123456789")], "name string, data binary")
    cut = segments.split_blobs(blobs, "name", "data", 4)
    assert {(r["name"], r["chunk"], bytes(r["data"])) for r in cut.collect()} == {
        ("a", 0, b""), ("b", 0, b"1234"), ("b", 1, b"5678"), ("c", 0, b"1234"), ("c", 1, b"5678"), ("c", 2, b"9"),
    }
    assert {(r["name"], bytes(r["data"])) for r in segments.join_blobs(cut, "name").collect()} == {("a", b""), ("b", b"12345678"), ("c", b"123456789")}


def stored_sets(spark, rows):
    from tributary.operators import stored
    from tributary.storage import run_path

    words = bitmaps.bitmap_agg(spark.createDataFrame(rows, "s int, actor_id bigint"), ["s"], "actor_id")
    halves = words.unionAll(words)  # words need not be merged
    return stored.store(halves, ["s"], run_path(spark, "test-sets"))


def test_stored_sets_answer_like_python_sets(spark):
    from tributary.operators import stored

    rng = random.Random(11)
    dense, sparse = set(rng.sample(range(60_000), 30_000)), {rng.randrange(2**32) for _ in range(3000)} | {0, 2**32 - 1}
    edges = {63, 64, 2047, 2048, 2048 * 256 - 1, 2048 * 256, 2048 * 256 * 5}
    sets = {1: dense, 2: sparse, 3: edges, 4: {2**31}}
    stored_ = stored_sets(spark, [(s, i) for s, ids in sets.items() for i in ids])
    assert {r.s: r.members for r in stored.cardinality(stored_).collect()} == {s: len(ids) for s, ids in sets.items()}
    found = defaultdict(set)
    for r in stored.members(stored_).collect():
        assert r.actor_id not in found[r.s]
        found[r.s].add(r.actor_id)
    assert found == sets
    assert {r.actor_id for r in stored.members(stored_, where=F.col("s") == 3).collect()} == edges
    probes = [(s, i) for s in (1, 2, 3, 4, 9, None) for i in [*rng.sample(range(70_000), 60), *rng.sample(sorted(sparse), 60), *edges, -1, -64, 2**32 - 1, 2**40, None]] + [(1, 5)] * 3
    frame = spark.createDataFrame(probes, "s int, actor_id bigint")
    got = stored.contains(stored_, frame, "actor_id").collect()
    assert len(got) == len(probes) and all(r.found == (r.actor_id in sets.get(r.s, ())) for r in got)
    cursors = [(s, c) for s in (1, 2, 3, 4, 9) for c in (-5, 0, 1, 63, 64, 2048, 59_999, 2048 * 256, 2**31, 2**31 + 1, 2**32 - 1, 2**32, 2**33)]
    for size in (1, 7, 1000):
        pages = defaultdict(list)
        for r in stored.pages(stored_, spark.createDataFrame(cursors + cursors[:3], "s int, cursor bigint"), size).collect():
            pages[r.s, r.cursor].append(r.actor_id)
        for s, c in cursors:
            assert sorted(pages[s, c]) == sorted(i for i in sets.get(s, ()) if i >= c)[:size], (s, c, size)
    for s, c in cursors[::5]:
        assert [r.actor_id for r in stored.read_page(stored_, {"s": s}, c, 9).collect()] == sorted(i for i in sets.get(s, ()) if i >= c)[:9]
    some = [*list(edges), 5, -1, 70_001]
    assert {r.actor_id for r in stored.read_contains(stored_, {"s": 3}, some).collect()} == edges


def test_reads_of_stored_sets_skip_what_they_do_not_need(spark):
    from tributary.operators import stored

    sets = stored_sets(spark, [(s, 4096 * i) for s in range(20) for i in range(500)])
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = lambda df: df._jdf.queryExecution().explainString(mode)
    point = text(stored.read_contains(sets, {"s": 3}, [4096]))
    assert "EqualTo(s,3)" in point and ("In(block, [2])" in point or "EqualTo(block,2)" in point) and "Exchange" not in point
    page = text(stored.read_page(sets, {"s": 3}, 4096, 5))
    assert "EqualTo(s,3)" in page and "GreaterThanOrEqual(block,2)" in page and "LessThanOrEqual(region" in page
    counts = stored.needed_blocks(sets, spark.createDataFrame([(3, 0)], "s int, cursor bigint"), 5)
    assert "bits" not in text(counts)
    assert counts.count() <= 6  # of 500 blocks
    assert "bits" not in text(stored.cardinality(sets)) and "Exchange" not in text(stored.members(sets))
