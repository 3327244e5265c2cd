import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tributary.operators import search, text_index
from tributary.storage import run_path

WORDS = [f"w{i}" for i in range(40)]


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(5)
    weights = [1 / (i + 1) for i in range(40)]
    docs = {}
    for i in range(3000):
        n = rng.choice([0, 3, 12, 40]) if i % 50 else 400
        docs[i * 3] = (" ".join(rng.choices(WORDS, weights, k=rng.randint(0, 5))), " ".join(rng.choices(WORDS, weights, k=n)))
    docs[100_000], docs[100_003] = (None, "w1 w2"), ("W1!", "W1, w2 -- w1")
    frame = spark.createDataFrame([(k, a, b, "xy"[k % 2]) for k, (a, b) in docs.items()], "id long, title string, body string, kind string")
    return docs, text_index.build(frame, "title", "body", "id", ["kind"], run_path(spark, "test-index"))


def toks(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def holds(text, words):
    t = toks(text)
    return any(t[i : i + len(words)] == words for i in range(len(t) - len(words) + 1))


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_forms_equal_a_scan(world):
    docs, index = world
    forms = {"a": "w1 w9", "b": '"w1 w2"', "c": "w3 -w1", "d": "w30 or w31 -w2", "e": '"w1 w1 w2" or -w1', "f": "absent", "g": '-"w2 w1" w1', "h": "!!", "i": "-w1"}
    got = {r.id: r for r in text_index.matching(index, forms).collect()}
    assert set(got) == set(docs)
    for name, q in forms.items():
        alternatives = text_index.parsed(q)
        for i, (_, body) in docs.items():
            assert got[i][name] == any(all(holds(body, w) != minus for minus, w in part) for part in alternatives), (name, i)
    assert {r.id for r in text_index.with_phrase(index, ["w1", "w2", "w1"]).collect()} == {i for i, (_, b) in docs.items() if holds(b, ["w1", "w2", "w1"])}


def ranks(docs, words):
    out = {}
    for i, (title, body) in docs.items():
        if all(w in toks(body) for w in words):
            out[i] = sum(t in words for t in toks(title)) * 1.0 + sum(t in words for t in toks(body)) * 0.4
    return out


@pytest.mark.parametrize("words", [["w0"], ["w0", "w7"], ["w20", "w3", "w11"], ["w39"], ["absent", "w1"]])
def test_top_equals_the_full_ranking(world, words):
    docs, index = world
    every = ranks(docs, words)
    assert {r.id: pytest.approx(r["rank"]) for r in text_index.ranked(index, words).collect()} == every
    for k in (1, 10, 5000):
        wanted = sorted(every, key=lambda i: (-every[i], i))[:k]
        assert [r.id for r in text_index.top(index, words, k).collect()] == wanted
    odd = sorted((i for i in every if i % 2), key=lambda i: (-every[i], i))[:7]
    assert [r.id for r in text_index.top(index, words, 7, F.col("kind") == "y").collect()] == odd


def test_a_page_reads_fewer_postings(world):
    docs, index = world
    _, read = text_index.page(index, ["w20"], 3)
    assert 0 < read.count() < 0.5 * index.postings(["w20"]).count()


def test_searches_read_the_buckets_of_their_terms(world):
    _, index = world
    text = plan(text_index.with_phrase(index, ["w1", "w2"]))
    assert "PartitionFilters: [isnotnull(bucket" in text or "PartitionFilters: [bucket" in text
    assert "In(term, [w1,w2])" in text and "title" not in text and "body" not in text
    assert "StringStartsWith(term,w3)" in plan(index.prefixed("w3"))
    assert "positions" not in plan(text_index.ranked(index, ["w1"]))


def test_spans_equal_the_pass_over_the_text(world, spark):
    docs, index = world
    frame = spark.createDataFrame([(i, b) for i, (_, b) in docs.items()], "id long, body string")
    for words in (["w1", "w2"], ["w5", "w0", "w9"]):
        wanted = {r.id: r.span for r in frame.select("id", search.closeness(F.col("body"), words).alias("span")).filter("span is not null").collect()}
        assert {r.id: r.span for r in text_index.spans(index, words).collect()} == wanted


def test_nothing_indexed(spark):
    index = text_index.build(spark.createDataFrame([], "id long, title string, body string"), "title", "body", "id", [], run_path(spark, "test-index"))
    assert text_index.matching(index, {"a": "w1"}).count() == text_index.top(index, ["w1"], 3).count() == 0
