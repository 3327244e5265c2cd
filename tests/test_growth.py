"""What must not grow with the input: memory and reads of one task, batches, intermediate files."""

import os
import re
import time

import pyarrow as pa
import pyarrow.parquet as pq

from tributary.operators import cdc, search, text_index
from tributary.plans import QUERIES, stream_queries
from tributary.storage import run_path, write_and_read


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_approximate_counts_keep_one_sketch_per_task(spark, tmp_path):
    keys = [None, None, 5, 5, *range(300)]
    spark.createDataFrame([(k,) for k in keys], "l_partkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    counts = QUERIES["agg_08_approx_distinct"](spark, str(tmp_path))
    assert counts.collect() == [(300, True)]
    text = plan(counts)
    keys_of_sketches = re.findall(r"Keys(?: \[\d+\])?: \[([^\]]*)\]\s*\nFunctions[^\n]*approx_count_distinct", text)
    assert keys_of_sketches and not any(keys_of_sketches)


BRONZE = "source_table string, op string, deleted boolean, source_ts_ms long, lsn long, kafka_offset long, row_json string"


def test_truncates_do_not_deal_out_events_by_table(spark):
    events = [("s.a", "c", False, i, i, i, f'{{"id":{i % 40}}}') for i in range(60)]
    events += [("s.a", "t", False, 50, 50, 50, None), (None, "c", False, 1, 1, 1, '{"id":1}'), ("s.b", "c", False, 1, 1, 1, '{"id":1}')]
    bronze = spark.createDataFrame(events, BRONZE)
    wide = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        state, states = cdc.current_state(bronze), cdc.states_at(bronze, [40, 70])
        for df in (state, states):
            assert "SortMergeJoin" not in plan(df) and "ShuffledHashJoin" not in plan(df)
        assert {(r.source_table, r.id) for r in state.collect()} == {("s.a", str(i % 40)) for i in range(51, 60)} | {(None, "1"), ("s.b", "1")}
        assert states.filter("at = 40").count() == 42 and states.filter("at = 70").count() == 11
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", wide)


def test_words_are_grouped_a_bounded_number_at_a_time(monkeypatch):
    texts = [["a", "b", "a"], [], None, ["c"] * 25, ["a"] * 4, ["b", "a"] * 3, ["d"], []]
    batch = pa.RecordBatch.from_pydict({"id": range(8), "words": pa.array(texts, pa.list_(pa.string()))})
    whole = search._group_positions(batch).to_pylist()
    assert sorted((r["id"], r["term"], r["positions"]) for r in whole)[:2] == [(0, "a", [1, 3]), (0, "b", [2])]
    monkeypatch.setattr(search, "WORDS_AT_ONCE", 10)
    for one in (batch, batch.slice(1, 6)):
        pieces = list(search._pieces(one))
        assert [i for p in pieces for i in p.column("id").to_pylist()] == one.column("id").to_pylist()
        assert all(p.num_rows == 1 or sum(map(len, filter(None, p.column("words").to_pylist()))) <= 10 for p in pieces)
        rows = [r for p in pieces for r in search._group_positions(p).to_pylist()]
        assert sorted(rows, key=str) == sorted((r for r in whole if r["id"] in one.column("id").to_pylist()), key=str)


def test_an_index_reads_the_texts_once(spark, tmp_path):
    read = f"{tmp_path}/read"
    os.mkdir(read)

    def group(batches):
        for batch in batches:
            with open(f"{read}/{os.urandom(8).hex()}", "w") as f:
                f.write(str(batch.num_rows))
            yield batch

    docs = spark.createDataFrame([(i, f"t{i % 7}", f"the w{i % 11} the") for i in range(500)], "id long, title string, body string")
    once = docs.mapInArrow(group, docs.schema)
    index = text_index.build(once, "title", "body", "id", [], run_path(spark, "test-once"))
    # once for the postings and once for the table of documents
    assert sum(int(open(f"{read}/{f}").read()) for f in os.listdir(read)) == 1000
    assert index.postings(["the"]).count() == 500 and index._table("postings").count() == 1500
    assert sorted((r.block, r.most, r.docs) for r in index.bounds(["the"]).collect()) == [(0, 2, 128), (1, 2, 128), (2, 2, 128), (3, 2, 116)]


def test_files_of_messages_can_be_split(spark, tables, monkeypatch):
    monkeypatch.setattr(stream_queries, "ROW_GROUP", 1 << 16, raising=False)
    path = stream_queries.message_files(tables)
    assert min(pq.ParquetFile(f"{path}/{f}").num_row_groups for f in os.listdir(path) if f.endswith(".parquet")) > 1


def test_shuffles_of_a_written_table_are_dropped(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return set(re.findall(r"shuffle_\d+_\d+_0\.data", disk.getAllFiles().mkString(",")))

    rows = spark.range(1000).selectExpr("id % 10 AS k", "id").groupBy("k").count()
    before = shuffles()
    kept = write_and_read(rows, "test-dropped")
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before
    assert kept.count() == rows.count() == rows.count() == 10
