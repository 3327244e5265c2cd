import json

import pytest
from pyspark.sql import functions as F

from tributary.operators import cdc
from tributary.sources.scans import MESSAGES

def envelope(op, before=None, after=None, at=1_650_000_000_123, **position):
    """A change of the table depot.parcels as its own compact text."""
    source = {"schema": "depot", "table": "parcels", **position}
    return json.dumps({"before": before, "after": after, "source": source, "op": op, "ts_ms": at}, separators=(",", ":"))


UPDATE = envelope("u", {"id": 731, "place": "hall 4"}, {"id": 731, "place": "van 12"}, lsn=60_417)
SNAPSHOT = envelope("r", after={"id": 15})
DELETE = envelope("d", before={"id": 88}, lsn=60_500)


def parse(spark, *values, **options):
    rows = [("depot-log", 5, 300 + i, v) for i, v in enumerate(values)]
    return cdc.parse_envelopes(spark.createDataFrame(rows, MESSAGES), **options)


def test_update_keeps_images_as_compact_text(spark):
    row = parse(spark, UPDATE).first()
    assert (row["status"], row["source_table"], row["op"], row["lsn"], row["ts_ms"]) == ("ok", "depot.parcels", "u", 60_417, 1_650_000_000_123)
    assert row["before_json"] == '{"id":731,"place":"hall 4"}'
    assert row["after_json"] == '{"id":731,"place":"van 12"}'


def test_snapshot_without_lsn(spark):
    row = parse(spark, SNAPSHOT).withColumn("name", cdc.op_name(F.col("op"))).first()
    assert (row["before_json"], row["lsn"], row["name"]) == (None, 0, "snapshot")


@pytest.mark.parametrize(
    "value, strict, lenient",
    [
        ("{", "malformed", "malformed"),
        ('{"a":1}', "malformed", "malformed"),
        ('{"source":{}}', "malformed", "malformed"),
        ('{"op":"u"}', "malformed", "ok"),
        ("[1]", "malformed", "malformed"),
        (UPDATE[:-1], "malformed", "malformed"),
        ("", "tombstone", "tombstone"),
        ("  ", "tombstone", "tombstone"),
        (None, "tombstone", "tombstone"),
        (UPDATE, "ok", "ok"),
    ],
)
def test_routing(spark, value, strict, lenient):
    assert parse(spark, value, strict=True).first()["status"] == strict
    assert parse(spark, value, strict=False).first()["status"] == lenient


def test_blank_is_malformed_on_request(spark):
    assert parse(spark, " ", blank_is_tombstone=False).first()["status"] == "malformed"


def test_only_whole_envelopes_keep_their_coordinates(spark):
    rows = cdc.flatten(parse(spark, "", SNAPSHOT, '{"op":', None, DELETE)).orderBy("kafka_offset").collect()
    assert [(r["kafka_topic"], r["kafka_partition"], r["kafka_offset"]) for r in rows] == [("depot-log", 5, 301), ("depot-log", 5, 304)]


def test_delete_row_is_the_before_image(spark):
    row = cdc.flatten(parse(spark, DELETE)).first()
    assert row["deleted"] and row["row_json"] == '{"id":88}'


def test_bronze_row_shape(spark):
    create = '{"before":null,"after":{"id":9},"source":{"schema":"s","table":"t","lsn":9},"op":"c","ts_ms":5}'
    bronze = cdc.to_bronze(cdc.flatten(parse(spark, create)), F.timestamp_millis(F.lit(1000)))
    assert bronze.columns == cdc.BRONZE_COLUMNS and len(bronze.columns) == 12
    row = bronze.withColumn("ingest_ts", F.col("ingest_ts").cast("string")).first()
    assert row["before_json"] is None and row["ingest_ts"] == "1970-01-01 00:00:01"


def test_op_names(spark):
    rows = spark.createDataFrame([(c,) for c in "cudrtx"], "op string")
    got = [r[0] for r in rows.select(cdc.op_name(F.col("op"))).collect()]
    assert got == ["create", "update", "delete", "snapshot", "truncate", "x"]
    assert rows.filter("op = 't'").select(cdc.op_name(F.col("op"), with_truncate=False)).first()[0] == "t"


def test_twenty_digit_numbers_survive(spark):
    value = UPDATE.replace('"id":731,"place":"van 12"', '"id":12345678901234567890')
    assert json.loads(parse(spark, value).first()["after_json"])["id"] == 12345678901234567890


def test_state_ignores_order_and_redelivery(spark):
    def event(lsn, op, status):
        image = json.dumps({"id": 1, "status": status})
        before, after = (image, "null") if op == "d" else ("null", image)
        return f'{{"before":{before},"after":{after},"source":{{"schema":"p","table":"o","lsn":{lsn}}},"op":"{op}","ts_ms":{lsn}}}'

    log = [event(3, "u", "B"), event(1, "c", "A"), event(3, "u", "B"), event(5, "d", "B"), event(4, "u", "C")]
    bronze = cdc.to_bronze(cdc.flatten(parse(spark, *log)))
    assert cdc.current_state(bronze).count() == 0
    assert json.loads(cdc.as_of_state(bronze, lsn=4).first()["row_json"])["status"] == "C"
    changes = cdc.status_changes(cdc.status_events(bronze), hot_rows=0, slices=3).orderBy("lsn").collect()
    assert [(r["old_status"], r["new_status"]) for r in changes] == [("A", "B"), ("B", "C"), ("C", None)]


def parcel(op, lsn, **row):
    return envelope(op, **{"before" if op == "d" else "after": row}, lsn=lsn)


def test_text_keys_and_large_numbers_are_keys(spark):
    large = "12345678901234567890"
    log = [parcel("c", 1, id="p-9", status="A"), parcel("u", 2, id="p-9", status="B"), parcel("c", 3, id=int(large), status="C")]
    log += [parcel("c", 4, id="p-4", status="D"), parcel("d", 5, id="p-4"), parcel("c", 6, id=None), parcel("c", 7, place="x")]
    bronze = cdc.to_bronze(cdc.flatten(parse(spark, *log)))
    state = {r["id"]: json.loads(r["row_json"])["status"] for r in cdc.current_state(bronze).collect()}
    assert state == {"p-9": "B", large: "C"}
    assert [r["lsn"] for r in cdc.key_history(bronze, "p-9").collect()] == [2, 1]
    assert {r["id"] for r in cdc.states_at(bronze, [4]).collect()} == {"p-9", large, "p-4"}
    assert [tuple(r) for r in cdc.keyless_counts(bronze).collect()] == [("depot.parcels", "c", 2)]
    changes = cdc.status_changes(cdc.status_events(bronze)).orderBy("lsn").collect()
    assert [(r["id"], r["old_status"], r["new_status"]) for r in changes] == [("p-9", "A", "B"), ("p-4", "D", None)]


def test_keys_of_several_fields(spark):
    fields = ["hall", "no"]
    log = [parcel("c", 1, hall="a", no=1, s=1), parcel("c", 2, hall="a", no=2, s=2), parcel("u", 3, hall="a", no=1, s=3), parcel("c", 4, hall="b")]
    bronze = cdc.to_bronze(cdc.flatten(parse(spark, *log)))
    state = {r["id"]: r["lsn"] for r in cdc.current_state(bronze, fields).collect()}
    assert state == {'["a","1"]': 3, '["a","2"]': 2}
    assert [r["lsn"] for r in cdc.key_history(bronze, ["a", 1], key_fields=fields).collect()] == [3, 1]
    assert cdc.keyless_counts(bronze, fields).first()["count"] == 1


def test_reconcile_reports_every_kind(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (2, "z"), (4, "w"), (3, None)], "id int, v string")
    got = {r["id"]: r["verdict"] for r in cdc.reconcile(a, b, "id", ["v"]).collect()}
    assert got == {1: "same", 2: "differs", 3: "same", 4: "right_only"}


def test_truncate_empties_its_table(spark):
    """What came before goes, a row written afterwards stays, other tables are left alone."""
    other = '{"before":null,"after":{"id":1},"source":{"schema":"depot","table":"vans","lsn":1},"op":"c","ts_ms":1}'
    values = [
        envelope("c", after={"id": 1}, lsn=10), envelope("c", after={"id": 2}, lsn=11), envelope("t", lsn=20), envelope("c", after={"id": 2}, lsn=30),
        envelope("u", after={"id": 1}, lsn=5), envelope("c", after={"id": 3}, lsn=20), other,
    ]
    bronze = cdc.to_bronze(cdc.flatten(parse(spark, *values)))
    state = {(r.source_table, r.id) for r in cdc.current_state(bronze).collect()}
    assert state == {("depot.parcels", "2"), ("depot.parcels", "3"), ("depot.vans", "1")}
    assert {r.id for r in cdc.as_of_state(bronze, lsn=15).filter("source_table = 'depot.parcels'").collect()} == {"1", "2"}
    at = {(r["at"], r.source_table, r.id) for r in cdc.states_at(bronze, [15, 25, 30]).collect()}
    vans = {(n, "depot.vans", "1") for n in (15, 25, 30)}
    assert at == vans | {(15, "depot.parcels", "1"), (15, "depot.parcels", "2"), (25, "depot.parcels", "3"), (30, "depot.parcels", "2"), (30, "depot.parcels", "3")}
