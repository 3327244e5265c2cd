"""Audience segmentation queries over the derived membership table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions import roaring
from tributary.operators import bitmaps, segments, stored
from tributary.operators.segments import Segment, tag
from tributary.plans.derived import signal_log
from tributary.plans.registry import query
from tributary.plans.sql import with_
from tributary.storage import run_path, write_and_read
from tributary.tables import Tables

T = {n: tag(n) for n in [*range(1, 21), 99]}

SEGMENTS: dict[int, Segment] = {
    1: T[1],
    2: T[1] & T[2],
    3: T[1] | T[2],
    4: T[1] - T[2],
    5: (T[1] & T[2]) | T[3],
    6: (T[1] | T[2]) - T[3],
    7: ((T[1] | T[2]) & (T[3] | T[4])) - T[5],
    8: T[1] - (T[2] | T[3]),
    9: (T[1] - T[2]) | (T[3] - T[4]),
    10: ((T[11] | T[12]) & (T[13] | T[14])) | ((T[15] & T[16]) | ((T[17] - T[18]) & (T[19] | T[20]))),
    11: T[1] & T[99],
    12: T[99] | T[1],
}

SQL_FLAGS = {"and": "({} AND {})".format, "or": "({} OR {})".format, "and_not": "({} AND NOT {})".format}
SQL_CHANCE = {"and": "({} * {})".format, "or": "(1 - (1 - {}) * (1 - {}))".format, "and_not": "({} * (1 - {}))".format}
TAGS = sorted({n for s in SEGMENTS.values() for n in s.tags()})


def members_sql() -> str:
    """Row semantics: one flag per tag and actor."""
    flags = ", ".join(f"bool_or(tag_id = {n}) AS t{n}" for n in TAGS)
    hits = " UNION ALL ".join(
        f"SELECT {i} AS segment_id, actor_id FROM flags WHERE {s.fold('t{}'.format, SQL_FLAGS)}" for i, s in SEGMENTS.items()
    )
    return f"flags AS (SELECT actor_id, {flags} FROM active GROUP BY actor_id), members AS ({hits})"


def on_members(body: str) -> str:
    return with_("active", "").rstrip() + f",\n{members_sql()}\n{body}"


WORDS_SQL = """CAST(CASE WHEN b >= 9223372036854775808 THEN b - 18446744073709551616 ELSE b END AS BIGINT)"""


def membership(t: Tables) -> DataFrame:
    return segments.most_recent_signal(signal_log(t))


def tag_words(t: Tables) -> DataFrame:
    return segments.tag_bitmaps(membership(t))


def segment_words(t: Tables) -> DataFrame:
    return segments.evaluate_members(membership(t), SEGMENTS)


def stored_segments(t: Tables) -> stored.StoredSets:
    return stored.store(segment_words(t), ["segment_id"], run_path(t.spark, "stored-segments"))


@query("seg_01_most_recent_signal", with_("membership", "SELECT * FROM membership"))
def most_recent_signal(t: Tables) -> DataFrame:
    return membership(t)


@query("prj_13_active_members", with_("membership", "SELECT tag_id, actor_id FROM membership WHERE attribute_id = 2 AND latest_signal = 1"))
def active_members(t: Tables) -> DataFrame:
    return segments.active(membership(t)).filter(F.col("attribute_id") == 2).select("tag_id", "actor_id")


@query(
    "seg_02_tag_bitmaps",
    with_(
        "active",
        f"""SELECT tag_id, word_no, {WORDS_SQL} AS bits FROM (SELECT tag_id, actor_id // 64 AS word_no,
        sum(CAST(1 AS HUGEINT) << CAST(actor_id % 64 AS INTEGER)) AS b FROM active GROUP BY 1, 2)""",
    ),
)
def tag_bitmaps(t: Tables) -> DataFrame:
    return tag_words(t)


@query("seg_03_tag_members", with_("active", "SELECT actor_id FROM active WHERE tag_id = 1"))
def tag_members(t: Tables) -> DataFrame:
    return segments.active(membership(t)).filter(F.col("tag_id") == 1).select("actor_id")


@query("seg_04_replace_tag", with_("active", "SELECT tag_id, count(*) AS members FROM active GROUP BY 1"))
def replace_tag(t: Tables) -> DataFrame:
    """Store all tags, then replace one of them twice."""
    path = run_path(t.spark, "tag-bitmaps")
    words = write_and_read(tag_words(t), "tag-words")
    words.repartition("tag_id", F.shiftright("word_no", 14)).write.partitionBy("tag_id").parquet(path)
    for _ in range(2):
        segments.replace_tag(words, path, 7)
    return bitmaps.cardinality(t.spark.read.parquet(path), ["tag_id"])


@query(
    "seg_05_union_bitmaps",
    with_(
        "active",
        f"""SELECT attribute_id, word_no, {WORDS_SQL} AS bits FROM (SELECT attribute_id, actor_id // 64 AS word_no,
        sum(CAST(1 AS HUGEINT) << CAST(actor_id % 64 AS INTEGER)) AS b
        FROM (SELECT DISTINCT (tag_id - 1) // 5 + 1 AS attribute_id, actor_id FROM active) GROUP BY 1, 2)""",
    ),
)
def union_bitmaps(t: Tables) -> DataFrame:
    """Tag bitmaps merged into one bitmap per attribute."""
    attribute = (F.floor((F.col("tag_id") - 1) / 5) + 1).cast("int")
    return bitmaps.bitmap_union(tag_words(t).withColumn("attribute_id", attribute), ["attribute_id"])


@query("seg_06_one_expression", on_members("SELECT actor_id FROM members WHERE segment_id = 10"))
def one_expression(t: Tables) -> DataFrame:
    words = segments.evaluate(tag_words(t), {10: SEGMENTS[10]})
    return bitmaps.members(words, ["segment_id"]).select("actor_id")


@query("seg_07_row_algebra", on_members("SELECT segment_id, actor_id FROM members"))
def row_algebra(t: Tables) -> DataFrame:
    return segments.evaluate_rows(membership(t), SEGMENTS)


@query(
    "seg_08_many_segments",
    on_members(
        f"""SELECT segment_id, word_no, {WORDS_SQL} AS bits FROM (SELECT segment_id, actor_id // 64 AS word_no,
        sum(CAST(1 AS HUGEINT) << CAST(actor_id % 64 AS INTEGER)) AS b FROM members GROUP BY 1, 2)"""
    ),
)
def many_segments(t: Tables) -> DataFrame:
    return segments.evaluate(tag_words(t), SEGMENTS)


@query("seg_09_cardinality", on_members("SELECT segment_id, count(*) AS members FROM members GROUP BY 1"))
def cardinality(t: Tables) -> DataFrame:
    return stored.cardinality(stored_segments(t))


@query(
    "seg_10_contains",
    on_members(
        """SELECT p.segment_id, p.actor_id, m.actor_id IS NOT NULL AS found
        FROM (SELECT CAST(1 + o_orderkey % 13 AS INTEGER) AS segment_id, o_orderkey AS actor_id FROM orders) p
        LEFT JOIN members m ON m.segment_id = p.segment_id AND m.actor_id = p.actor_id"""
    ),
)
def contains(t: Tables) -> DataFrame:
    """One probe per order; segment 13 does not exist."""
    probes = t.orders.select((F.col("o_orderkey") % 13 + 1).cast("int").alias("segment_id"), F.col("o_orderkey").alias("actor_id"))
    return stored.contains(stored_segments(t), probes, "actor_id")


READS = [(1, 0), (3, 64), (5, 5000), (7, 4000), (10, 1), (11, 0), (12, 4_000_000_000)]


@query(
    "seg_12_point_reads",
    on_members(
        f"""SELECT segment_id, "cursor", actor_id FROM (SELECT m.segment_id, c AS "cursor", actor_id, row_number() OVER (PARTITION BY m.segment_id ORDER BY actor_id) AS rn FROM members m
        JOIN (VALUES {", ".join(f"({s}, CAST({c} AS BIGINT))" for s, c in READS)}) x(s, c) ON s = m.segment_id AND actor_id >= c) WHERE rn <= 100"""
    ),
)
def point_reads(t: Tables) -> DataFrame:
    """One page of one segment at a time: a read touches the row groups of its blocks only."""
    sets = stored_segments(t)
    one = lambda s, c: stored.read_page(sets, {"segment_id": s}, c, 100).select(F.lit(s).alias("segment_id"), F.lit(c).cast("bigint").alias("cursor"), "actor_id")
    return reduce(DataFrame.unionByName, [one(s, c) for s, c in READS])


@query("seg_11_all_members", on_members("SELECT segment_id, actor_id FROM members"))
def all_members(t: Tables) -> DataFrame:
    return stored.members(stored_segments(t))


@query(
    "seg_12_pages",
    on_members(
        """SELECT segment_id, "cursor", actor_id FROM (SELECT segment_id, c AS "cursor", actor_id,
        row_number() OVER (PARTITION BY segment_id, c ORDER BY actor_id) AS rn FROM members
        JOIN (VALUES (CAST(0 AS BIGINT)), (63), (64), (5000), (4000000000)) x(c) ON actor_id >= c) WHERE rn <= 1000"""
    ),
)
def pages(t: Tables) -> DataFrame:
    """Five cursors per segment; the last one lies past the end."""
    cursors = F.array(*[F.lit(c).cast("bigint") for c in (0, 63, 64, 5000, 4_000_000_000)])
    ids = F.array(*map(F.lit, SEGMENTS))
    requests = t.spark.range(1).select(F.explode(ids).alias("segment_id")).select("segment_id", F.explode(cursors).alias("cursor"))
    return stored.pages(stored_segments(t), requests)


def _estimate_sql() -> str:
    sizes = ", ".join(f"CAST(count(*) FILTER (WHERE tag_id = {n}) AS DOUBLE) AS n{n}" for n in TAGS)
    rows = " UNION ALL ".join(
        f"SELECT {i} AS segment_id, {s.fold('(n{} / universe)'.format, SQL_CHANCE)} AS share, universe FROM sizes" for i, s in SEGMENTS.items()
    )
    return with_("active", "").rstrip() + (
        f",\nsizes AS (SELECT CAST(count(DISTINCT actor_id) AS DOUBLE) AS universe, {sizes} FROM active)\n"
        f"SELECT segment_id, share, share * universe AS expected FROM ({rows})"
    )


@query("seg_13_size_estimate", _estimate_sql())
def size_estimate(t: Tables) -> DataFrame:
    return segments.estimate(tag_words(t), SEGMENTS)


@query("seg_14_export_roaring", on_members("SELECT segment_id, actor_id AS member FROM members"))
def export_roaring(t: Tables) -> DataFrame:
    """Export every segment as one binary and read the binaries back."""
    blobs = roaring.export_bitmaps(segment_words(t), "segment_id")
    return roaring.import_bitmaps(blobs, "segment_id", "data", store_encoding=False).select("segment_id", "member")


def little_endian(value: Column, size: int) -> Column:
    digits = F.lpad(F.hex(value), 2 * size, "0")
    return F.concat(*[F.unhex(F.substring(digits, 2 * i + 1, 2)) for i in reversed(range(size))])


@query(
    "seg_15_import_store_bitmaps",
    """SELECT k AS blob_id, member, error FROM (SELECT o_orderkey AS k, o_custkey AS cu FROM orders) o JOIN LATERAL (
    SELECT k AS member, NULL AS error WHERE k % 7 IN (1, 2, 3) UNION ALL
    SELECT DISTINCT m, NULL FROM (VALUES (k), (cu)) v(m) WHERE k % 7 = 4 UNION ALL
    SELECT NULL, 'unsupported type 4' WHERE k % 7 = 5 UNION ALL
    SELECT NULL, 'value does not fit 32 bits' WHERE k % 7 = 6) x ON true""",
)
def import_store_bitmaps(t: Tables) -> DataFrame:
    """One store-encoded, base64 bitmap per order, of every type byte."""
    k, cu = F.col("o_orderkey"), F.col("o_custkey")
    byte = lambda n: F.unhex(F.lit(f"{n:02X}"))
    blob = (
        F.when(k % 7 == 0, byte(roaring.EMPTY))
        .when(k % 7 == 1, F.concat(byte(roaring.SINGLE32), little_endian(k, 4)))
        .when(k % 7 == 2, F.concat(byte(roaring.SINGLE64), little_endian(k, 8)))
        .when(k % 7 == 3, F.concat(byte(roaring.SET), little_endian(F.lit(1), 4), little_endian(k, 8)))
        .when(k % 7 == 4, F.concat(byte(roaring.SET), little_endian(F.lit(2), 4), little_endian(k, 8), little_endian(cu, 8)))
        .when(k % 7 == 5, byte(roaring.BITMAP64))
        .otherwise(F.concat(byte(roaring.SINGLE64), little_endian(k + bitmaps.MAX_ID + 1, 8)))
    )
    encoded = t.orders.select(k.alias("blob_id"), F.base64(blob).alias("text"))
    return roaring.import_bitmaps(encoded.select("blob_id", F.unbase64("text").alias("data")), "blob_id", "data")


CHUNKS = """SELECT doc_id, c AS chunk, n, substr(h, 2000 * c + 1, 2000) AS part FROM (SELECT doc_id, hex(encode(text)) AS h,
CAST(greatest((length(hex(encode(text))) + 1999) // 2000, 1) AS INTEGER) AS n FROM documents), LATERAL (SELECT CAST(unnest(range(n)) AS INTEGER) AS c)"""


@query("seg_16_split_blobs", f"SELECT doc_id, chunk, n, CAST(length(part) // 2 AS INTEGER) AS bytes, md5(part) AS digest FROM ({CHUNKS})")
def split_blobs(t: Tables) -> DataFrame:
    blobs = t.documents.select("doc_id", F.encode("text", "UTF-8").alias("data"))
    chunks = segments.split_blobs(blobs, "doc_id", "data", 1000)
    return chunks.select("doc_id", "chunk", "n", F.length("data").alias("bytes"), F.md5(F.hex("data").cast("binary")).alias("digest"))


@query(
    "seg_16_rejoin_blobs",
    "SELECT doc_id, CAST(greatest((octet_length(encode(text)) + 999) // 1000, 1) AS INTEGER) AS n, md5(text) AS digest FROM documents",
)
def rejoin_blobs(t: Tables) -> DataFrame:
    blobs = t.documents.select("doc_id", F.encode("text", "UTF-8").alias("data"))
    whole = segments.join_blobs(segments.split_blobs(blobs, "doc_id", "data", 1000), "doc_id")
    return whole.select("doc_id", "n", F.md5("data").alias("digest"))


@query(
    "seg_17_agreement",
    on_members("SELECT segment_id, count(*) AS members_a, count(*) AS members_b, true AS agree FROM members GROUP BY 1"),
)
def agreement(t: Tables) -> DataFrame:
    m = membership(t)
    return segments.agreement(segments.evaluate(segments.tag_bitmaps(m), SEGMENTS), segments.evaluate_rows(m, SEGMENTS))


@query("seg_18_stored_size", with_("active", "SELECT tag_id, count(*) AS members, 8 * count(DISTINCT actor_id // 64) AS word_bytes FROM active GROUP BY 1"))
def stored_size(t: Tables) -> DataFrame:
    return tag_words(t).groupBy("tag_id").agg(
        F.sum(F.bit_count("bits")).cast("bigint").alias("members"), (8 * F.count("*")).alias("word_bytes")
    )


@query("seg_18_exported_size", with_("active", "SELECT tag_id, count(*) AS members, true AS within_bound FROM active GROUP BY 1"))
def exported_size(t: Tables) -> DataFrame:
    """A blob takes at most two bytes a member and ten for each 65,536 ids that hold any."""
    words = tag_words(t)
    blobs = roaring.export_bitmaps(words, "tag_id").select("tag_id", "members", F.length("data").alias("bytes"))
    containers = words.groupBy("tag_id").agg(F.count_distinct(F.shiftright("word_no", 10)).alias("containers"))
    within = F.col("bytes").between(8, 16 + 10 * F.col("containers") + 2 * F.col("members"))
    return blobs.join(containers, "tag_id").select("tag_id", F.col("members").cast("bigint").alias("members"), within.alias("within_bound"))


@query(
    "bit_01_word_algebra",
    with_(
        "active",
        """SELECT CAST(actor_id // 64 AS BIGINT) AS word_no,
        count(*) FILTER (WHERE a AND b) AS n_and, count(*) FILTER (WHERE a OR b) AS n_or, count(*) FILTER (WHERE a AND NOT b) AS n_and_not,
        coalesce(bool_or(a AND actor_id % 64 = 63), false) AS last_bit_of_a
        FROM (SELECT actor_id, bool_or(tag_id = 1) AS a, bool_or(tag_id = 2) AS b FROM active GROUP BY 1) WHERE a OR b GROUP BY 1""",
    ),
)
def word_algebra(t: Tables) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    pair = tag_words(t).filter(F.col("tag_id").isin(1, 2)).groupBy("word_no").agg(
        *[F.coalesce(F.bit_or(F.when(F.col("tag_id") == n, F.col("bits"))), zero).alias(c) for n, c in ((1, "a"), (2, "b"))]
    )
    a, b = F.col("a"), F.col("b")
    count = lambda c: F.bit_count(c).cast("bigint")
    return pair.select(
        "word_no",
        count(a.bitwiseAND(b)).alias("n_and"),
        count(a.bitwiseOR(b)).alias("n_or"),
        count(a.bitwiseAND(F.bitwise_not(b))).alias("n_and_not"),
        (F.getbit(a, F.lit(63)) == 1).alias("last_bit_of_a"),
    )


@query(
    "udf_06_bitmap_aggregate",
    with_("active", "SELECT CAST((tag_id - 1) // 5 + 1 AS INTEGER) AS attribute_id, count(DISTINCT actor_id) AS members FROM active GROUP BY 1"),
)
def bitmap_aggregate(t: Tables) -> DataFrame:
    """Exact distinct count by bitmap instead of by distinct rows."""
    words = bitmaps.bitmap_agg(segments.active(membership(t)), ["attribute_id"], "actor_id")
    return bitmaps.cardinality(words, ["attribute_id"])


@query("pip_10_segmentation", on_members("SELECT segment_id, count(*) AS members, min(actor_id) AS first_actor, max(actor_id) AS last_actor FROM members GROUP BY 1"))
def segmentation(t: Tables) -> DataFrame:
    """Signal log → latest signal → segments → members, in one plan."""
    ids = bitmaps.members(segments.evaluate_members(membership(t), SEGMENTS), ["segment_id"])
    return ids.groupBy("segment_id").agg(
        F.count("*").alias("members"), F.min("actor_id").alias("first_actor"), F.max("actor_id").alias("last_actor")
    )
