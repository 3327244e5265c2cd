"""URL filters by a cascade of Bloom filters.

A url has a few keys: every suffix of its host at a label's border, with the start of its path at
each length that occurs in the list. Level 1 of a cascade encodes the listed keys; level 2 the keys
of the corpus that level 1 takes for listed; level 3 the listed ones that level 2 takes for those;
and so on until a level errs on no key. As the cascade has seen every key of the corpus,
membership is exact, and pages are judged by bit tests alone, without a join.

Level 1 is sized so that it errs about as often as there are listed keys, so each level has a size
in proportion to the list, whatever the corpus holds; that is what executors are sent.

Defined cases. A null url or one without ``://`` has an empty host and path, no keys and no rule.
Of several rules that fit, the longest wins (host, then path). A rule listed twice counts once; one both allowed
and blocked is blocked. Equal urls get equal verdicts; without a rule the verdict is allow, as the
url is not listed. Without rules, or without pages, nothing is listed. Only id and url are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.llm.common import arrow_rows, mix
from tributary.storage import write_and_read


BORDER = "\n"  # between host and path of a key


@dataclass
class Bloom:
    bits: np.ndarray  # bytes of a power of two of bits
    probes: int
    level: int  # each level hashes anew, so keys that collide in one part in the next

    def holds(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        out = np.ones(len(first), bool)
        for at in _places(first, second, self.level, self.probes, len(self.bits) * 8):
            out &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return out


@dataclass
class Cascade:
    levels: list[Bloom] = field(default_factory=list)

    def holds(self, first: np.ndarray, second: np.ndarray, upto: int | None = None) -> np.ndarray:
        """Listed if the first level that does not hold the key has an even number (counted from 1)."""
        out = np.zeros(len(first), bool)
        going = np.ones(len(first), bool)
        levels = self.levels[:upto]
        for n, level in enumerate(levels):
            inside = level.holds(first, second)
            out[going & ~inside] = n % 2 == 1
            going &= inside
        out[going] = len(levels) % 2 == 1
        return out


def _places(first: np.ndarray, second: np.ndarray, level: int, probes: int, size: int):
    salt = np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))
    a, b = mix(first.view(np.uint64) + salt), mix(second.view(np.uint64) ^ salt) | np.uint64(1)
    for k in range(probes):
        x = a + np.uint64(k) * b
        yield (x ^ (x >> np.uint64(32))) & np.uint64(size - 1)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://``, A-Z in lower case; path: from there to ``?``, ``#`` or the end."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def url_keys(host: Column, path: Column, lengths: list[int], labels: list[int]) -> Column:
    """Longest first: host suffixes of as many labels as ``labels`` has, each with path starts of ``lengths``, from long to short.

    Only what can be listed is built, so the keys of a url grow with the list's shapes and not with the url.
    """
    own = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    suffixes = [F.when((host != "") & (own >= k), F.substring_index(host, ".", -k)) for k in sorted(labels, reverse=True)]
    starts = [F.when(F.char_length(path) >= n, F.substring(path, 1, n)) for n in sorted(lengths, reverse=True)]
    keys = [F.concat(h, F.lit(BORDER), p) for h in suffixes for p in starts]
    return F.filter(F.array(*keys), lambda x: x.isNotNull()) if keys else F.array().cast("array<string>")


def _hashed(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def _bloom(keys: DataFrame, count: int, rate: float, level: int) -> Bloom:
    """Filter of the (a, b) hashes in ``keys``; the bits are merged by word, the driver gets the words."""
    rate = min(0.5, max(rate, 1e-6))
    size = 1 << max(6, math.ceil(math.log2(max(1.0, count * -math.log(rate) / math.log(2) ** 2))))
    probes = max(1, round(size / max(1, count) * math.log(2)))
    probes = min(probes, 20)

    def run(batches):
        for batch in batches:
            a, b = (batch.column(n).to_numpy() for n in ("a", "b"))
            at = np.unique(np.concatenate([*_places(a, b, level, probes, size)]))
            word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
            if len(word):
                starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
                yield arrow_rows(pa.schema([("word", pa.int64()), ("bits", pa.int64())]), word=word[starts], bits=np.bitwise_or.reduceat(bit, starts).view(np.int64))

    words = keys.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).collect()
    filled = np.zeros(size // 64, np.int64)
    for r in words:
        filled[r.word] = r.bits
    return Bloom(filled.view(np.uint8), probes, level)


def _kept(keys: DataFrame, cascade: Cascade, wanted: bool) -> DataFrame:
    """Keys that the cascade so far judges as ``wanted``."""
    sent = keys.sparkSession.sparkContext.broadcast(cascade)

    def run(batches):
        for batch in batches:
            a, b = (batch.column(n).to_numpy() for n in ("a", "b"))
            yield batch.filter(pa.array(sent.value.holds(a, b) == wanted))

    return keys.mapInArrow(run, "a long, b long")


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """``listed``, ``universe``: distinct (a, b) hashes of keys; no key is in both."""
    cascade = Cascade()
    n_listed, n_other = listed.count(), universe.count()
    if not n_listed:
        return cascade
    rate = n_listed * math.sqrt(0.5) / max(n_other, 1)
    sides, counts = [listed, universe], [n_listed, n_other]
    while counts[0]:
        cascade.levels.append(_bloom(sides[0], counts[0], 0.5 if cascade.levels else rate, len(cascade.levels)))
        # the other side's keys that this level holds are encoded next
        known = Cascade(list(cascade.levels))
        wrong = write_and_read(_kept(sides[1], known, len(known.levels) % 2 == 1), "cascade-level")
        sides, counts = [wrong, sides[0]], [wrong.count(), counts[0]]
    return cascade


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rules, "verdict string, host string, path string")


def judge(pages: DataFrame, rules: DataFrame, id_column: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """id → host, path, rule (null without one) and verdict.

    ``rules``: verdict (allow or block), host, path.
    """
    spark = pages.sparkSession
    key = F.concat("host", F.lit(BORDER), "path")
    keyed = rules.groupBy(key.alias("key")).agg(F.max("verdict").alias("verdict"), F.max(F.char_length("path")).alias("length"), F.max(F.size(F.split("host", r"\."))).alias("labels"))
    keyed = write_and_read(keyed.withColumns(dict(zip("ab", _hashed(F.col("key"))))), "url-rules")
    # as many as there are path lengths, and numbers of labels, in the list
    lengths, labels = ([r[0] for r in keyed.select(c).distinct().collect()] for c in ("length", "labels"))
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("keys", url_keys(F.col("host"), F.col("path"), lengths, labels))
    universe = write_and_read(rows.select(F.explode("keys").alias("key")).distinct().select(*[h.alias(n) for n, h in zip("ab", _hashed(F.col("key")))]), "url-universe")
    cascades = {}
    for verdict in ("allow", "block"):
        listed = keyed.filter(F.col("verdict") == verdict).select("a", "b")
        cascades[verdict] = build_cascade(listed, universe.join(listed, ["a", "b"], "left_anti"))
    sent = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("struct<at:int,verdict:string>")
    def first_listed(a, b):
        import pandas as pd

        size = a.map(len).to_numpy()
        flat_a = np.concatenate([*a, np.empty(0, np.int64)]).astype(np.int64)
        flat_b = np.concatenate([*b, np.empty(0, np.int64)]).astype(np.int64)
        blocked, allowed = (sent.value[v].holds(flat_a, flat_b) for v in ("block", "allow"))
        row, hit = np.repeat(np.arange(len(size)), size), blocked | allowed
        starts = np.cumsum(size) - size
        at = np.full(len(size), -1, np.int32)
        where = np.flatnonzero(hit)[::-1]  # the first of a row is written last
        at[row[where]] = where - starts[row[where]]
        found = at >= 0
        verdict = np.full(len(size), default, object)
        verdict[found] = np.where(blocked[(starts + at)[found]], "block", "allow")
        return pd.DataFrame({"at": at, "verdict": verdict})

    hashes = [F.transform("keys", lambda k: _hashed(k)[0]), F.transform("keys", lambda k: _hashed(k)[1])]
    found = rows.withColumn("found", first_listed(*hashes))
    key = F.get("keys", F.when(F.col("found.at") >= 0, F.col("found.at")))
    return found.select("page_id", "host", "path", F.replace(key, F.lit(BORDER), F.lit("")).alias("rule"), F.col("found.verdict").alias("verdict"))
