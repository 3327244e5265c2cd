"""What several operators share: words, n-gram hashes, bounded labelled samples, loops that store their state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

WORD = r"[^\x20\x09-\x0D]+"
CACHED_WORDS = 150_000  # word hashes kept by one Python worker; only memory depends on it
TEXTS_PER_BATCH = 1000


def text_batches(spark: SparkSession) -> None:
    """Arrow batches of texts: a thousand rows each, as one text can hold megabytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXTS_PER_BATCH))


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def byte_words(text: str | None) -> list[bytes]:
    """The words of a text: runs of bytes other than space, tab, \\n, \\v, \\f and \\r."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


class Cache:
    """What was used lately: two generations, the older one goes when the younger is full."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def put(self, key, value):
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young
        self.young[key] = value
        return value

    def get(self, key):
        value = self.young.get(key)
        if value is None:
            value = self.old.get(key)
            if value is not None:
                self.put(key, value)
        return value


_KEPT: dict = {}


def kept(key, make):
    """What a Python worker keeps from one task to the next: the last thing made, so operators that follow one another do not add up."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


class WordHashes(dict):
    """64-bit hash of each word, computed once while it stays cached."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def grams(hashes: np.ndarray, length: int, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive words, from the hashes of every ``length``.

    Doubles the length per step; the last step overlaps its halves.
    """
    while length < size:
        step = min(length, size - length)
        left, right = hashes[: max(0, len(hashes) - step)], hashes[step:]
        hashes = mix(left * np.uint64(0x9E3779B97F4A7C15) + (right ^ np.uint64(step)) * np.uint64(0xC2B2AE3D27D4EB4F))
        length += step
    return hashes


def signed(hashes: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(hashes).view(np.int64)


def arrow_rows(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def map_texts(df: DataFrame, one_batch, schema: str) -> DataFrame:
    """Apply ``one_batch(RecordBatch) -> Iterator[RecordBatch]`` to every Arrow batch of ``df``."""
    text_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from one_batch(batch)

    return df.mapInArrow(run, schema)


def held_out(id_column, folds: int, fold: int) -> F.Column:
    """crc32 of the id as text, modulo ``folds``, is ``fold``; false for a missing id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == fold, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, per_class: int, skip: F.Column, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, label, text) of at most ``per_class`` labelled ids per class, by the smallest hash of the id.

    Ids with ``skip`` are left out; of several labels of one id the largest counts; a missing id
    or label is no label; of several texts with one id the smallest by hash counts. The ids found
    are bounded by the parameter, so they are broadcast and documents are read without a shuffle.
    """
    order = F.xxhash64(id_column, F.lit(label))
    known = (
        labels.select(id_column, F.col(label).cast("int").alias("label"))
        .filter(F.col(id_column).isNotNull() & F.col("label").isin(0, 1) & ~skip)
        .groupBy(id_column)
        .agg(F.max("label").alias("label"))
    )
    classes = [known.filter(F.col("label") == k).orderBy(order, id_column).limit(per_class) for k in (0, 1)]
    picked = F.broadcast(classes[0].unionAll(classes[1]))
    rows = documents.select(id_column, F.col(text).alias("text")).join(picked, id_column)
    return rows.groupBy(id_column, "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last weight is the intercept."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(penalty), a.T @ (y - p) - penalty * w)
        step *= min(1.0, 5.0 / max(1e-12, np.abs(step).max()))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
