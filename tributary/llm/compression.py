"""Quality classifier by compression.

Two zstandard dictionaries are built from pieces of good and of bad labelled texts. A text is cut
into blocks, each block is compressed with both, and what the good dictionary saves over the bad
one, normalised, says which of the two the text resembles. A logistic curve fitted on other
labelled texts turns this difference, with the two rates it is made of, into a probability.

The dictionaries and the curve are fitted on at most ``PER_CLASS`` labelled documents per class
and ``BLOCKS`` blocks each; every text is scored whole, block by block, on the executors.

Defined cases. A null or empty text has one empty block and gets the curve's value there. Equal
texts get equal scores. Labels other than 0 and 1 and ids without a label are not learned from.
With labels of one class only, or too little text for a dictionary, the score is the share of
label 1 among the labels (0.5 without any). Columns beside id and text are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tributary.llm.common import arrow_rows, fit_logistic, kept, labelled_sample, map_texts, sigmoid
from tributary.storage import write_and_read

PER_CLASS = 4000  # labelled documents per class that are learned from, half for the dictionaries, half for the curve
BLOCKS = 4000  # blocks of text per dictionary
BLOCK = 2048  # bytes
DICTIONARY = 64 << 10
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]  # without dictionaries: the score's intercept only

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.good:
            return np.full(len(features), sigmoid(self.weights[-1]))
        x = (features - np.array(self.centre)) / np.array(self.scale)
        return sigmoid(np.hstack([x, x**2]) @ np.array(self.weights[:-1]) + self.weights[-1])


def blocks(data: bytes) -> list[bytes]:
    return [data[i : i + BLOCK] for i in range(0, len(data), BLOCK)] or [b""]


def features(text: str | None, good, bad) -> list[float]:
    """Normalised difference over the whole text, its smallest over a block, bytes per byte with both, length."""
    data = (text or "").encode("utf-8", "surrogatepass")
    by_good, by_bad, least = 0, 0, 1.0
    for block in blocks(data):
        g, b = len(good.compress(block)), len(bad.compress(block))
        by_good, by_bad, least = by_good + g, by_bad + b, min(least, (b - g) / max(b, g))
    size = len(data) + 16
    return [(by_bad - by_good) / max(by_good, by_bad), least, by_good / size, by_bad / size, float(np.log(size))]


def compressors(*dictionaries: bytes) -> list:
    """One per dictionary, made once by a Python worker."""

    def make():
        options = {"level": 3, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        return [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), **options) for d in dictionaries]

    return kept(("compressors", hashlib.sha256(b"".join(dictionaries)).digest()), make)


def _block_sample(sample: DataFrame, label: int) -> list[bytes]:
    """At most BLOCKS blocks of one class, by the smallest hash of what is in them."""

    def run(batch: pa.RecordBatch):
        found = [b for t in batch.column("text").to_pylist() for b in blocks((t or "").encode("utf-8", "surrogatepass"))]
        yield arrow_rows(pa.schema([("block", pa.binary())]), block=found)

    cut = map_texts(sample.filter(F.col("label") == label).select("text"), run, "block binary")
    return [bytes(r.block) for r in cut.orderBy(F.xxhash64("block"), "block").limit(BLOCKS).collect()]


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", skip: Column | None = None, id_column: str = "doc_id", text: str = "text", per_class: int = PER_CLASS) -> Model:
    """``skip``: condition on the labels' id; those rows are never learned from."""
    sample = write_and_read(labelled_sample(documents, labels, label, per_class, F.lit(False) if skip is None else skip, id_column, text), "quality-sample")
    counts = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
    flat = Model(b"", b"", (), (), (float(np.log(share / (1 - share))),))
    if len(counts) < 2:
        return flat
    half = F.pmod(F.xxhash64(F.lit("half"), id_column), F.lit(2))
    good, bad = (_block_sample(sample.filter(half == 0), k) for k in (1, 0))
    try:
        made = [zstandard.train_dictionary(DICTIONARY, x).as_bytes() for x in (good, bad)]
    except zstandard.ZstdError:  # too little text
        return flat
    rows = scored_features(sample.filter(half == 1), made, "label").collect()
    x, y = np.array([r.features for r in rows]), np.array([r.label for r in rows], float)
    if len(set(y)) < 2:
        return flat
    centre, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - centre) / scale
    # classes are sampled evenly; weights by their shares among all labels
    weights = fit_logistic(np.hstack([z, z**2]), y, ridge=1.0)
    known = labels.filter(F.col(label).isin(0, 1) & ~(F.lit(False) if skip is None else skip)).groupBy(F.col(label).cast("int").alias("k")).count()
    shares = {r.k: r["count"] for r in known.collect()}
    weights[-1] += np.log(shares[1] / shares[0]) - np.log(y.sum() / (len(y) - y.sum()))
    return Model(made[0], made[1], tuple(centre), tuple(scale), tuple(weights))


def scored_features(rows: DataFrame, dictionaries: list[bytes], *keep: str) -> DataFrame:
    def run(batch: pa.RecordBatch):
        good, bad = compressors(*dictionaries)
        found = [features(t, good, bad) for t in batch.column("text").to_pylist()]
        fields = [batch.schema.field(k) for k in keep]
        yield arrow_rows(pa.schema([*fields, ("features", pa.list_(pa.float64()))]), features=found, **{k: batch.column(k) for k in keep})

    schema = ", ".join([f"{k} {rows.schema[k].dataType.simpleString()}" for k in keep] + ["features array<double>"])
    return map_texts(rows.select("text", *keep), run, schema)


def score(documents: DataFrame, model: Model, id_column: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """id → score between 0 and 1, higher for likelier good, and the verdict at ``threshold``."""
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch):
        own = sent.value
        texts = batch.column("text").to_pylist()
        found = np.zeros((len(texts), 5))
        if own.good:
            good, bad = compressors(own.good, own.bad)
            found = np.array([features(t, good, bad) for t in texts])
        out = own.score(found)
        schema = pa.schema([batch.schema.field("doc_id"), ("score", pa.float64()), ("predicted", pa.int32())])
        yield arrow_rows(schema, doc_id=batch.column("doc_id"), score=out, predicted=(out >= threshold).astype(np.int32))

    rows = documents.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    return map_texts(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int")
