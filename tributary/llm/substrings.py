"""Substring dedup: words covered by a window that also occurs elsewhere are removed.

A window of 35 words is found by doubling: its halves have 18 words, theirs 9.

1. Of the 9-word pieces of each window one is chosen by its hash, the same wherever the window
   stands (the smallest in the window). Only chosen pieces, about one in fourteen, are compared.
2. A piece that repeats is extended to twice its length on either side; equal extensions of equal
   pieces meet in the same group.
3. Only windows whose chosen piece and all of its extensions inside the window repeat are compared whole.

A window that repeats passes each level, so nothing is lost; what survives the last is what repeats. Texts with
the same words as another text need no comparing for themselves: one of each such class stands for the others.

Every comparison is a shuffle by hash. Before it, rows that repeat within a batch of a task leave
only two witnesses under their hash, the others are known to repeat and are dealt out at random;
so one passage in a third of all texts does not meet in one task. Texts are compressed before they
are shuffled. Windows count as equal when their 64-bit hashes at each level are.

Defined cases. A null or empty text has no words. A text shorter than the window keeps all its
words unless its windows, of which it has none, repeat. Rows with equal id and text are documents
of their own that repeat each other. Null ids are told apart by their texts. Words are compared
and kept unchanged. Removed documents keep an empty text. Other columns are kept by
``without_repeats``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from tributary.llm.common import WordHashes, arrow_rows, byte_words, grams, map_texts, mix, signed
from tributary.storage import write_and_read

WINDOW = 35  # words


def levels(window: int) -> tuple[int, int]:
    half = -(-window // 2)
    return -(-half // 2), half


def chosen(pieces: np.ndarray, span: int) -> np.ndarray:
    """For each run of ``span`` pieces the place of its smallest hash, the rightmost of equal ones."""
    n = len(pieces) - span + 1
    if n <= 0:
        return np.empty(0, np.int64)
    best, at, length = pieces, np.arange(len(pieces)), 1
    while length < span:
        step = min(length, span - length)
        left, right = best[:-step], best[step:]
        later = right <= left
        best, at = np.where(later, right, left), np.where(later, at[step:], at[:-step])
        length += step
    return at


def witnesses(*keys: np.ndarray) -> np.ndarray:
    """True for rows that follow two others with equal keys: known to repeat without comparing."""
    if not len(keys[0]):
        return np.zeros(0, bool)
    key = keys[0]
    for k in keys[1:]:
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + k)
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    out = np.zeros(len(key), bool)
    out[order[2:]] = ordered[2:] == ordered[:-2]
    return out


def keyed(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """doc_id, k (hash of the text, tells rows with one id apart), text."""
    return documents.select(F.col(id_column).alias("doc_id"), F.xxhash64(text).alias("k"), F.col(text).alias("text"))


def facts(rows: DataFrame) -> DataFrame:
    """doc_id, k, n_words, sha256 of the words joined by blanks."""

    def run(batch: pa.RecordBatch):
        words = [byte_words(t) for t in batch.column("text").to_pylist()]
        schema = pa.schema([batch.schema.field("doc_id"), batch.schema.field("k"), ("n_words", pa.int64()), ("sha", pa.string())])
        yield arrow_rows(schema, doc_id=batch.column("doc_id"), k=batch.column("k"), n_words=[len(w) for w in words], sha=[hashlib.sha256(b" ".join(w)).hexdigest() for w in words])

    return map_texts(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, k long, n_words long, sha string")


def piece_rows(rows: DataFrame, window: int) -> DataFrame:
    """Chosen pieces: hash g, hashes of their extensions in lr, place; the last bit of lr: known to repeat on both sides."""
    short, half = levels(window)
    table = WordHashes()

    def run(batch: pa.RecordBatch):
        ids, ks, texts = (batch.column(n) for n in ("doc_id", "k", "text"))
        row, at, g, l, r = [], [], [], [], []
        for i, text in enumerate(texts.to_pylist()):
            words = byte_words(text)
            if len(words) < window:
                continue
            pieces = grams(table.of(words), 1, short)
            doubles = grams(pieces, short, half)
            place = np.unique(chosen(pieces, window - short + 1))
            # a piece at p is the right part of the double that starts at p - (half - short), the left part of that at p
            before = place - (half - short)
            row.append(np.full(len(place), i))
            at.append(place)
            g.append(pieces[place])
            l.append(np.where(before >= 0, doubles[np.maximum(before, 0)], np.uint64(0)))
            r.append(np.where(place < len(doubles), doubles[np.minimum(place, len(doubles) - 1)], np.uint64(0)))
        if row:
            row_, at_, g_, l_, r_ = (np.concatenate(x) for x in (row, at, g, l, r))
            known = witnesses(g_, l_, r_)
            spread = np.where(known, mix(g_ + mix(at_.astype(np.uint64) + (row_.astype(np.uint64) << np.uint64(32)))), g_)
            schema = pa.schema([batch.schema.field("doc_id"), ("k", pa.int64()), ("at", pa.int32()), ("g", pa.int64()), ("lr", pa.int64())])
            # 32 and 31 bits of the extensions' hashes: they only tell rows of one g apart
            lr = (l_ >> np.uint64(32) << np.uint64(32)) | (r_ >> np.uint64(33) << np.uint64(1)) | known.astype(np.uint64)
            yield arrow_rows(schema, doc_id=ids.take(pa.array(row_)), k=ks.to_numpy()[row_], at=at_.astype(np.int32), g=signed(spread), lr=signed(lr))

    return map_texts(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, k long, at int, g long, lr long")


def candidates(pieces: DataFrame) -> DataFrame:
    """doc_id, k, marks: places of pieces that repeat, times four, plus 1 and 2 for a repeating extension to the left and right."""
    same = lambda *c: F.count("*").over(Window.partitionBy(*c)) > 1  # noqa: E731  one shuffle, by g, is enough for both
    parts = pieces.select("doc_id", "k", "at", "g", F.shiftright("lr", 32).alias("l"), F.col("lr").bitwiseAND(F.lit(0xFFFFFFFE)).alias("r"), (F.col("lr") % 2 != 0).alias("settled"))
    flagged = parts.select("doc_id", "k", "at", "settled", same("g", "l").alias("left"), same("g", "r").alias("right"))
    left, right = (F.col("settled") | F.col(c) for c in ("left", "right"))
    mark = F.col("at").cast("long") * 4 + F.when(left, 1).otherwise(0) + F.when(right, 2).otherwise(0)
    return flagged.filter(left | right).groupBy("doc_id", "k").agg(F.collect_list(mark).alias("marks"))


def packed(rows: DataFrame) -> DataFrame:
    """Texts compressed for a shuffle."""

    def run(batch: pa.RecordBatch):
        press = zstandard.ZstdCompressor(level=3)
        blobs = [press.compress((t or "").encode("utf-8", "surrogatepass")) for t in batch.column("text").to_pylist()]
        schema = pa.schema([batch.schema.field("doc_id"), batch.schema.field("k"), ("packed", pa.binary())])
        yield arrow_rows(schema, doc_id=batch.column("doc_id"), k=batch.column("k"), packed=blobs)

    return map_texts(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, k long, packed binary")


def unpacked(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def window_rows(found: DataFrame, window: int) -> DataFrame:
    """Whole windows left to compare: doc_id, k, at, hash w, settled, and whether the text is ``whole``."""
    short, half = levels(window)
    table = WordHashes()

    def run(batch: pa.RecordBatch):
        ids, ks = batch.column("doc_id"), batch.column("k").to_numpy()
        whole = batch.column("whole").to_pylist()
        row, at, w, sure = [], [], [], []
        for i, (blob, marks) in enumerate(zip(batch.column("packed").to_pylist(), batch.column("marks"))):
            hashes = table.of(unpacked(blob).split())
            pieces = grams(hashes, 1, short)
            if len(hashes) < window:
                continue
            flags = np.zeros(len(pieces), np.int8)
            if whole[i]:
                flags[:] = 3
            else:
                marked = marks.values.to_numpy()
                flags[marked >> 2] = marked & 3
            place = chosen(pieces, window - short + 1)
            k = place - np.arange(len(place))
            f = flags[place]
            keep = (f > 0) & ((k < half - short) | (f & 1 > 0)) & ((k + half > window) | (f & 2 > 0))
            start = np.flatnonzero(keep)
            row.append(np.full(len(start), i))
            at.append(start)
            w.append(grams(pieces, short, window)[start])
            sure.append(np.full(len(start), bool(whole[i])))
        if row:
            row_, at_, w_, sure_ = (np.concatenate(x) for x in (row, at, w, sure))
            known = witnesses(w_)
            spread = np.where(known, mix(w_ + mix(at_.astype(np.uint64) + (row_.astype(np.uint64) << np.uint64(32)))), w_)
            schema = pa.schema([batch.schema.field("doc_id"), ("k", pa.int64()), ("at", pa.int32()), ("w", pa.int64()), ("settled", pa.bool_()), ("whole", pa.bool_())])
            yield arrow_rows(schema, doc_id=ids.take(pa.array(row_)), k=ks[row_], at=at_.astype(np.int32), w=signed(spread), settled=known, whole=sure_)

    return map_texts(found, run, f"doc_id {found.schema['doc_id'].dataType.simpleString()}, k long, at int, w long, settled boolean, whole boolean")


def repeats(documents: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, facts with ``whole``, covers): covers has the starts of repeating windows by doc_id and k,
    for texts that are not wholly covered; those have ``whole``."""
    rows = keyed(documents, id_column, text)
    known = write_and_read(facts(rows), "substring-facts")
    long_ = known.filter(F.col("n_words") >= window)
    classes = long_.groupBy("sha").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "k")).alias("first"))
    twice = write_and_read(classes.filter("n > 1").select(F.col("sha"), "first"), "substring-classes")
    known = write_and_read(known.join(twice, "sha", "left").withColumn("whole", F.col("first").isNotNull()), "substring-known")
    # texts to read again: those with marks, one of each class of equal texts
    # written, so that the pieces' shuffles are dropped before the windows are shuffled
    marked = write_and_read(candidates(piece_rows(rows, window)), "substring-marks").withColumnsRenamed({"doc_id": "d", "k": "kk"})
    one = known.filter(~F.col("whole") | (F.col("first") == F.struct("doc_id", "k"))).select("doc_id", "k", "whole").distinct()
    wanted = one.join(marked, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("kk"))).select("d", "kk", "whole", "marks")
    found = packed(rows).join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("kk"))).select("doc_id", "k", "packed", "whole", "marks")
    compared = window_rows(found, window).select("doc_id", "k", "at", "settled", "whole", (F.count("*").over(Window.partitionBy("w")) > 1).alias("again"))
    again = compared.filter("not whole and (settled or again)")
    covers = again.groupBy("doc_id", "k").agg(F.collect_list("at").alias("starts"))
    return rows, known, write_and_read(covers, "substring-covers")


def kept_words(words: list[bytes], starts: np.ndarray, window: int) -> list[bytes]:
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + window, len(words)), -1)
    left = np.cumsum(change[:-1]) == 0
    return [w for w, k in zip(words, left.tolist()) if k]


def summary(documents: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, one row per document."""
    rows, known, covers = repeats(documents, id_column, text, window)
    c = covers.withColumnsRenamed({"doc_id": "d", "k": "kk"})
    found = packed(rows).join(c, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("kk"))).select("doc_id", "k", "packed", "starts")

    def run(batch: pa.RecordBatch):
        removed, shas = [], []
        for blob, starts in zip(batch.column("packed").to_pylist(), batch.column("starts")):
            words = unpacked(blob).split()
            kept = kept_words(words, starts.values.to_numpy(), window)
            removed.append(len(words) - len(kept))
            shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        schema = pa.schema([batch.schema.field("doc_id"), batch.schema.field("k"), ("removed", pa.int64()), ("kept_sha", pa.string())])
        yield arrow_rows(schema, doc_id=batch.column("doc_id"), k=batch.column("k"), removed=removed, kept_sha=shas)

    cut = map_texts(found, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, k long, removed long, kept_sha string")
    cut = cut.distinct().withColumnsRenamed({"doc_id": "d", "k": "kk"})  # rows that repeat an id and a text are whole copies, never here twice
    empty = hashlib.sha256(b"").hexdigest()
    joined = known.join(cut, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("k") == F.col("kk")), "left")
    return joined.select(
        "doc_id", "n_words",
        F.when(F.col("whole"), F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(F.col("whole"), F.lit(empty)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    )


def without_repeats(documents: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents with their texts cut: texts that lose words become the kept words joined by blanks; others stay as they are."""
    _, known, covers = repeats(documents, id_column, text, window)
    whole = known.filter("whole").select(F.col("doc_id").alias("_d"), F.col("k").alias("_k"), F.lit(None).cast("array<int>").alias("_starts"), F.lit(True).alias("_whole")).distinct()
    cuts = covers.select(F.col("doc_id").alias("_d"), F.col("k").alias("_k"), F.col("starts").alias("_starts"), F.lit(False).alias("_whole"))
    rows = documents.withColumn("_at", F.xxhash64(text))
    joined = rows.join(whole.unionByName(cuts), F.col(id_column).eqNullSafe(F.col("_d")) & (F.col("_at") == F.col("_k")), "left")

    columns = documents.columns

    def run(batch: pa.RecordBatch):
        texts = batch.column(text).to_pylist()
        for i, (whole_, starts) in enumerate(zip(batch.column("_whole").to_pylist(), batch.column("_starts"))):
            if whole_:
                texts[i] = ""
            elif whole_ is not None:
                texts[i] = b" ".join(kept_words(byte_words(texts[i]), starts.values.to_numpy(), window)).decode("utf-8", "surrogatepass")
        schema = pa.schema([batch.schema.field(c) for c in columns])
        yield arrow_rows(schema, **{c: texts if c == text else batch.column(c) for c in columns})

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.schema)
    return map_texts(joined.select(*[rows[c] for c in columns], "_starts", "_whole"), run, schema)
