"""Portable roaring bytes at the import/export boundary (published format), and the jobs around them."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

# Fixed values of the portable format.
COOKIE_PLAIN = 12346
COOKIE_RUNS = 12347
NO_OFFSET_THRESHOLD = 4
ARRAY_LIMIT = 4096
BITMAP_BYTES = 8192

FLUSH_ROWS = 100_000  # rows handed back to Spark at a time

# Type byte of the store's own bitmap encoding.
EMPTY, SINGLE32, BITMAP32, SINGLE64, BITMAP64, SET = 0, 1, 2, 3, 4, 10


def encode_container(low: np.ndarray) -> tuple[bool, bytes]:
    """Smallest encoding of sorted uint16 values: (is_run, payload)."""
    breaks = np.flatnonzero(np.diff(low) != 1)
    starts = low[np.r_[0, breaks + 1]]
    ends = low[np.r_[breaks, len(low) - 1]]
    plain = 2 * len(low) if len(low) <= ARRAY_LIMIT else BITMAP_BYTES
    if 2 + 4 * len(starts) < plain:
        runs = np.column_stack([starts, ends - starts]).astype("<u2")
        return True, struct.pack("<H", len(starts)) + runs.tobytes()
    if len(low) <= ARRAY_LIMIT:
        return False, low.astype("<u2").tobytes()
    dense = np.zeros(65536, dtype=np.uint8)
    dense[low] = 1
    return False, np.packbits(dense, bitorder="little").tobytes()


def assemble(keys: list[int], sizes: list[int], runs: list[bool], payloads: list[bytes]) -> bytes:
    """Header, offsets and payloads of containers in key order."""
    n = len(keys)
    descriptors = b"".join(struct.pack("<HH", k, s - 1) for k, s in zip(keys, sizes))
    if any(runs):
        head = struct.pack("<I", COOKIE_RUNS | (n - 1) << 16) + np.packbits(np.array(runs, dtype=np.uint8), bitorder="little").tobytes()
        with_offsets = n >= NO_OFFSET_THRESHOLD
    else:
        head = struct.pack("<II", COOKIE_PLAIN, n)
        with_offsets = True
    head += descriptors
    if with_offsets:
        first = len(head) + 4 * n
        lengths = np.cumsum([0] + [len(p) for p in payloads[:-1]]) if n else np.array([], dtype=int)
        head += (first + lengths).astype("<u4").tobytes()
    return head + b"".join(payloads)


def decode(blob: bytes) -> np.ndarray:
    """Sorted members of a portable bitmap."""
    cookie = struct.unpack_from("<I", blob)[0]
    if cookie & 0xFFFF == COOKIE_RUNS:
        n = (cookie >> 16) + 1
        at = 4 + (n + 7) // 8
        runs = np.unpackbits(np.frombuffer(blob, np.uint8, at - 4, 4), bitorder="little")[:n].astype(bool)
        with_offsets = n >= NO_OFFSET_THRESHOLD
    elif cookie == COOKIE_PLAIN:
        n = struct.unpack_from("<I", blob, 4)[0]
        at, runs, with_offsets = 8, np.zeros(n, dtype=bool), True
    else:
        raise ValueError(f"not a portable bitmap: cookie {cookie}")
    descriptors = np.frombuffer(blob, "<u2", 2 * n, at).reshape(n, 2).astype(np.int64)
    at += 4 * n + (4 * n if with_offsets else 0)
    parts = []
    for (key, less_one), is_run in zip(descriptors, runs):
        if is_run:
            count = struct.unpack_from("<H", blob, at)[0]
            pairs = np.frombuffer(blob, "<u2", 2 * count, at + 2).reshape(count, 2).astype(np.int64)
            low = np.concatenate([np.arange(s, s + more + 1) for s, more in pairs])
            at += 2 + 4 * count
        elif less_one + 1 <= ARRAY_LIMIT:
            low = np.frombuffer(blob, "<u2", less_one + 1, at).astype(np.int64)
            at += 2 * (less_one + 1)
        else:
            low = np.flatnonzero(np.unpackbits(np.frombuffer(blob, np.uint8, BITMAP_BYTES, at), bitorder="little"))
            at += BITMAP_BYTES
        parts.append((key << 16) + low)
    return np.concatenate(parts) if parts else np.array([], dtype=np.int64)


def decode_store(blob: bytes) -> np.ndarray:
    """Members of one bitmap in the store's encoding; ValueError where it cannot be read whole."""
    if not blob or blob[0] == EMPTY:
        return np.array([], dtype=np.int64)
    kind = blob[0]
    if kind == SINGLE32:
        return np.frombuffer(blob, "<u4", 1, 1).astype(np.int64)
    if kind == BITMAP32:
        return decode(blob[1:])
    if kind == SINGLE64:
        values = np.frombuffer(blob, "<u8", 1, 1)
    elif kind == SET:
        count = struct.unpack_from("<I", blob, 1)[0]
        if len(blob) - 5 != 8 * count:
            raise ValueError("truncated set")
        values = np.frombuffer(blob, "<u8", count, 5)
    else:
        raise ValueError(f"unsupported type {kind}")
    if (values > 0xFFFFFFFF).any():
        raise ValueError("value does not fit 32 bits")
    return np.unique(values).astype(np.int64)


def export_bitmaps(words: DataFrame, key: str) -> DataFrame:
    """Word rows → one portable binary per key, run-optimised: (key, members, data).

    Containers (65,536 ids, at most 1,024 words) are encoded in parallel; only the
    finished containers of one bitmap, which is the output cell itself, come together.
    """
    key_type = words.schema[key].dataType.simpleString()
    containers = words.groupBy(key, F.shiftright("word_no", 10).cast("int").alias("container")).agg(
        F.sort_array(F.collect_list(F.struct((F.col("word_no") % 1024).cast("int").alias("w"), "bits"))).alias("words")
    )
    containers = containers.select(key, "container", F.transform("words", lambda w: w["w"]).alias("slots"), F.transform("words", lambda w: w["bits"]).alias("bits"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes, runs, payloads = [], [], []
            for slots, bits in zip(pdf["slots"], pdf["bits"]):
                dense = np.zeros(1024, dtype="<u8")
                dense[np.asarray(slots)] = np.asarray(bits, dtype=np.int64).view(np.uint64)
                low = np.flatnonzero(np.unpackbits(dense.view(np.uint8), bitorder="little"))
                is_run, payload = encode_container(low)
                sizes.append(len(low))
                runs.append(is_run)
                payloads.append(payload)
            yield pd.DataFrame({key: pdf[key], "container": pdf["container"], "members": sizes, "is_run": runs, "payload": payloads})

    encoded = containers.mapInPandas(encode, f"{key} {key_type}, container int, members int, is_run boolean, payload binary")

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("container")
        blob = assemble(pdf["container"].tolist(), pdf["members"].tolist(), pdf["is_run"].tolist(), pdf["payload"].tolist())
        return pd.DataFrame({key: [pdf[key].iloc[0]], "members": [int(pdf["members"].sum())], "data": [blob]})

    return encoded.groupBy(key).applyInPandas(join, f"{key} {key_type}, members bigint, data binary")


def import_bitmaps(blobs: DataFrame, key: str, data: str, store_encoding: bool = True) -> DataFrame:
    """Binary bitmaps → rows (key, member, error); a bad blob gives one error row."""
    key_type = blobs.schema[key].dataType.simpleString()

    def rows(parts: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(
            {
                key: np.repeat([k for k, _, _ in parts], [len(ids) for _, ids, _ in parts]),
                "member": pd.array([i for _, ids, _ in parts for i in ids], dtype="Int64"),
                "error": [e for _, ids, e in parts for _ in ids],
            }
        )

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            parts, size = [], 0
            for k, blob in zip(pdf[key], pdf[data]):
                try:
                    ids = decode_store(blob) if store_encoding else decode(blob)
                except (ValueError, struct.error) as e:
                    parts.append((k, [None], str(e)))
                    continue
                if len(ids) > FLUSH_ROWS:
                    for at in range(0, len(ids), FLUSH_ROWS):
                        part = ids[at : at + FLUSH_ROWS]
                        yield pd.DataFrame({key: k, "member": part, "error": pd.Series([None] * len(part), dtype=object)})
                elif len(ids):
                    parts.append((k, ids, None))
                    size += len(ids)
                if size > FLUSH_ROWS:
                    yield rows(parts)
                    parts, size = [], 0
            if parts:
                yield rows(parts)

    return blobs.select(key, data).mapInPandas(read, f"{key} {key_type}, member bigint, error string")
