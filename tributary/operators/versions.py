"""Upserts, merges, allocation and versions over keyed tables, as DataFrame → DataFrame."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tributary.operators.ordered import HOT_ROWS, ordered_scan
from tributary.storage import write_and_read


def _tagged(df: DataFrame, key: list[str], name: str) -> DataFrame:
    rest = [c for c in df.columns if c not in key]
    return df.select(*key, F.struct(*rest).alias(name))


def insert_if_absent(target: DataFrame, source: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """Target rows plus the first source row (by ``order``) of every new key."""
    rest = [c for c in source.columns if c not in key]
    first = source.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, "r.*")
    new = first.join(target.select(*key), key, "left_anti")
    return target.withColumn("origin", F.lit("kept")).unionByName(new.withColumn("origin", F.lit("inserted")))


def upsert(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Source wins on equal keys; ``action`` says what happened to each row. Same columns on both sides."""
    joined = _tagged(target, key, "t").join(_tagged(source, key, "s"), key, "full")
    action = F.when(F.col("s").isNull(), "kept").when(F.col("t").isNull(), "inserted").otherwise("updated")
    return joined.select(*key, F.coalesce("s", "t").alias("r"), action.alias("action")).select(*key, "r.*", "action")


def merge(target: DataFrame, source: DataFrame, key: list[str], delete_when: Column) -> DataFrame:
    """Update matched rows, insert new ones, delete where the merged row satisfies ``delete_when``."""
    merged = upsert(target, source, key)
    return merged.filter(~F.coalesce(delete_when, F.lit(False)))


def split_rows(df: DataFrame, moved: Column) -> DataFrame:
    """Classify every row once; writing by ``side`` moves and keeps in the same pass."""
    return df.withColumn("side", F.when(F.coalesce(moved, F.lit(False)), "archived").otherwise("remaining"))


def change_where(df: DataFrame, column: str, value: str, condition: Column) -> DataFrame:
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumn("changed", hit).withColumn(column, F.when(hit, value).otherwise(F.col(column)))


def _take(key: str, quantity: str):
    """mapInArrow function over rows in order per key: ``accepted`` while the request fits what is left of ``_left``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, left = None, 0
        for batch in batches:
            keys, wanted, stock = (batch.column(c).to_pylist() for c in (key, quantity, "_left"))
            accepted = []
            for k, q, s in zip(keys, wanted, stock):
                if k != now:
                    now, left = k, s
                fits = q is not None and 0 <= q <= left
                left -= q if fits else 0
                accepted.append(fits)
            rest = [i for i, n in enumerate(batch.schema.names) if n != "_left"]
            columns = [batch.column(i) for i in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(accepted, pa.bool_())], names=[*[batch.schema.names[i] for i in rest], "accepted"])

    return run


def allocate(requests: DataFrame, stock: DataFrame, key: str, quantity: str, order: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Requests with ``accepted``: served one after another, each taken if it fits what is left.

    A refused request takes nothing, so a later smaller one can still be served. ``order`` is a total
    order, ``stock`` has ``key`` and ``stock``; a null or negative quantity is refused. A key with
    fewer than ``hot_rows`` open requests is one pass in one task. A hotter one goes in rounds: what is larger than the
    rest is refused, the longest prefix that fits is taken by running sums over slices of the
    order, and so on with the new rest until few enough are open.
    """
    left = stock.select(key, F.col("stock").alias("_left"))
    open_ = requests.join(left, key)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.schema) + ", accepted boolean"
    names, done = [*requests.columns, "accepted"], []
    while True:
        open_ = write_and_read(open_, "allocate-open")
        hot = open_.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") >= hot_rows).select(key)
        cold = open_.join(hot, key, "left_anti").repartition(key).sortWithinPartitions(key, *order)
        done.append(cold.select(*requests.columns, "_left").mapInArrow(_take(key, quantity), kinds).select(*names))
        if hot.isEmpty():
            return reduce(DataFrame.unionByName, done)
        rows = open_.join(hot, key, "left_semi")
        fits = F.coalesce(F.col(quantity).between(0, F.col("_left")), F.lit(False))
        done.append(rows.filter(~fits).select(*requests.columns, F.lit(False).alias("accepted")))
        summed = write_and_read(ordered_scan(rows.filter(fits), [key], order, sums={"_sum": quantity}, hot_rows=hot_rows), "allocate-sums")
        taken = F.col("_sum") <= F.col("_left")
        done.append(summed.filter(taken).select(*requests.columns, F.lit(True).alias("accepted")))
        used = summed.filter(taken).groupBy(key).agg(F.max("_sum").alias("_used"))
        kind = dict(open_.dtypes)["_left"]
        rest = (F.col("_left") - F.coalesce("_used", F.lit(0))).cast(kind)
        open_ = summed.filter(~taken).join(used, key, "left").select(*requests.columns, rest.alias("_left"))


def version_history(changes: DataFrame, version: Column) -> DataFrame:
    """Rows added per version and total up to it; one row per version is windowed."""
    added = changes.groupBy(version.alias("version")).agg(F.count("*").alias("added"))
    so_far = Window.orderBy("version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return added.withColumn("total", F.sum("added").over(so_far))


def compare_versions(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys that differ between two versions, with the kind of difference."""
    joined = _tagged(before, [key], "b").join(_tagged(after, [key], "a"), key, "full")
    kind = F.when(F.col("a").isNull(), "removed").when(F.col("b").isNull(), "restored").when(~F.col("a").eqNullSafe(F.col("b")), "changed")
    return joined.select(key, F.coalesce(kind, F.lit("same")).alias("difference"))


def renamed(df: DataFrame, mapping: dict[str, str], columns: list[str]) -> DataFrame:
    """Read old files under a new schema: ``mapping`` is old → new; a column that old files
    lack is NULL there, one written under both names is merged."""
    by_new: dict[str, list[str]] = {}
    for old, new in mapping.items():
        by_new.setdefault(new, []).append(old)
    out = []
    for c in columns:
        sources = [name for name in [c, *by_new.get(c, [])] if name in df.columns]
        out.append(F.coalesce(*sources).alias(c))
    return df.select(*out)
