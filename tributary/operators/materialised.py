"""Materialised sums that are refreshed from changes, not rebuilt.

A view stores one partial aggregate per group: the number of rows and, for every measure, its
sum and the number of its values. They are mergeable and have inverses, so a changed row is
its old image with sign -1 and its new image with sign 1. Measures must be exact (integers,
decimals); a float would not return to its old sum.

The table is partitioned by a function of the group. A refresh reads and replaces only the
partitions that its changes meet, and stamps them with its version: run again after a crash, it
leaves alone those that already carry it, so no change counts twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.sources import sinks
from tributary.storage import write_and_read

PART, SIGN, VERSION, ROWS = "part", "sign", "version", "n_rows"


@dataclass(frozen=True)
class SumView:
    """Groups and measures over a fact table; ``part`` is computed from the groups."""

    path: str
    groups: dict[str, Column]
    measures: dict[str, Column]
    part: Column

    @property
    def sums(self) -> list[str]:
        return [c for m in self.measures for c in (f"{m}_sum", f"{m}_values")] + [ROWS]


def signed(rows: DataFrame, sign: int) -> DataFrame:
    return rows.withColumn(SIGN, F.lit(sign).cast("bigint"))


def signed_changes(present: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Old images out and new images in, for the keys of ``changes``.

    ``changes`` holds the newest image of each changed key once, with ``deleted``; a key that
    ``present`` lacks is an insert, a deleted key that it lacks changes nothing.
    """
    touched = present.join(changes.select(key), key, "left_semi")
    added = changes.filter(~F.col("deleted")).select(*present.columns)
    return signed(touched, -1).unionByName(signed(added, 1))


def _partials(view: SumView, delta: DataFrame) -> DataFrame:
    rows = delta.select(SIGN, *[c.alias(n) for n, c in view.groups.items()], *[c.alias(f"_{n}") for n, c in view.measures.items()])
    sums = []
    for name in view.measures:
        value = F.col(f"_{name}")
        sums.append(F.coalesce(F.sum(F.when(F.col(SIGN) > 0, value).otherwise(-value)), F.lit(0)).alias(f"{name}_sum"))
        sums.append(F.sum(F.when(value.isNotNull(), F.col(SIGN)).otherwise(0)).alias(f"{name}_values"))
    grouped = rows.groupBy(*view.groups).agg(*sums, F.sum(SIGN).alias(ROWS))
    # Folder names: neither null nor empty, which read back as the same folder.
    text = view.part.cast("string")
    return grouped.withColumn(PART, F.when(text != "", text).otherwise("none"))


def _stored(spark: SparkSession, view: SumView, like: DataFrame) -> DataFrame:
    """The stored rows, with types of the partials so that nothing is inferred."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema if f.name != PART)
    return spark.read.schema(f"{fields}, {VERSION} BIGINT, {PART} STRING").parquet(view.path)


def _typed(view: SumView, partials: DataFrame) -> DataFrame:
    """Sums of sums widen decimals; stored sums keep 38 digits from the start."""
    casts = {}
    for name in view.measures:
        kind = partials.schema[f"{name}_sum"].dataType
        if kind.typeName() in ("double", "float"):
            raise TypeError(f"{name} must be exact: an integer or a decimal")
        casts[f"{name}_sum"] = F.col(f"{name}_sum").cast(f"decimal(38,{kind.scale})" if kind.typeName() == "decimal" else "bigint")
    return partials.withColumns(casts) if casts else partials


def build(view: SumView, rows: DataFrame) -> None:
    """Write the view from all rows, as version 0."""
    partials = _typed(view, _partials(view, signed(rows, 1)))
    sinks.write_partitioned(partials.withColumn(VERSION, F.lit(0).cast("bigint")), view.path, PART, mode="overwrite")


def refresh(view: SumView, delta: DataFrame, version: int) -> list[str]:
    """Add signed rows to the view as ``version``; returns the partitions it replaced.

    Versions ascend. The delta is aggregated first, so what meets the stored groups has one row
    per group. A group that has lost all rows stays as a row of zeros, which carries the version.
    """
    if version < 1:
        raise ValueError("versions start at 1; 0 is the build")
    spark = delta.sparkSession
    changed = write_and_read(_typed(view, _partials(view, delta)), "view-changes")
    parts = [r[0] for r in changed.select(PART).distinct().collect()]  # folder names, no rows
    stored = _stored(spark, view, changed).filter(F.col(PART).isin(parts))
    done = [r[0] for r in stored.filter(F.col(VERSION) >= version).select(PART).distinct().collect()]
    todo = sorted(set(parts) - set(done))
    if not todo:
        return []
    both = stored.drop(VERSION).unionByName(changed).filter(F.col(PART).isin(todo))
    merged = _typed(view, both.groupBy(PART, *view.groups).agg(*[F.sum(c).alias(c) for c in view.sums]))
    # Written aside first: the folders it is computed from are the ones replaced.
    fresh = write_and_read(merged.withColumn(VERSION, F.lit(version).cast("bigint")), "view-fresh")
    sinks.overwrite_partitions(fresh, view.path, PART)
    return todo


def read(spark: SparkSession, view: SumView, facts: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Groups that have rows: ``n_rows`` and, per measure, its sum (null without values) and average.

    ``facts`` gives the types only. ``only`` names partitions, which prune the files.
    """
    stored = _stored(spark, view, _typed(view, _partials(view, signed(facts.limit(0), 1))))
    if only is not None:
        stored = stored.filter(F.col(PART).isin(only))
    sums = []
    for name in view.measures:
        has_values = F.col(f"{name}_values") > 0
        sums.append(F.when(has_values, F.col(f"{name}_sum")).alias(name))
        sums.append(F.when(has_values, F.col(f"{name}_sum").cast("double") / F.col(f"{name}_values")).alias(f"{name}_avg"))
    return stored.filter(F.col(ROWS) > 0).select(*view.groups, *sums, ROWS)
