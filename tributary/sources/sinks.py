"""Writers: modes, codecs, partition layouts, bucketing, compaction and reports."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from tributary.storage import remove, write_and_read

TARGET_FILE_BYTES = 256 * 1024 * 1024
ROWS_PER_FILE = 5_000_000


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "error", codec: str | None = None, header: bool = True) -> None:
    writer = df.write.format(fmt).mode(mode)
    if codec:
        writer = writer.option("compression", codec)
    if fmt == "csv":
        writer = writer.option("header", header)
    writer.save(path)


def write_partitioned(df: DataFrame, path: str, *columns: str, mode: str = "error", max_rows_per_file: int = ROWS_PER_FILE) -> None:
    """Hive-style layout with few files: rows are clustered by partition first. AQE splits a
    partition that is too large for one task, and a file stops at ``max_rows_per_file``."""
    clustered = df.hint("rebalance", *columns)
    clustered.write.mode(mode).option("maxRecordsPerFile", max_rows_per_file).partitionBy(*columns).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace only the partitions that occur in ``df``."""
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*columns)
        .parquet(path)
    )


def replace_partitions(df: DataFrame, path: str, column: str, values: list) -> None:
    """Make the partitions of ``values`` hold their rows of ``df`` and nothing else, also where
    ``df`` has none. Other partitions, and rows of other values, are left alone.

    ``values`` are few, and their text is that of the folder names. A run that stops halfway is
    repeated as a whole.
    """
    rows = write_and_read(df.filter(F.col(column).isin(values)), "replacement")
    overwrite_partitions(rows, path, column)
    present = {row[0] for row in rows.select(F.col(column).cast("string")).distinct().collect()}
    for value in values:
        if str(value) not in present:
            remove(df.sparkSession, f"{path}/{column}={value}")


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str) -> None:
    """Bucketed and sorted table; equal bucketing on both sides joins without a shuffle.

    A bucket is one task, so this suits keys without a hot value; ``joins`` has ways for those.
    """
    df.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def write_files(df: DataFrame, path: str, files: int, fmt: str = "parquet") -> None:
    df.repartition(files).write.format(fmt).save(path)


def file_report(stored: DataFrame) -> DataFrame:
    """Rows, files and bytes of a stored dataset, from the files themselves."""
    per_file = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("rows"), F.max("_metadata.file_size").alias("bytes")
    )
    return per_file.agg(F.sum("rows").alias("rows"), F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def compact(spark: SparkSession, source: str, target: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite many small files as files of about ``target_bytes``; returns their number."""
    stored = spark.read.parquet(source)
    total = file_report(stored).first()["bytes"] or 0
    files = max(1, math.ceil(total / target_bytes))
    stored.repartition(files).write.parquet(target)
    return files
