"""Readers: files with explicit schemas, bad-row modes, streams and the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

EVENTS_RAW = "event_id BIGINT, user_id BIGINT, event_type STRING, product_id BIGINT, device STRING, ts STRING"
MESSAGES = "topic STRING, partition INT, offset BIGINT, value STRING"


def read_json(spark: SparkSession, path: str, schema: str, mode: str = "PERMISSIVE") -> DataFrame:
    """JSON lines; PERMISSIVE keeps a broken line in ``_corrupt_record``, DROPMALFORMED
    leaves it out, FAILFAST stops."""
    if mode == "PERMISSIVE":
        schema += ", _corrupt_record STRING"
    return spark.read.schema(schema).option("mode", mode).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Files whose later versions have more columns, as one table."""
    return spark.read.option("mergeSchema", True).parquet(path)


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """New files of a folder as a stream; a stream always needs its schema up front."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def rate_stream(spark: SparkSession, rows_per_second: int) -> DataFrame:
    return spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()


def kafka_messages(spark: SparkSession, servers: str, topics: str, max_offsets: int | None = None) -> DataFrame:
    """Topics from the earliest offset as ``topic, partition, offset, value``.

    Needs the Kafka connector on the classpath; every consumer of these four columns
    also runs on ``file_stream(..., MESSAGES)``.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .option("startingOffsets", "earliest")
    )
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def describe_table(spark: SparkSession, table: str) -> list[tuple[str, str]]:
    return [(c.name, c.dataType) for c in spark.catalog.listColumns(table)]
