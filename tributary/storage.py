"""Where jobs put written tables and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession


@lru_cache(maxsize=None)
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="tributary-")


def shared_root(spark: SparkSession) -> str:
    """Folder shared by all executors, named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_root(spark.sparkContext.applicationId)


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name; runs never share or clear one."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete one file or folder, on whichever file system it lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """SQL settings that hold inside the block only."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


#: Executors drop the shuffle files of a write when it ends; else they stay until the driver's next garbage collection.
DROP_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def write_and_read(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Cut lineage with a written table: survives the loss of any executor, and what was shuffled for it is dropped."""
    path = run_path(df.sparkSession, name)
    writer = df.write.mode("error")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with settings(df.sparkSession, DROP_SHUFFLES):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
