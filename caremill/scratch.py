"""The folder that all machines share, and tables that are written there between stages."""

from __future__ import annotations

import gc
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: The folder that stands in for the shared one in local sessions without a setting.
_LOCAL: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A new folder's path below the one that the cluster names in spark.checkpoint.dir. Only a local session may leave it unset."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        if not _LOCAL:
            _LOCAL.append(f"file://{tempfile.mkdtemp(prefix='spark-')}")
        top = _LOCAL[0]
    return f"{top.rstrip('/')}/tables-{uuid.uuid4().hex}"


def bucketed(df: DataFrame, column: str, buckets: int | None = None) -> DataFrame:
    """The same rows, written down in buckets of a column and sorted by it in each: joins and groups by keys that begin with
    this column need no shuffle then. Tables that are to meet have the same number of buckets, by default the session's
    shuffle partitions. See by_one_key()
    for joins on more columns."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"caremill_{uuid.uuid4().hex}"
    df.repartition(n, column).write.option("path", scratch(spark)).bucketBy(n, column).sortBy(column).saveAsTable(name)
    return spark.table(name)


@contextmanager
def by_one_key(spark: SparkSession):
    """While it lasts, tables that are laid out by one column join on more columns as they are."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    was = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def release(spark: SparkSession) -> None:
    """Let go of finished stages: Spark deletes their shuffle files, and the driver their plans, when its garbage is collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def settled(df: DataFrame) -> DataFrame:
    """The same rows, written down once and read by all that follows."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
