"""Session settings and stage tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import stage_path

# Settings the engine relies on or profits from; sizes stay with the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def open_session(app: str = "pairwright", master: str | None = None, **settings) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def stage_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back: later steps start from files.

    A written table in the shared folder survives lost executors, is pruned by
    column when read again, and cuts the lineage. Stages are many and hold long texts,
    so they are packed with Zstandard. Runs a job.
    """
    spark = df.sparkSession
    target = path or stage_path(spark, name)
    df.write.option("compression", "zstd").parquet(target)
    return spark.read.schema(df.schema).parquet(target)


def stage_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """``stage_table`` in buckets of ``key``: tables staged alike meet by it without moving.

    Rows are written where they are, so deal them by the key to so many partitions before
    (or read them from a table staged alike): a task writes a file for each bucket it has
    rows of. Few open files need no sort of whole rows by bucket in front of them.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    before = spark.conf.get(OPEN_FILES)
    spark.conf.set(OPEN_FILES, "16")
    try:
        df.write.bucketBy(buckets, key).option("compression", "zstd").option(
            "path", stage_path(spark, name)).saveAsTable(table)
    finally:
        spark.conf.set(OPEN_FILES, before)
    return spark.table(table)


def write_counted(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Write parquet and return the row count, taken while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode(mode).parquet(path)
    return seen.get["n"]
