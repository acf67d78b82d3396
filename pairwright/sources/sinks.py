"""Sinks and stage locations."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a stage table in the shared folder of the session.

    The folder is ``spark.checkpoint.dir``. Only a local session may go without
    it: a machine-local folder on a cluster would be lost with its executor. The
    folder it then gets is removed when the program ends.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="pairwright-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        context.setCheckpointDir(folder)
        root = context.getCheckpointDir()
    return f"{root.rstrip('/')}/pairwright/{name}-{uuid.uuid4().hex}"


# Packed lines: a third of the time for a little more space.
QUICK = {"zlib.compress.level": "BEST_SPEED"}


def write_jsonl(
    df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none"
) -> None:
    """JSON lines; nulls are written, non-ASCII characters stay as they are."""
    options = {"ignoreNullFields": False, "compression": compression, **QUICK}
    df.write.mode(mode).options(**options).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "zstd") -> None:
    df.write.mode(mode).parquet(path, compression=compression)


def write_sharded(
    df: DataFrame, path: str, key: Column | None = None, shards: int = 10,
    mode: str = "errorifexists", files_per_shard: int | None = None, compression: str = "none",
) -> None:
    """JSON lines in ``shards`` directories ``shard=0`` ..., by a hash of ``key``.

    Without a key the rows keep the ``shard`` they were read from, so one job
    carries all shards of a stage over to the next stage's path.

    With ``files_per_shard`` the rows are dealt evenly to so many files in each
    shard, in one shuffle that knows its partitions: the rows are not computed once
    more to sample their range. Without it nothing moves: every task appends to the
    shards it has rows for, which suits inputs of few partitions.
    """
    if key is not None:
        df = df.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))
    if files_per_shard:
        others = [F.col(f"`{c}`") for c in df.columns]
        slot = F.pmod(F.xxhash64(*others, F.lit("file")), F.lit(files_per_shard))
        number = F.pmod(F.col("shard") * files_per_shard + slot, F.lit(shards * files_per_shard))
        df = df.repartitionById(shards * files_per_shard, F.coalesce(number.cast("int"), F.lit(0)))
    options = {"ignoreNullFields": False, "compression": compression, **QUICK}
    df.write.mode(mode).options(**options).partitionBy("shard").json(path)


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write a stage as a table bucketed and sorted by ``key``, and read it back.

    Stages bucketed alike on ``prompt_id`` join without moving rows again. The
    repartition matches the bucketing, so each task writes the buckets it owns.
    """
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .mode("overwrite")
        .saveAsTable(table)
    )
    return df.sparkSession.table(table)
