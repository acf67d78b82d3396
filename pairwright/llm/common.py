"""Helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.plans.stages import stage_table

# A key with more than this share of all rows is heavy; there are at most
# 1 / HEAVY_SHARE heavy keys, however large the input is.
HEAVY_SHARE = 1 / 2000


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def stage(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    ``batch_rows`` bounds the rows that the tasks of this job are given at a time: executors
    and workers both hold a batch, which of long rows are many megabytes.
    """
    if batch_rows is None:
        return stage_table(df, name)
    conf = df.sparkSession.conf
    before = conf.get(BATCH_ROWS)
    conf.set(BATCH_ROWS, str(min(batch_rows, int(before)) if int(before) > 0 else batch_rows))
    try:
        return stage_table(df, name)
    finally:
        conf.set(BATCH_ROWS, before)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores in front until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def join_by_size(rows: DataFrame, groups: DataFrame, on: str, size: str, total: int) -> DataFrame:
    """Inner join of ``rows`` with one row per group, safe for groups of any size.

    ``groups`` must be a written table with the number of rows per group in
    ``size``. Groups above ``HEAVY_SHARE`` of ``total`` rows number at most
    1 / HEAVY_SHARE and are broadcast; all others meet their rows in a shuffle,
    where no key has more than that share.
    """
    bound = total * HEAVY_SHARE
    heavy = groups.where(F.col(size) > bound)
    light = groups.where(F.col(size) <= bound)
    names = heavy.select(F.col(on))
    by_broadcast = rows.join(F.broadcast(heavy), on)
    by_shuffle = rows.join(F.broadcast(names), on, "left_anti").join(light, on)
    return by_broadcast.unionByName(by_shuffle)


# Rows a side may have to be broadcast: two numbers and a flag each, under 64 MB.
BROADCAST_ROWS = 1_000_000


def with_text_hash(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """Adds xxhash64 of the text under a free name, and gives that name."""
    name = free_name(docs, "text_hash")
    return docs.withColumn(name, F.xxhash64(text)), name


def meet(docs: DataFrame, hash_name: str, keys: DataFrame, how: str, doc_id: str = "doc_id") -> DataFrame:
    """Join documents to ``keys`` (doc_id, text_hash, ...), null ids included.

    ``keys`` must be a written table with one row per key. It is counted: up to
    BROADCAST_ROWS it is broadcast, beyond that both sides are shuffled.
    """
    renamed = keys.withColumnRenamed("doc_id", "_key_id").withColumnRenamed("text_hash", "_key_hash")
    if keys.count() <= BROADCAST_ROWS:
        renamed = F.broadcast(renamed)
    same = docs[doc_id].eqNullSafe(renamed["_key_id"]) & (docs[hash_name] == renamed["_key_hash"])
    return docs.join(renamed, same, how).drop("_key_id", "_key_hash")


def keep_documents(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose decision (doc_id, text_hash, kept) is to stay.

    Documents without a decision stay. Rows with equal doc_id and text are one
    document: it stays once if any of their decisions is to stay.
    """
    keys = decisions.groupBy("doc_id", "text_hash").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n")
    )
    keys = stage(keys.where("not kept or n > 1"), "decisions")
    columns = docs.columns
    hashed, name = with_text_hash(docs)
    rest = meet(hashed, name, keys.select("doc_id", "text_hash"), "left_anti")
    repeated = stage(keys.where("kept").select("doc_id", "text_hash"), "repeated")
    once = meet(hashed, name, repeated, "left_semi").dropDuplicates(["doc_id", name])
    return rest.unionByName(once).select(*columns)


def repeat_documents(docs: DataFrame, times: DataFrame) -> DataFrame:
    """Each document as often as ``times`` (doc_id, text_hash, times) says.

    Rows with equal doc_id and text are one document that gets the sum of their
    times.
    """
    keys = stage(
        times.groupBy("doc_id", "text_hash").agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("n"))
        .where("times > 0"),
        "times",
    )
    columns = docs.columns
    hashed, name = with_text_hash(docs)
    number = free_name(hashed, "times")

    def taken(part: DataFrame) -> DataFrame:
        return meet(hashed, name, part.select("doc_id", "text_hash", F.col("times").alias(number)), "inner")

    single = taken(keys.where("n = 1"))
    repeated = taken(stage(keys.where("n > 1"), "repeated")).dropDuplicates(["doc_id", name])
    every = single.unionByName(repeated)
    copies = F.explode(F.array_repeat(F.lit(0), F.col(number).cast("int")))
    return every.withColumn(free_name(every, "copy"), copies).select(*columns)
