"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document's key is an exponential draw divided by its quality weight. Within a
source the documents are taken in key order until their running size reaches the
source's budget. A budget above the source's size first takes the whole source
that many times; only the remaining fraction is selected by key.

The running size is found without sorting a source: sizes are summed per narrow
range of keys, the ranges are accumulated, and rows are ordered only inside the
one range of each source that holds the budget's end.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
RANGE_ROWS = 20_000  # rows of a source that may share a key range, about
FEW_SOURCES = 100_000


def word_count(text: Column) -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sources: DataFrame, share_halves: int = 3, most_times: int = 2) -> DataFrame:
    """Adds ``target`` to (source, source_size).

    Sources in code point order, null last, weigh WEIGHTS in turn and share
    ``share_halves`` / 2 of all sizes. No target exceeds ``most_times`` its
    source's size; what is above goes to the others by weight until none is
    above. That end is reached in one pass over the sources by growing
    size / weight: the sources at their limit are the first ones in that order.
    """
    # one row per source in one task; never a row per document
    every = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(every) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), turn + 1).cast("long")
    limit = F.col("source_size") * most_times
    ranked = sources.withColumn("weight", weight).withColumn("limit", limit)
    by_need = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_need.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    left = (
        F.sum("source_size").over(whole) * share_halves
        - 2 * F.coalesce(F.sum("limit").over(before), zero)
    )
    left_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero)
    level = ranked.withColumn("left", left).withColumn("left_weight", left_weight)
    free = F.col("limit") * 2 * F.col("left_weight") >= F.col("left") * F.col("weight")
    level = level.withColumn(
        "first", F.min(F.when(free, F.struct(F.col("limit") / F.col("weight"), F.col("source").isNull(),
                                             "source", "left", "left_weight"))).over(whole)
    )
    fair = F.col("weight") * (F.col("first.left") / 2.0) / F.col("first.left_weight")
    target = F.when(F.col("first").isNull(), F.col("limit").cast("double")).otherwise(
        F.least(F.col("limit").cast("double"), fair)
    )
    return level.select("source", "source_size", target.alias("target"))


def sampling_key(doc: Column, weight: Column, seed: str) -> Column:
    """Exponential draw over the weight, from a digest of seed and document."""
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(doc.cast("string"), F.lit(""))))
    draw = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return -F.log((draw + 1) / F.lit(float(16**13 + 1))) / weight


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = "mix",
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, times, taken, text_hash.

    ``size`` is the number of words (null text: 0), ``times`` how often the mix
    takes the whole document, ``taken`` = size * times. ``weights`` has doc_id
    and a positive ``weight``; documents without a row weigh 1, of several rows
    the largest counts. A null source is a source of its own. Draws depend on
    seed and doc_id only, so reruns agree; repeated doc_ids have equal keys and
    are told apart by their text. Documents of size 0 are taken with the key
    range they fall in, and in whole epochs only where no budget is left over. The document in which a budget ends is taken if that
    brings the source nearer to its target. Other columns are not looked at.
    An empty table gives an empty result.
    """
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("text_hash"),
    )
    if weights is not None:
        best = weights.groupBy(F.col(doc_id).alias("doc_id")).agg(F.max("weight").alias("weight"))
        sized = sized.join(best, "doc_id", "left")
        weight = F.coalesce("weight", F.lit(1.0))
    else:
        weight = F.lit(1.0)
    key = sampling_key(F.col("doc_id"), weight, seed)
    sized = stage(
        sized.select("doc_id", "source", "size", "text_hash", key.alias("key"),
                     F.monotonically_increasing_id().alias("rid")),
        "sizes",
    )
    totals = stage(
        sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n")),
        "sources",
    )
    count = totals.agg(F.max("n"), F.count(F.lit(1))).first()
    ranges = max(64, math.ceil((count[0] or 0) / RANGE_ROWS) * 2)
    few = count[1] <= FEW_SOURCES

    targets = stage(source_targets(totals.select("source", "source_size")), "targets")
    epochs = F.when(F.col("source_size") > 0,
                    F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = targets.withColumn("epochs", epochs).withColumn(
        "budget", F.col("target") - F.col("source_size") * F.col("epochs")
    )

    def with_source(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.withColumnRenamed("source", "_source")
        right = F.broadcast(right) if few else right
        return left.join(right, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")

    # a monotone map of the keys to [0, 1), close to even for weights near 1
    ranged = sized.withColumn(
        "range", F.floor((1 - F.exp(-F.col("key"))) * ranges).cast("int")
    )
    sums = ranged.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    per_source = Window.partitionBy("source").orderBy("range")
    sums = sums.withColumn(
        "start", F.sum("range_size").over(per_source.rowsBetween(Window.unboundedPreceding, -1))
    ).fillna(0, ["start"])
    cuts = with_source(sums, targets.select("source", "budget")).where(
        (F.col("budget") > 0) & (F.col("start") <= F.col("budget"))
        & (F.col("budget") < F.col("start") + F.col("range_size"))
    ).select("source", F.col("range").alias("cut"), "start")
    targets = targets.withColumnRenamed("source", "_s").join(
        cuts, F.col("_s").eqNullSafe(F.col("source")), "left"
    ).select(F.col("_s").alias("source"), "source_size", "target", "epochs", "budget", "cut", "start")
    rows = with_source(ranged, stage(targets, "cuts"))
    # no range holds the budget's end where the budget is 0 or the source is empty
    whole = rows.where(F.col("cut").isNull() | (F.col("range") != F.col("cut"))).withColumn(
        "extra", F.when(F.col("range") < F.col("cut"), 1).otherwise(0)
    )
    running = Window.partitionBy("source").orderBy("key", "doc_id", "text_hash", "rid").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    edge = rows.where(F.col("range") == F.col("cut")).withColumn(
        "middle", F.col("start") + F.sum("size").over(running) - F.col("size") / 2
    ).withColumn("extra", F.when(F.col("middle") <= F.col("budget"), 1).otherwise(0)).drop("middle")
    times = F.col("epochs") + F.col("extra")
    return whole.unionByName(edge).select(
        "doc_id", "source", "size", "source_size", "target", times.cast("long").alias("times"),
        (F.col("size") * times).cast("long").alias("taken"), "text_hash",
    )
