"""Gathering instructions: source rules, union, quality filters, dedup, sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import fixed
from ..functions import (
    only_allowed,
    script_share_above,
    seeded_int,
    seeded_share,
    settle,
    strip_text,
)
from ..functions.draws import BITS
from .late import dedup_written


def source_filter(
    df: DataFrame,
    dropped_keys: Sequence[str] = tuple(fixed.DROPPED_PROMPT_KEYS),
    halved_key: str = fixed.HALVED_PROMPT_KEY,
    min_score: float = fixed.MIN_SOURCE_SCORE,
    prompt_key: str = "system_prompt_key",
    row_seq: str = "row_seq",
    score: str = "score",
) -> DataFrame:
    """Rules of the scored multi-turn source.

    Drops listed prompt keys, every odd row of one key, and rows without a score
    of at least ``min_score``. A missing prompt key is kept.
    """
    key = F.coalesce(F.col(prompt_key), F.lit(""))
    value = F.col(score).cast("double")
    return df.where(
        ~key.isin(*dropped_keys)
        & ~((key == halved_key) & (F.col(row_seq) % 2 == 1))
        & value.isNotNull()
        & ~F.isnan(value)
        & (value >= min_score)
    )


def union_sources(
    sources: Sequence[tuple[str, DataFrame]],
    columns: Sequence[str] = ("instruction", "correct_answers", "incorrect_answers"),
    order: str = "position",
) -> DataFrame:
    """Union by column name; missing columns become null.

    Adds ``source`` and ``source_rank`` (position in the list). Each source
    brings an ``order`` column, its row order, that ``dedup_first`` uses.
    """
    parts = []
    for rank, (tag, df) in enumerate(sources):
        present = [c for c in (*columns, order) if c in df.columns]
        parts.append(
            df.select(*present, F.lit(tag).alias("source"), F.lit(rank).alias("source_rank"))
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    for column in columns:
        if column not in result.columns:
            result = result.withColumn(column, F.lit(None).cast("string"))
    return result


def quality_reason(
    text: Column,
    source: Column,
    min_length: int = fixed.MIN_INSTRUCTION_LENGTH,
    exempt_sources: Sequence[str] = tuple(fixed.ANSWERED_SOURCES),
    allowed_ranges=fixed.ALLOWED_RANGES,
    script_ranges=fixed.HAN_RANGES,
    min_share: float = fixed.MIN_SCRIPT_SHARE,
) -> Column:
    """First failing quality rule of an instruction, or null.

    Cheap rules come first.
    """
    return (
        F.when(text.isNull(), "null_text")
        .when((F.length(text) < min_length) & ~source.isin(*exempt_sources), "too_short")
        .when(text.contains(fixed.REPLACEMENT_CHAR), "replacement_char")
        .when(~only_allowed(text, allowed_ranges), "invalid_char")
        .when(~script_share_above(text, min_share, script_ranges), "script_share")
    )


def quality_filter(
    df: DataFrame, text: str = "instruction", source: str = "source", **rules
) -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejects with ``reject_reason``), each a filter over ``df``.

    When both are wanted from a source that is costly to read, write
    ``quality_tagged`` once and ``split_tagged`` the table.
    """
    reason = quality_reason(F.col(text), F.col(source), **rules)
    return df.where(reason.isNull()), split_tagged(quality_tagged(df, text, source, **rules))[1]


def quality_tagged(
    df: DataFrame, text: str = "instruction", source: str = "source", **rules
) -> DataFrame:
    """All rows with ``reject_reason``, null for those to keep."""
    return settle(df, df.columns, reject_reason=quality_reason(F.col(text), F.col(source), **rules))


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejects) of a tagged table."""
    reason = F.col("reject_reason")
    return tagged.where(reason.isNull()).drop("reject_reason"), tagged.where(reason.isNotNull())


def invalid_answered_instructions(
    df: DataFrame,
    sources: Sequence[str] = tuple(fixed.ANSWERED_SOURCES),
    text: str = "instruction",
    allowed_ranges=fixed.ALLOWED_RANGES,
    min_length: int = fixed.MIN_INSTRUCTION_LENGTH,
) -> DataFrame:
    """Audit view: rows of the exempt sources that only the allow-list rejects."""
    reason = quality_reason(
        F.col(text), F.col("source"), min_length, sources, allowed_ranges
    )
    return df.where(F.col("source").isin(*sources) & (reason == "invalid_char"))


def dedup_first(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """Keep the first row per ``key`` in ``order``; ties go by content.

    A minimum over a struct, so copies are reduced before the shuffle and a key
    that fills a third of the table reaches the reducer as one row per map task.
    The hash leads the grouping key because sorting long texts that share their
    beginnings would compare them in full.
    """
    rest = [c for c in df.columns if c != key and c not in order]
    first = F.min(F.struct(*order, *rest)).alias("first")
    return (
        df.groupBy(F.xxhash64(key).alias("_hash"), key)
        .agg(first)
        .select(*[F.col(c) if c == key else F.col(f"first.{c}").alias(c) for c in df.columns])
    )


def strip_and_dedup(
    df: DataFrame, text: str = "instruction", order: Sequence[str] = ("source_rank", "position")
) -> DataFrame:
    """Strip the instruction, then keep its first occurrence over all sources."""
    return dedup_first(df.withColumn(text, strip_text(F.col(text))), text, order)


def strip_and_dedup_written(
    table: DataFrame, text: str = "instruction", order: Sequence[str] = ("source_rank", "position")
) -> DataFrame:
    """``strip_and_dedup`` of a table read from parquet files, whose texts move only once."""
    key = strip_text(F.col(text))
    kept = dedup_written(table, key, order, lambda odd: strip_and_dedup(odd, text, order))
    return kept.withColumn(text, key)


def with_prompt_id(df: DataFrame, text: str = "instruction") -> DataFrame:
    """``prompt_id`` = md5 of the instruction, unique after dedup."""
    return df.withColumn("prompt_id", F.md5(text))


def bucket_bits_for(rows: int) -> int:
    """Digest bits for ``stratified_sample`` that leave some 4,096 rows in a bucket."""
    return min(30, max(16, (rows >> 12).bit_length()))


def stratified_sample(
    df: DataFrame,
    rates: dict[str, float],
    key: str,
    by: str = "source",
    seed: int = fixed.SAMPLE_SEED,
    mode: str = "exact",
    bucket_bits: int = 16,
) -> DataFrame:
    """Sample without replacement per ``by``; values without a rate are left out.

    Rows are ranked by a seeded digest of ``key``, which must be unique. ``fast``
    keeps digests below rate x range: no shuffle, size right on average.
    ``exact`` keeps half-even round(rate x n) rows. It never ranks a whole source:
    a histogram of digest buckets shows in which bucket each source's cut falls,
    only rows of that bucket are ranked (keys alone), and the rows themselves go
    through a filter against one threshold per source. ``bucket_bits`` should follow
    the number of rows (``bucket_bits_for``), so that a bucket stays small. ``df`` is
    read up to three times, so pass a stage table when it is costly.
    """
    for value, rate in rates.items():
        if not 0 <= rate <= 1:
            raise ValueError(f"rate of {value!r} must be within 0..1, got {rate}")
    digest = seeded_int(seed, F.col(key))
    whole = [v for v, rate in rates.items() if rate == 1]
    part = {v: rate for v, rate in rates.items() if rate < 1}
    keep_whole = F.col(by).isin(*whole) if whole else F.lit(False)
    if not part:
        return df.where(keep_whole)

    if mode == "fast":
        keep = keep_whole
        for value, rate in part.items():
            keep = keep | ((F.col(by) == value) & seeded_share(digest, rate))
        return df.where(keep)
    if mode != "exact":
        raise ValueError("mode must be exact or fast")

    rate_of = F.create_map(*[F.lit(x) for v, r in part.items() for x in (v, float(r))])
    ranked = df.where(F.col(by).isin(*part)).select(
        by, digest.alias("digest"), F.col(key).alias("rank_key"),
        F.shiftright(digest, BITS - bucket_bits).alias("bucket"),
    )
    upto = Window.partitionBy(by).orderBy("bucket")
    histogram = ranked.groupBy(by, "bucket").agg(F.count(F.lit(1)).alias("n"))
    cut = (
        histogram.withColumn("below", F.sum("n").over(upto) - F.col("n"))
        .withColumn("total", F.sum("n").over(Window.partitionBy(by)))
        .withColumn("take", F.bround(F.element_at(rate_of, F.col(by)) * F.col("total")))
        .withColumn("need", (F.col("take") - F.col("below")).cast("bigint"))
        .where((F.col("need") > 0) & (F.col("need") <= F.col("n")))
        .select(by, "bucket", "need")
    )
    in_bucket = Window.partitionBy(by).orderBy("digest", "rank_key")
    # One row per rated value, so the broadcast is bounded by the rates given.
    threshold = (
        ranked.join(F.broadcast(cut), [by, "bucket"])
        .withColumn("rank", F.row_number().over(in_bucket))
        .where(F.col("rank") == F.col("need"))
        .select(by, F.struct("digest", "rank_key").alias("last"))
    )
    return (
        df.where(F.col(by).isin(*rates))
        .join(F.broadcast(threshold), by, "left")
        .where(keep_whole | (F.struct(digest.alias("digest"), F.col(key).alias("rank_key")) <= F.col("last")))
        .select(*df.columns)
    )


def sample_fraction(df: DataFrame, fraction: float, key: str, seed=0) -> DataFrame:
    """A reproducible share of all rows, for trial runs; a plain filter."""
    return df.where(seeded_share(seeded_int(seed, F.col(key)), fraction))


def count_by_source(df: DataFrame, by: str = "source") -> DataFrame:
    """Rows per source, most first."""
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by)
