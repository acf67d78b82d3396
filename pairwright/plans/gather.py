"""Gather instructions: sources to a deduplicated, sampled prompt table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..config import fixed
from ..operators.instructions import (
    bucket_bits_for,
    quality_filter,
    quality_tagged,
    split_tagged,
    stratified_sample,
    strip_and_dedup,
    strip_and_dedup_written,
    union_sources,
    with_prompt_id,
)
from .stages import stage_table


def gather_instructions(
    sources: Sequence[tuple[str, DataFrame]],
    rates: dict[str, float] = fixed.SAMPLE_RATES,
    seed: int = fixed.SAMPLE_SEED,
    mode: str = "exact",
    stage: bool = True,
    quality: dict | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(sampled instructions, rejects).

    ``sources`` are (tag, DataFrame) in union order, single-source rules already
    applied, each with ``instruction`` and ``position``. With ``stage`` the sources
    are read once, into a table that holds kept rows and rejects, from which duplicates
    are removed by digest; the deduplicated table is written, because exact sampling
    reads it again.
    """
    if stage:
        tagged = stage_table(quality_tagged(union_sources(sources), **(quality or {})), "tagged")
        kept, rejects = split_tagged(tagged)
        unique = strip_and_dedup_written(kept)
    else:
        kept, rejects = quality_filter(union_sources(sources), **(quality or {}))
        unique = strip_and_dedup(kept)
    prompts = with_prompt_id(unique).select(
        "prompt_id", "instruction", "source", "correct_answers", "incorrect_answers"
    )
    bits = 16
    if stage:
        prompts = stage_table(prompts, "deduplicated")
        bits = bucket_bits_for(prompts.count())
    return stratified_sample(prompts, rates, "prompt_id", seed=seed, mode=mode, bucket_bits=bits), rejects
