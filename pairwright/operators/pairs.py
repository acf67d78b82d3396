"""Chosen/rejected pairs from scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import fixed
from ..functions import seeded_int, strip_text
from .scoring import has_all_responses


def pick_slots(scored: DataFrame, seed=0, score: str = "tenths") -> DataFrame:
    """Add ``chosen_slot`` and ``rejected_slot``; prompts without a pair drop out.

    Chosen: the highest score, first slot on ties. Rejected: a seeded draw among
    the strictly lower ones. Row-level: the slots of a prompt sit in one array.
    """
    values = F.col(score)
    best = F.array_max(values)
    lower = F.filter(
        F.transform(
            values,
            lambda v, slot: F.struct(
                seeded_int(seed, "rejected", F.col("prompt_id"), slot).alias("draw"),
                slot.alias("slot"),
                (v < best).alias("lower"),
            ),
        ),
        lambda entry: entry["lower"],
    )
    return (
        scored.where(F.col("score_status") == "ok")
        .where(F.array_min(values) < best)
        .withColumn("chosen_slot", (F.array_position(values, best) - 1).cast("int"))
        .withColumn("rejected_slot", F.array_min(lower)["slot"])
    )


def rating_record(slot: Column) -> Column:
    """Score and the four ratings of one slot."""
    return F.struct(
        F.get("scores", slot).alias("overall_score"),
        *[
            F.get(F.col("ratings")[aspect], slot).alias(aspect)
            for aspect in fixed.RATING_RECORD_ORDER
        ],
    )


def _of_slot(field: str, slot: Column) -> Column:
    # Field first, slot second: only the named fields are read from the files.
    return F.get(F.col("completions")[field], slot)


def _paired(scored: DataFrame, completions: DataFrame | None, seed, score: str) -> DataFrame:
    picked = pick_slots(scored, seed, score)
    if completions is None:
        return picked.where(has_all_responses(F.col("completions")))
    full = completions.where(has_all_responses(F.col("completions")))
    # Late join: until here only ids, ratings and slots have moved.
    return picked.join(full, "prompt_id")


def make_pairs(
    scored: DataFrame, completions: DataFrame | None = None, seed=0, score: str = "tenths"
) -> DataFrame:
    """Pairs with stripped texts and rating records.

    Give ``completions`` when ``scored`` holds no texts; they are joined on
    ``prompt_id`` after the pick. Use ``score="scores"`` with ``float_compat``.
    """
    chosen, rejected = F.col("chosen_slot"), F.col("rejected_slot")
    return _paired(scored, completions, seed, score).select(
        "prompt_id",
        "instruction",
        "source",
        strip_text(_of_slot("response", chosen)).alias("chosen_response"),
        strip_text(_of_slot("response", rejected)).alias("rejected_response"),
        rating_record(chosen).alias("chosen_rating"),
        rating_record(rejected).alias("rejected_rating"),
    )


def make_chat_pairs(
    scored: DataFrame,
    completions: DataFrame | None = None,
    seed=0,
    score: str = "tenths",
    response_role: str = "assistant",
) -> DataFrame:
    """Pairs as chat messages: system prompt and (unstripped) response."""

    def chat(slot: Column) -> Column:
        return F.array(
            F.struct(
                F.lit("system").alias("role"),
                _of_slot("custom_system_prompt", slot).alias("content"),
            ),
            F.struct(
                F.lit(response_role).alias("role"), _of_slot("response", slot).alias("content")
            ),
        )

    chosen, rejected = F.col("chosen_slot"), F.col("rejected_slot")
    return _paired(scored, completions, seed, score).select(
        "prompt_id",
        "instruction",
        "source",
        chat(chosen).alias("chosen_response"),
        chat(rejected).alias("rejected_response"),
        rating_record(chosen).alias("chosen_rating"),
        rating_record(rejected).alias("rejected_rating"),
    )


def binarized(pairs: DataFrame) -> DataFrame:
    """The six columns of the binarized output."""
    return pairs.select(
        "instruction", "source", "chosen_response", "rejected_response",
        "chosen_rating", "rejected_rating",
    )
