"""Completion planning: which models answer a prompt, under which system prompt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import fixed, texts
from ..functions import draw_k, draw_weighted, pick, seeded_int, seeded_share, settle, unpacked
from .requests import by_slot, messages, request_id, side_by_side, with_call_settings

STAGE = "completion"


def drawn_principle(source: Column, key: Column, slot, weights: dict, seed) -> Column:
    """Principle by source weights; null for a source without weights."""
    base = F.lit(None).cast("string")
    draw = seeded_int(seed, "principle", key, slot)
    profiles: dict[tuple, list[str]] = {}
    for tag, profile in weights.items():
        profiles.setdefault(tuple(profile.items()), []).append(tag)
    for profile, tags in profiles.items():
        base = F.when(source.isin(*tags), draw_weighted(dict(profile), draw)).otherwise(base)
    return base


def calibrated(principle: Column, key: Column, slot, seed) -> Column:
    """Some honesty draws become calibration."""
    swap = seeded_share(seeded_int(seed, "swap", key, slot), fixed.CALIBRATION_SWAP_RATE)
    return F.when((principle == "honesty") & swap, "verbalized_calibration").otherwise(principle)


def system_text(principle: Column, key: Column, slot, texts_by_principle: dict, seed) -> Column:
    """System prompt drawn uniformly among the texts of the principle."""
    draw = seeded_int(seed, "text", key, slot)
    result = F.lit(None).cast("string")
    for name, options in texts_by_principle.items():
        result = F.when(principle == name, pick(options, draw)).otherwise(result)
    return result


def plan_prompts(
    instructions: DataFrame,
    pool=tuple(fixed.MODEL_POOL),
    weights: dict = fixed.PRINCIPLE_WEIGHTS,
    texts_by_principle: dict = texts.PRINCIPLE_TEXTS,
    k: int = fixed.SLOTS,
    seed=0,
    strict: bool = False,
) -> DataFrame:
    """Add ``models`` and ``plan``: per slot (model, principle, custom_system_prompt).

    One row per prompt, no shuffle. ``strict`` raises on a source without
    weights; otherwise its principle is null and ``plan_rejects`` lists it.
    """
    prompt = F.col("prompt_id")
    source = F.col("source")
    if strict:
        known = source.isin(*weights)
        source = F.when(known, source).otherwise(
            F.raise_error(F.concat(F.lit("no principle weights for source "), source))
        )
    planned = instructions.withColumn("models", draw_k(list(pool), k, prompt, f"{seed}|models"))

    # Three passes, so that each draw is computed once however often it is used.
    def base(model: Column, slot: Column) -> Column:
        principle = drawn_principle(source, prompt, slot, weights, seed)
        return F.struct(model.alias("model"), principle.alias("principle"))

    def final(entry: Column, slot: Column) -> Column:
        return entry.withField("principle", calibrated(entry["principle"], prompt, slot, seed))

    def complete(entry: Column, slot: Column) -> Column:
        text = system_text(entry["principle"], prompt, slot, texts_by_principle, seed)
        return entry.withField("custom_system_prompt", text)

    plan = F.transform(F.transform(F.transform("models", base), final), complete)
    return settle(planned, instructions.columns, models=F.col("models"), plan=plan)


def plan_rejects(planned: DataFrame) -> DataFrame:
    """Prompts whose source has no principle weights."""
    return planned.where(F.exists("plan", lambda p: p["principle"].isNull())).select(
        "prompt_id", "source", F.lit("unknown_source").alias("reject_reason")
    )


def plan_completions(planned: DataFrame, pool: dict = fixed.MODEL_POOL) -> DataFrame:
    """One completion request per (prompt, slot), from ``plan_prompts``."""
    slots = planned.where(~F.exists("plan", lambda p: p["principle"].isNull())).select(
        "prompt_id", "instruction", F.posexplode("plan").alias("slot", "p")
    )
    requests = slots.select(
        request_id(STAGE, "prompt_id", "slot"),
        "prompt_id",
        "slot",
        F.col("p.model").alias("model"),
        F.col("p.principle").alias("principle"),
        F.col("p.custom_system_prompt").alias("custom_system_prompt"),
        messages(F.col("p.custom_system_prompt"), F.col("instruction")),
    )
    return with_call_settings(requests, pool, fixed.COMPLETION_MAX_TOKENS)


def assemble_completions(
    planned: DataFrame, responses: DataFrame, k: int = fixed.SLOTS, settled: bool = False,
    partitions: int | None = None,
) -> DataFrame:
    """Prompts with ``completions`` in drawn order; a missing response is ``''``.

    ``responses`` needs (prompt_id, slot, response). Responses meet in a fixed
    number of aggregates, one per slot, never in a list that could grow. ``settled``
    responses (``settled_calls`` by prompt_id and slot) hold each call once, are dealt to
    ``partitions`` and may be ``packed``; those are unpacked behind the join.
    """
    if settled:
        names = {f"response_{i}": i for i in range(k)}
        answered = side_by_side(responses, "prompt_id", "slot", names, "response", partitions)
    else:
        text = F.coalesce("response", F.lit(""))
        answered = responses.groupBy("prompt_id").agg(
            *by_slot("slot", text, k, "response", text, text == "")
        )
    value = unpacked if dict(responses.dtypes)["response"] == "binary" else (lambda text: text)
    texts_in_order = F.array(*[F.coalesce(value(F.col(f"response_{i}")), F.lit("")) for i in range(k)])
    joined = planned.join(answered, "prompt_id", "left")
    completions = F.zip_with(
        "plan",
        texts_in_order,
        lambda p, text: F.struct(
            p["model"].alias("model"),
            p["principle"].alias("principle"),
            p["custom_system_prompt"].alias("custom_system_prompt"),
            text.alias("response"),
        ),
    )
    return joined.withColumn("completions", completions).drop(
        "plan", *[f"response_{i}" for i in range(k)]
    )
