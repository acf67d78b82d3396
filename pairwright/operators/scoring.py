"""Scores from ratings.

Ratings of a prompt come together once, by ``prompt_id``; after that every rule
is an array expression on one row, so it needs no window and no further shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import fixed
from ..functions import settle, to_ascii_digits
from .requests import side_by_side


def gather_ratings(
    ratings: DataFrame, aspects: Sequence[str] = tuple(fixed.ASPECTS)
) -> DataFrame:
    """One row per prompt: ``ratings`` struct with an array of ratings per aspect.

    Fixed aggregates per aspect, so the group size does not matter. Of repeated
    calls one counts, the same as in ``attach_annotations``.
    """
    return (
        ratings.groupBy("prompt_id")
        .agg(*[_of_aspect(ratings, a, "ratings").alias(a) for a in aspects])
        .select("prompt_id", F.struct(*aspects).alias("ratings"))
    )


def _of_aspect(parsed: DataFrame, aspect: str, value: str) -> Column:
    """Aggregate: ``value`` of the call that counts for an aspect.

    A call that parsed comes before one that did not, then the smallest digest of
    the raw answer decides.
    """
    if "answer_md5" in parsed.columns:
        digest = F.col("answer_md5")
    elif "response" in parsed.columns:
        digest = F.md5(F.coalesce("response", F.lit("")))
    else:
        digest = F.md5(F.to_json(F.struct(value)))
    kept = F.struct(F.col(value).isNull().alias("poor"), digest.alias("digest"), F.col(value).alias("value"))
    return F.min(F.when(F.col("aspect") == aspect, kept))["value"]


def _missing(ratings: Column, aspects) -> Column:
    absent = F.lit(False)
    for aspect in aspects:
        absent = absent | ratings[aspect].isNull()
    return absent


def _not_applicable(ratings: Column, aspects) -> Column:
    found = F.lit(False)
    for aspect in aspects:
        here = F.exists(ratings[aspect], lambda r: r.contains(fixed.NOT_APPLICABLE))
        found = found | F.coalesce(here, F.lit(False))
    return found


def weighted_score(
    gathered: DataFrame,
    weights: dict[str, int] = fixed.WEIGHT_TENTHS,
    optional_aspects: Sequence[str] = tuple(fixed.OPTIONAL_ASPECTS),
    mode: str = "exact",
) -> DataFrame:
    """Add ``score_status``, ``tenths``, ``scores`` (per slot) and ``optional_dropped``.

    An N/A in a required aspect of any slot leaves the prompt without scores; an
    N/A in an optional aspect of any slot leaves that aspect out for all slots,
    without re-normalising. ``exact`` sums integer tenths. ``float_compat`` adds
    doubles in the order of ``weights``, where equal totals may differ in the
    last bit; ``scores`` then decides ties.
    """
    if mode not in ("exact", "float_compat"):
        raise ValueError("mode must be exact or float_compat")
    ratings = F.col("ratings")
    required = [a for a in weights if a not in optional_aspects]
    optional = [a for a in weights if a in optional_aspects]

    def number(aspect: str) -> Column:
        return F.transform(ratings[aspect], lambda r: to_ascii_digits(r).try_cast("bigint"))

    values = {a: F.col(f"_n.{a}") for a in weights}
    dropped = F.col("optional_dropped")
    numbered = gathered.withColumn(
        "_n", F.struct(*[number(a).alias(a) for a in weights])
    ).withColumn("optional_dropped", _not_applicable(ratings, optional))
    unreadable = F.lit(False)
    for aspect in weights:
        unread = F.exists(values[aspect], lambda v: v.isNull())
        unreadable = unreadable | (unread & ~dropped if aspect in optional else unread)
    status = (
        F.when(_missing(ratings, weights), "missing_annotation")
        .when(_not_applicable(ratings, required), "required_not_applicable")
        .when(unreadable, "rating_out_of_range")
        .otherwise("ok")
    )

    def add(total: Column, aspect: str, term) -> Column:
        plus = lambda t, v: t + term(v, weights[aspect])
        if aspect not in optional:
            return F.zip_with(total, values[aspect], plus)
        return F.zip_with(
            total, values[aspect], lambda t, v: F.when(dropped, t).otherwise(plus(t, v))
        )

    def fold(start: Column, term) -> Column:
        total = F.transform(values[required[0]], lambda _: start)
        for aspect in weights:
            total = add(total, aspect, term)
        return total

    tenths = fold(F.lit(0).cast("bigint"), lambda v, w: v * w)
    if mode == "exact":
        scores = F.transform("tenths", lambda t: t / F.lit(10.0))
    else:
        scores = fold(F.lit(0.0), lambda v, w: v.cast("double") * F.lit(w / 10))
    ok = F.col("score_status") == "ok"
    summed = numbered.withColumn("score_status", status).withColumn(
        "tenths", F.when(ok, tenths)
    ).withColumn("scores", F.when(ok, scores))
    names = ["optional_dropped", "score_status", "tenths", "scores"]
    return settle(summed, gathered.columns, **{name: F.col(name) for name in names})


def not_applicable_counts(ratings: DataFrame) -> DataFrame:
    """N/A ratings per aspect, from ``judge_ratings``: no rationale is read for it.

    Long annotations, one ``rating`` a row, do as well.
    """
    if "ratings" in ratings.columns:
        ratings = ratings.where("parse_status = 'ok'").select("aspect", F.explode("ratings").alias("rating"))
    return ratings.groupBy("aspect").agg(
        F.count_if(F.contains("rating", F.lit(fixed.NOT_APPLICABLE))).alias("n_not_applicable"),
        F.count(F.lit(1)).alias("n_ratings"),
    )


def has_all_responses(completions: Column, k: int = fixed.SLOTS) -> Column:
    """True when all ``k`` slots hold a non-empty response."""
    # The array of one field, not of whole entries: the scan then reads that field.
    responses = completions["response"]
    return (F.size(responses) == k) & F.forall(
        responses, lambda text: F.coalesce(text, F.lit("")) != ""
    )


def annotation_entry(aspect: str, section: Column) -> Column:
    """An annotation as written to files, with the field names used there."""
    if aspect in fixed.TYPED_ASPECTS:
        return F.struct(
            section["rating"].alias("Rating"),
            section["types"].alias("Type"),
            section["rationale_for_type"].alias("Rationale for type"),
            section["rationale_for_rating"].alias("Rationale for rating"),
        )
    return F.struct(section["rating"].alias("Rating"), section["rationale"].alias("Rationale"))


def attach_annotations(
    completions: DataFrame, parsed: DataFrame, aspects: Sequence[str] = tuple(fixed.ASPECTS),
    settled: bool = False, dealt: bool = False, partitions: int | None = None,
) -> DataFrame:
    """Completions with ``annotations.<aspect>`` in every slot, in file layout.

    A call that did not parse leaves its aspect null in all slots. ``settled`` calls
    (``judgements.settled_judgements``) are there once for each prompt and aspect. Where
    both tables are ``dealt`` to as many buckets by prompt (``stage_bucketed``), none moves;
    where only the completions are, the calls are dealt to as many ``partitions``.
    """
    if settled:
        names = {f"_{a}": a for a in aspects}
        sections = side_by_side(parsed, "prompt_id", "aspect", names, "sections", partitions, dealt)
    else:
        sections = parsed.groupBy("prompt_id").agg(*[
            _of_aspect(parsed, a, "sections").alias(f"_{a}") for a in aspects
        ])

    def one(completion: Column, slot: Column) -> Column:
        entries = []
        for aspect in aspects:
            section = F.get(F.col(f"_{aspect}"), slot)
            entries.append(
                F.when(section.isNotNull(), annotation_entry(aspect, section)).alias(aspect)
            )
        return completion.withField("annotations", F.struct(*entries))

    others = [c for c in completions.columns if c != "completions"]
    joined = completions.join(sections, "prompt_id", "left")
    return settle(joined, others, completions=F.transform("completions", one))


def gathered_from_annotated(
    annotated: DataFrame, aspects: Sequence[str] = tuple(fixed.ASPECTS), k: int = fixed.SLOTS
) -> DataFrame:
    """``ratings`` struct of rows that already hold their annotations. No shuffle."""

    def per_aspect(aspect: str) -> Column:
        ratings = F.col("completions")["annotations"][aspect]["Rating"]
        complete = (F.size(ratings) == k) & F.forall(ratings, lambda r: r.isNotNull())
        return F.when(complete, ratings).alias(aspect)

    return annotated.withColumn("ratings", F.struct(*[per_aspect(a) for a in aspects]))


def scored_completions(scored: DataFrame) -> DataFrame:
    """Put ``overall_score`` into every slot; rows without scores are dropped."""
    return (
        scored.where(
            (F.col("score_status") == "ok") & has_all_responses(F.col("completions"))
        )
        .withColumn(
            "completions",
            F.zip_with(
                "completions", "scores", lambda c, s: c.withField("overall_score", s)
            ),
        )
        .drop("ratings", "tenths", "scores", "score_status", "optional_dropped")
    )


def incomplete_reasons(completions: DataFrame, scored: DataFrame) -> DataFrame:
    """Prompts that get no score, with the first reason why."""
    reason = (
        F.when(F.col("score_status").isNull(), "missing_annotation")
        .when(F.col("score_status") == "missing_annotation", "missing_annotation")
        .when(~has_all_responses(F.col("completions")), "empty_response")
        .when(F.col("score_status") != "ok", F.col("score_status"))
    )
    return (
        completions.select("prompt_id", "completions")
        .join(scored.select("prompt_id", "score_status"), "prompt_id", "left")
        .select("prompt_id", reason.alias("reject_reason"))
        .where(F.col("reject_reason").isNotNull())
    )
