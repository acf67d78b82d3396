"""Score, pair, export."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.instructions import count_by_source
from ..operators.judgements import judge_ratings
from ..operators.pairs import binarized, make_pairs
from ..operators.scoring import (
    gather_ratings,
    gathered_from_annotated,
    scored_completions,
    weighted_score,
)
from ..operators.training_rows import format_training_rows, within_length
from .publish import publish, read_published


def build_preferences(
    completions: DataFrame, judge_responses: DataFrame, seed=0, mode: str = "exact"
) -> DataFrame:
    """Judge answers and completions -> preference pairs.

    Ratings are shuffled once as short strings; texts once, in the final join.
    """
    scored = weighted_score(gather_ratings(judge_ratings(judge_responses)), mode=mode)
    score = "tenths" if mode == "exact" else "scores"
    return make_pairs(scored, completions, seed, score)


PREFERENCE_OUTPUTS = [
    f"{name}.{kind}" for name in ("annotations_weighted_sum", "annotations_binarized") for kind in ("parquet", "jsonl")
]


def write_preferences(
    annotated: DataFrame, root: str, seed=0, mode: str = "exact", version: str | None = None,
    after: Callable[[str], None] | None = None, compression: str = "none",
) -> DataFrame:
    """Annotated completions -> weighted and binarized files; returns pairs per source.

    ``annotated`` comes from ``read_annotations`` or ``attach_annotations``. Publishes
    ``annotations_weighted_sum`` and ``annotations_binarized``, each as JSON lines and
    as parquet, together (``publish``): a run that died is simply run again, and with
    the same ``version`` keeps what it had finished. ``annotated`` is read once: the
    pairs come from the weighted output, which holds every prompt that can have one.
    """
    spark = annotated.sparkSession
    if "prompt_id" not in annotated.columns:
        annotated = annotated.withColumn("prompt_id", F.md5("instruction"))
    scored = lambda rows: weighted_score(gathered_from_annotated(rows), mode=mode)
    score = "tenths" if mode == "exact" else "scores"
    version = version or uuid.uuid4().hex
    written = lambda name: spark.read.parquet(f"{root}/{version}/{name}.parquet")
    first = {
        "annotations_weighted_sum": lambda: scored_completions(scored(annotated)),
        "annotations_binarized": lambda: binarized(
            make_pairs(scored(written("annotations_weighted_sum")), seed=seed, score=score)
        ),
    }
    outputs = {}
    for name, make in first.items():
        outputs[f"{name}.parquet"] = make
        outputs[f"{name}.jsonl"] = lambda name=name: written(name)
    publish(spark, root, outputs, version, after, compression)
    return count_by_source(read_published(spark, root, "annotations_binarized.parquet"))


def export_training_rows(pairs: DataFrame, family: str = "qwen", **length_options) -> DataFrame:
    """Pairs -> formatted rows within the length budget."""
    return within_length(format_training_rows(pairs, family), family=family, **length_options)
