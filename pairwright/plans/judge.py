"""Complete and judge: prompts to annotated completions, with a user's model call."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.completions import assemble_completions, plan_completions, plan_prompts
from ..operators.critiques import attach_critiques, collect_critiques, critique_rejects, parse_critiques, plan_critiques
from ..operators.judgements import judgement_rejects, parse_judgements, plan_judgements, settled_judgements
from ..operators.late import settled_calls
from ..operators.requests import failed, infer_into
from ..operators.scoring import attach_annotations
from ..sources.sinks import write_sharded


def _done(response_path: str, rows: DataFrame, render, answer, part: str, options: dict) -> DataFrame:
    return infer_into(
        rows, answer, response_path, render=render, keep=("request_id", "prompt_id", part), **options
    )


def _fresh(df: DataFrame, path: str) -> DataFrame:
    """Write a derived stage anew and read it back; what it is made from lies elsewhere."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def complete_and_judge(
    instructions: DataFrame,
    answer: Callable[[dict], str],
    root: str,
    seed=0,
    **infer_options,
) -> dict[str, DataFrame]:
    """Completions, parsed annotations and judgement rejects.

    Every stage is a table under ``root``; responses are appended to theirs in
    committed batches, so a second call with the same root only asks for what is
    still missing or has failed. ``failed_completions`` and ``failed_judgements``
    list the calls that have only failed so far; ``annotated`` holds the completions
    with their annotations, as ``write_preferences`` takes them.
    """
    spark = instructions.sparkSession
    # written before it is used, so that sampling and drawing are done once
    planned = _fresh(plan_prompts(instructions, seed=seed), f"{root}/planned")
    answers = _done(
        f"{root}/completion_responses", planned, plan_completions, answer, "slot", infer_options
    )
    completions = _fresh(assemble_completions(planned, settled_calls(answers, ("prompt_id", "slot")), settled=True), f"{root}/completions")
    judged = _done(
        f"{root}/judge_responses", completions, plan_judgements, answer, "aspect", infer_options
    )
    parsed = _fresh(parse_judgements(settled_judgements(judged)), f"{root}/annotations")
    annotated = _fresh(attach_annotations(completions, parsed, settled=True), f"{root}/annotated")
    return {
        "completions": completions,
        "judge_responses": judged,
        "annotations": parsed,
        "annotated": annotated,
        "rejects": judgement_rejects(parsed),
        "failed_completions": failed(spark.read.parquet(f"{root}/completion_responses")),
        "failed_judgements": failed(spark.read.parquet(f"{root}/judge_responses")),
    }


def critique_completions(
    completions: DataFrame, answer: Callable[[dict], str], root: str, **infer_options
) -> dict[str, DataFrame]:
    """Completions with their critiques, and the answers that did not parse.

    Writes ``critiqued`` under ``root``, ten shards of JSON lines.
    """
    answers = _done(
        f"{root}/critique_responses", completions, plan_critiques, answer, "slot", infer_options
    )
    parsed = parse_critiques(answers)
    critiqued = _fresh(attach_critiques(completions, collect_critiques(parsed)), f"{root}/critiqued_table")
    write_sharded(critiqued, f"{root}/critiqued", F.col("prompt_id"), mode="overwrite", files_per_shard=8)
    return {"critiqued": critiqued, "rejects": critique_rejects(parsed)}
