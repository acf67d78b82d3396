"""Conversation shapes -> instruction text (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_turn(conversation: Column, field: str) -> Column:
    """``field`` of turn 0; null for an empty conversation."""
    return F.get(conversation, F.lit(0))[field]


def conversation_to_instruction(
    conversation: Column,
    role: str = "from",
    text: str = "value",
    human: str = "human",
    system: str = "system",
) -> Column:
    """Instruction of a conversation that may open with a system turn.

    Human first: that text. System then human: both, a blank line between.
    Anything else is null, to be rejected by ``split_conversations``.
    """
    first, second = F.get(conversation, F.lit(0)), F.get(conversation, F.lit(1))
    return F.when(first[role] == human, first[text]).when(
        (first[role] == system) & (second[role] == human),
        F.concat(first[text], F.lit("\n\n"), second[text]),
    )


def split_conversations(
    df: DataFrame, conversation: str, strict: bool = False, **names: str
) -> tuple[DataFrame, DataFrame]:
    """(rows with ``instruction``, rejects). ``strict`` raises on the first bad row."""
    instruction = conversation_to_instruction(F.col(conversation), **names)
    if strict:
        instruction = F.coalesce(instruction, F.raise_error(F.lit("conversation format error")))
    shaped = df.withColumn("instruction", instruction)
    kept = shaped.where(F.col("instruction").isNotNull())
    rejects = shaped.where(F.col("instruction").isNull()).withColumn(
        "reject_reason", F.lit("conversation_format")
    )
    return kept, rejects.drop("instruction")
