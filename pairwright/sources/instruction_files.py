"""The five instruction sources as they lie in files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import fixed
from ..operators.conversations import first_turn
from ..operators.instructions import source_filter
from .readers import read_csv, read_jsonl, read_parquet, read_parquet_dir, split_corrupt


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def _turns(name: str, field: str) -> T.StructField:
    return T.StructField(name, T.ArrayType(_strings(field)))


def _translated(spark: SparkSession, path: str):
    # The original instruction is not in the schema, so it is never read.
    rows, bad = split_corrupt(read_jsonl(spark, path, _strings("instruction_zh"), position=True))
    return rows.withColumnRenamed("instruction_zh", "instruction"), bad


def _prompts(spark: SparkSession, path: str):
    rows = read_parquet(spark, path, _strings("prompt"), position=True)
    return rows.withColumnRenamed("prompt", "instruction"), None


def _questions(spark: SparkSession, path: str):
    names = {
        "Question": "instruction",
        "Correct Answers": "correct_answers",
        "Incorrect Answers": "incorrect_answers",
    }
    header = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    # Columns go by name, as the file may hold others in any order.
    found = header.csv(path).columns
    rows, bad = split_corrupt(read_csv(spark, path, _strings(*found), position=True), "corrupt_csv")
    return rows.select(*[F.col(f"`{old}`").alias(new) for old, new in names.items()], "position"), bad


def _dialogues(spark: SparkSession, path: str):
    schema = T.StructType([_turns("conversation", "human")])
    rows, bad = split_corrupt(read_jsonl(spark, path, schema, position=True))
    return rows.withColumn("instruction", first_turn(F.col("conversation"), "human")), bad


def _scored_dialogues(spark: SparkSession, path: str):
    schema = T.StructType([
        _turns("conversations", "content"),
        T.StructField("system_prompt_key", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ])
    rows = source_filter(read_parquet_dir(spark, path, schema, position=True))
    return rows.withColumn("instruction", first_turn(F.col("conversations"), "content")), None


READERS = {
    "wizard_zh": _translated,
    "chinese-dpo": _prompts,
    "TrufulQA_zh": _questions,
    "sharegpt_zh": _dialogues,
    "smoltalk_zh": _scored_dialogues,
}


REJECTS = "source string, raw string, reject_reason string"


def read_instruction_sources(
    spark: SparkSession, paths: Mapping[str, str], strict: bool = False
) -> tuple[list[tuple[str, DataFrame]], DataFrame]:
    """(tag, rows) for the tags in ``paths``, and the lines that could not be read.

    Sources come in union order, single-source rules applied. ``strict`` raises at
    the first such line, at the cost of a pass over the text files.

    JSON lines with ``instruction_zh``; parquet with ``prompt``; CSV with question and
    answers; JSON lines of ``conversation`` turns; a parquet directory of scored
    ``conversations``. The sources feed ``gather_instructions``.
    """
    unknown = set(paths) - set(READERS)
    if unknown:
        raise ValueError(f"no reader for {sorted(unknown)}")
    read = [(tag, *READERS[tag](spark, paths[tag])) for tag in fixed.SOURCES if tag in paths]
    rejects = spark.createDataFrame([], REJECTS)
    for tag, _, bad in read:
        if bad is not None:
            rejects = rejects.unionByName(bad.select(F.lit(tag).alias("source"), "raw", "reject_reason"))
    if strict and (first := rejects.first()) is not None:
        raise ValueError(f"{first.source} has a line that cannot be read: {first.raw[:200]}")
    return [(tag, rows) for tag, rows, _ in read], rejects
