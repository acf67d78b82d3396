"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written and read again as the next stage's documents. All but the last return the
columns of documents.

In any stage null doc_ids and sources are values like others, null and empty texts are
dropped by the first, repeated rows (equal doc_id and text) are one document, ties go
by the smaller key, empty tables stay empty and further columns are carried along.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.llm.common import keep_documents, repeat_documents, stage
from pairwright.llm.exact_dedup import exact_dedup
from pairwright.llm.langid import UNDETERMINED, in_fold, language_of, train
from pairwright.llm.mixing import mix_sources
from pairwright.llm.packing import pack_documents
from pairwright.llm.queries import quality_weights
from pairwright.llm.similar import similar_documents

# A language is believed from this probability on; four languages by chance have 0.25.
LEAST_LANGUAGE_SCORE = 0.3
WINDOW = 1024


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter and those whose language stays undetermined."""
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = train(docs.where(~held_out).select("text", "lang"))
    found = language_of(model, spark)(F.col("text"))
    return docs.where((found["lang_pred"] != UNDETERMINED) & (found["score"] >= LEAST_LANGUAGE_SCORE))


def keep_one_of_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for A-Z case the document with the largest doc_id stays."""
    found = exact_dedup(docs)
    return keep_documents(docs, found.where("group_size > 1").select("doc_id", "text_hash", "kept"))


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose 5-word shingles are alike to 0.8 or more that with the smallest doc_id stays."""
    found = similar_documents(docs, words=5, similarity=0.8)
    return keep_documents(docs, found.select("doc_id", "text_hash", "kept"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    found = mix_sources(docs, quality_weights(spark, sf_dir))
    return repeat_documents(docs, found.select("doc_id", "text_hash", "times"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and places in the sequences."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), window=WINDOW)


STAGES = [
    ("language_id", keep_identified),
    ("exact_dedup", keep_one_of_equal),
    ("simhash_dedup", keep_one_of_near),
    ("mixing", mix),
    ("packing", pack),
]

# Language ID, XXH64 fingerprints and tokenization are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
