"""The registered queries of this subpackage: thin, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairwright.sources.sinks import stage_path

from .alignment import align_tokenizers
from .chat import format_chats
from .collocations import collocations
from .common import stage
from .exact_dedup import exact_dedup
from .exact_topk import exact_topk
from .html_text import extract_main_text
from .langid import identify_languages, in_fold, train
from .mixing import mix_sources
from .packing import pack_documents
from .pii import personal_data, span_counts, spans_text
from .quality import document_statistics, fit_quality, score_quality
from .simhash import simhash_dedup
from .warc import read_archives, write_archives


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def quality_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Sampling weights: 2 for label 1, 0.5 for label 0; unlabelled documents weigh 1."""
    labels = table(spark, sf, "labels").where("quality is not null")
    return labels.select("doc_id", F.when(F.col("quality") == 1, 2.0).otherwise(0.5).alias("weight"))


def op1_warc(spark: SparkSession, sf: str) -> DataFrame:
    folder = stage_path(spark, "warc")
    write_archives(table(spark, sf, "pages"), folder, min_revisit_bytes=0)
    number = lambda c: F.expr(f"try_cast(substring({c}, 10) AS long)")  # after urn:page:
    return read_archives(spark, folder, payloads=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"), "error",
    )


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    held_out = in_fold(F.col("doc_id"), 4, 2)
    stats = stage(document_statistics(table(spark, sf, "documents")), "document_stats")
    labels = table(spark, sf, "labels").where(~held_out).select("doc_id", F.col("quality").alias("label"))
    scored = score_quality(stats, fit_quality(stats, labels))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(table(spark, sf, "documents"), vocabulary, window=1024, with_ids=False)


def op4_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = table(spark, sf, "embeddings").where(F.col("embedding").isNotNull() & finite)
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = rows.select("vec_id", scaled.alias("vector"))
    return exact_topk(rows, F.col("vec_id") % 50 == 0, k=5, null_ids=True)


def op5_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf, "documents"), quality_weights(spark, sf))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op6_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash_dedup(table(spark, sf, "documents"), words=4, max_bits=4)
    return found.select("doc_id", "fingerprint", "component_id")


def op7_chat(spark: SparkSession, sf: str) -> DataFrame:
    return format_chats(table(spark, sf, "conversations"))


def op8_langid(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    model = train(docs.where(~held_out).select("text", "lang"))
    found = identify_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_html_text(spark: SparkSession, sf: str) -> DataFrame:
    return extract_main_text(table(spark, sf, "pages"))


def op10_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup(table(spark, sf, "documents")).drop("text_hash")


def op11_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = personal_data(table(spark, sf, "documents"))
    digest = F.sha2(spans_text("base"), 256).alias("base_sha256")
    return found.select("doc_id", *span_counts("base"), digest, spans_text("spans").alias("spans"))


def op12_alignment(spark: SparkSession, sf: str) -> DataFrame:
    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align_tokenizers(table(spark, sf, "documents"), *paths).drop("groups")


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(table(spark, sf, "documents"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_exact_topk": op4_exact_topk,
    "op5_mixing": op5_mixing,
    "op6_simhash": op6_simhash,
    "op7_chat": op7_chat,
    "op8_langid": op8_langid,
    "op9_html_text": op9_html_text,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_pii": op11_pii,
    "op12_alignment": op12_alignment,
    "op13_collocations": op13_collocations,
}
