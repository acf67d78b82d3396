"""Exact duplicates by two passes over a Bloom filter.

Pass one reads the text hashes and counts, up to two, how often each cell of a
Bloom filter is hit. Pass two asks the filter: a hash that has a cell hit only
once is unique and passes straight through; only hashes whose cells were all hit
twice or more are shuffled, grouped and ranked.

The filter has ``BITS_PER_ROW`` cells a row. Above ``FILTER_BITS`` cells the hash
space is cut into slices with a filter each, so what a task holds stays bounded
(128 MB) while every hash still meets a filter of full precision.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.sources.sinks import stage_path

from .common import join_by_size, stage

BITS_PER_ROW = 16
FILTER_BITS = 1 << 30
SEGMENT_BITS = 1 << 16
FLUSH_CELLS = 1 << 22
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each whole text after lower-casing A-Z; null counts as empty.

    Bytes of other characters lie above 127 in UTF-8, so the byte table leaves
    them alone.
    """
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        digests = [
            hashlib.sha256((t.as_py() or b"").translate(LOWER)).digest() for t in texts
        ]
        yield pa.record_batch(
            [batch.column(0), batch.column(2), pa.array(digests, pa.binary())],
            names=["doc_id", "text_hash", "digest"],
        )


def cells_of(digests: pa.Array, cells: int) -> np.ndarray:
    """Two filter cells for each digest, as an (n, 2) array."""
    words = np.frombuffer(b"".join(d[:16] for d in digests.to_pylist()), "<u8").reshape(-1, 2)
    return (words % np.uint64(cells)).astype(np.int64)


def count_cells(cells: int):
    """A task's hits per cell: (segment, cells hit, cells hit twice or more)."""

    def packed(parts: list[np.ndarray]) -> pa.RecordBatch:
        hit, times = np.unique(np.concatenate(parts), return_counts=True)
        twice = hit[times > 1]
        segments = np.unique(hit // SEGMENT_BITS)
        out = {"segment": segments, "once": [], "twice": []}
        for name, found in (("once", hit), ("twice", twice)):
            edges = np.searchsorted(found, np.append(segments, segments[-1] + 1) * SEGMENT_BITS)
            local = (found % SEGMENT_BITS).astype("<u2")
            out[name] = [local[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
        return pa.record_batch([pa.array(segments, pa.int64()), pa.array(out["once"], pa.binary()),
                                pa.array(out["twice"], pa.binary())], names=list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            both = cells_of(batch.column(0), cells)
            # a row whose two cells coincide hits that cell once
            second = both[both[:, 0] != both[:, 1], 1]
            parts += [both[:, 0], second]
            held += len(both) + len(second)
            if held >= FLUSH_CELLS:
                yield packed(parts)
                parts, held = [], 0
        if held:
            yield packed(parts)

    return run


def merge_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the tasks' hits; a segment leaves as bits of the cells hit twice."""
    hits: dict[int, np.ndarray] = {}
    for batch in batches:
        for segment, once, twice in zip(*(c.to_pylist() for c in batch.columns)):
            seen = hits.setdefault(segment, np.zeros(SEGMENT_BITS, np.uint8))
            for raw in (once, twice):  # a cell in both gets two
                seen[np.frombuffer(raw, "<u2")] += 1
            np.minimum(seen, 2, out=seen)
    for segment, seen in hits.items():
        yield pa.record_batch(
            [pa.array([segment], pa.int64()), pa.array([np.packbits(seen > 1).tobytes()], pa.binary())],
            names=["segment", "bits"],
        )


def repeated_filter(digests: DataFrame, cells: int) -> np.ndarray:
    """Bits of all cells hit twice or more; at most FILTER_BITS of them."""
    counted = digests.select("digest").mapInArrow(
        count_cells(cells), "segment long, once binary, twice binary"
    )
    segments = math.ceil(cells / SEGMENT_BITS)
    merged = counted.repartition(min(segments, 256), "segment").mapInArrow(
        merge_segments, "segment long, bits binary"
    )
    bits = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
    for row in merged.toLocalIterator():
        bits[row.segment] = np.frombuffer(row.bits, np.uint8)
    return bits.reshape(-1)


def ask_filter(shared, cells: int):
    """Adds ``maybe``: all cells of the digest were hit twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            if not batch.num_rows:
                continue
            cell = cells_of(batch.column(2), cells)
            set_ = (bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1
            yield pa.record_batch(
                [*batch.columns, pa.array(set_.all(axis=1))],
                names=["doc_id", "text_hash", "digest", "rid", "maybe"],
            )

    return run


def exact_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bits: int = FILTER_BITS
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 and text_hash.

    Texts are equal when identical after lower-casing A-Z; a null text counts as
    empty. Of equal texts the row with the largest doc_id stays, null doc_ids
    coming last; of repeated rows with that doc_id exactly one stays.
    ``text_hash`` is xxhash64 of the text as it stands. Other columns take no
    part, whatever their names. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[doc_id]
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"),
        F.xxhash64(text).alias("text_hash"),
    )
    total = docs.count()
    slices = max(1, math.ceil(total * BITS_PER_ROW / filter_bits))
    cells = 1 << max(16, math.ceil(math.log2(max(1, total / slices * BITS_PER_ROW))))
    path = stage_path(spark, "digests")
    (
        source.mapInArrow(hash_texts, f"doc_id {kind}, text_hash long, digest binary")
        .withColumn("rid", F.monotonically_increasing_id())
        .withColumn("slice", F.conv(F.hex(F.substring("digest", 31, 2)), 16, 10).cast("int") % slices)
        .write.partitionBy("slice").parquet(path)
    )
    schema = f"doc_id {kind}, text_hash long, digest binary, rid long"
    table = spark.read.schema(schema + ", slice int").parquet(path)
    answers = []
    for k in range(slices):
        part = table.where(F.col("slice") == k).drop("slice")
        bits = spark.sparkContext.broadcast(repeated_filter(part, cells).tobytes())
        answers.append(stage(part.mapInArrow(ask_filter(bits, cells), schema + ", maybe boolean"), "asked"))
        bits.destroy()  # the answers are written: one slice's filter is held at a time
    asked = reduce(DataFrame.unionByName, answers)
    maybe = asked.where("maybe").drop("maybe")
    groups = stage(
        maybe.groupBy("digest").agg(
            F.count(F.lit(1)).alias("group_size"),
            F.max(F.struct("doc_id", "rid")).alias("keep"),
        ),
        "groups",
    )
    grouped = join_by_size(maybe, groups, "digest", "group_size", total).select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"), "digest", "text_hash",
    )
    unique = asked.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "digest", "text_hash",
    )
    return unique.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"), "text_hash",
    )
