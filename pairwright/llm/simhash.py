"""Near duplicates by SimHash, linked through a grid of segment popcounts.

A 64-bit fingerprint is mapped to the bit counts of its 32 two-bit segments. The
Manhattan distance of two such vectors never exceeds the Hamming distance of the
fingerprints, so it is enough to look where it is at most ``max_bits``. The
segments are dealt to ``max_bits + k`` groups; a pair within the distance agrees in
all counts of at least k of them. Each choice of k groups is a grid whose cells are
the counts in those groups, and close pairs meet in a cell of one of the grids.
Larger inputs take a larger k: more grids with far smaller cells.

Inside a cell, pairs are compared exactly, in blocks of bounded size, and only
the links that hold the cell's components together leave it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_by_size, stage
from .components import connected_components

SEED = 42
SEGMENTS = 32
BLOCK = 2048
CHUNK = 256
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
ROW_S, PAIR_S, AGREE = 5e-6, 2e-9, 0.375  # to weigh grids: a row, a pair, equal counts by chance


def fingerprint(text: bytes, words: int = 4) -> int:
    """SimHash of the word shingles; words end at ASCII white space only."""
    parts = text.translate(LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    digest = xxhash.xxh64_digest
    if len(parts) <= words:
        raw, n = digest(joined, SEED), 1
    else:
        starts = list(accumulate((len(p) + 1 for p in parts), initial=0))
        raw = b"".join([digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[words:])])
        n = len(parts) - words + 1
    columns = np.frombuffer(raw, np.uint8).reshape(n, 8)
    ones = np.concatenate(
        [np.bincount(columns[:, k], minlength=256) @ BYTE_BITS for k in range(8)]
    )
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big", signed=True)


def fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py() or b"", words) for t in batch.column(2).cast(pa.binary())]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())],
                names=["doc_id", "text_hash", "fp"],
            )

    return run


def grids(max_bits: int, k: int) -> list[int]:
    """Masks over the 2-bit counts: one for each choice of k of max_bits + k groups."""
    groups = np.array_split(np.arange(SEGMENTS), max_bits + k)
    masks = [sum(3 << (2 * int(s)) for s in group) for group in groups]
    return [sum(chosen) for chosen in combinations(masks, k)]


def best_k(n: int, max_bits: int) -> int:
    """The k with the least expected work for ``n`` fingerprints."""

    def work(k: int) -> float:
        choices = math.comb(max_bits + k, k)
        chance = AGREE ** (SEGMENTS * k / (max_bits + k))
        return choices * (n * ROW_S + n * n / 2 * chance * PAIR_S)

    return min(range(1, 7), key=work)


def segment_counts(fp: Column) -> Column:
    """The bit counts of the 32 two-bit segments, each in its two bits."""
    low = F.lit(0x5555555555555555)
    a, b = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    return a.bitwiseXOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))


def local_components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest reachable position for each of n positions."""
    root = np.arange(n)
    while True:
        a, b = root[u], root[v]
        apart = a != b
        if not apart.any():
            return root
        np.minimum.at(root, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (root != root[root]).any():
            root = root[root]


def close_pairs(max_bits: int):
    """Links of one pair of blocks of a cell: each node with its component's first."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy().view(np.uint64)
        # the difference in all bits is a lower bound too, so order by it
        weight = np.bitwise_count(fp).astype(int)
        turn = np.argsort(weight, kind="stable")
        fp, weight = fp[turn], weight[turn]
        lo, hi = int(pdf["lo"].iloc[0]), int(pdf["hi"].iloc[0])
        side = pdf["own"].to_numpy()[turn]
        us, vs = [], []
        root = np.arange(len(fp))
        for at in range(0, len(fp), CHUNK):
            rows = slice(at, min(at + CHUNK, len(fp)))
            end = np.searchsorted(weight, weight[rows.stop - 1] + max_bits, side="right")
            near = np.bitwise_count(fp[rows, None] ^ fp[None, at:end]) <= max_bits
            if lo != hi:
                near &= side[rows, None] != side[None, at:end]
            u, v = np.nonzero(near)
            keep = u < v
            us.append(root[u[keep] + at])
            vs.append(root[v[keep] + at])
            if sum(map(len, us)) > 1 << 20:
                root = local_components(len(fp), np.concatenate([*us, root]), np.concatenate([*vs, np.arange(len(fp))]))
                us, vs = [], []
        root = local_components(len(fp), np.concatenate([*us, root]), np.concatenate([*vs, np.arange(len(fp))]))
        linked = root != np.arange(len(fp))
        return pd.DataFrame({"u": fp[linked].view(np.int64), "v": fp[root[linked]].view(np.int64)})

    return run


def near_links(nodes: DataFrame, n: int, max_bits: int) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints within ``max_bits``."""
    masks = grids(max_bits, best_k(n, max_bits))
    counts = segment_counts(F.col("fp"))
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    cells = nodes.select(
        "fp", F.explode(F.array(*[
            F.xxhash64(F.lit(i), counts.bitwiseAND(F.lit(m))) for i, m in enumerate(signed)
        ])).alias("cell"),
    )
    sizes = stage(
        cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "cells"
    )
    met = join_by_size(cells, sizes, "cell", "n", n * len(masks))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    met = met.withColumn("own", F.pmod(F.xxhash64("fp", F.lit(SEED)), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    ).select(
        "fp", "cell", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    )
    return met.groupBy("cell", "lo", "hi").applyInPandas(close_pairs(max_bits), "u long, v long")


def simhash_dedup(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, max_bits: int = 4
) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id, kept and text_hash.

    A-Z are lower-cased and words end at ASCII white space; texts with fewer than
    ``words`` words have one shingle, and texts without words (null, empty)
    fingerprint zero, linked like any other. ``component_id`` is the smallest doc_id
    reachable over links of at most ``max_bits`` differing bits; null doc_ids come
    last. Of each component one document is ``kept``: the one with the smallest
    doc_id, then the smallest text_hash (xxhash64 of the text); rows repeated in both
    count as one document and are all marked. Other columns are not looked at.
    An empty table gives an empty result.
    """
    kind = dict(docs.dtypes)[doc_id]
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
        F.col(text).cast("string").alias("text"),
    )
    prints = stage(
        source.mapInArrow(fingerprints(words), f"doc_id {kind}, text_hash long, fp long"), "fingerprints"
    )
    total = prints.count()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    nodes = stage(prints.groupBy("fp").agg(first.alias("first"), F.count(F.lit(1)).alias("n")), "nodes")
    distinct = nodes.count()

    links = stage(near_links(nodes.select("fp"), distinct, max_bits), "near_links")
    roots = stage(
        connected_components(links).select(F.col("node").alias("fp"), "root"), "roots"
    )
    heads = stage(
        roots.join(nodes, "fp").groupBy("root").agg(
            F.min("first").alias("head"), F.count(F.lit(1)).alias("m")
        ),
        "heads",
    )
    linked = join_by_size(roots, heads, "root", "m", max(distinct, 1)).select("fp", "head")
    labels = stage(
        nodes.join(linked, "fp", "left").select("fp", "n", F.coalesce("head", "first").alias("head")),
        "labels",
    )
    met = join_by_size(prints, labels, "fp", "n", total)
    return met.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("head.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
         & (F.col("text_hash") == F.col("head.text_hash"))).alias("kept"),
        "text_hash",
    )
