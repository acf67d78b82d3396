"""Documents whose word shingles are alike, found by wide SimHash fingerprints.

The segment-popcount grid of ``simhash`` for distances beyond a few bits. Each shingle
hash is widened to 256 bits, so that the distance of two fingerprints tells their
similarity within a few per cent. The fingerprint is mapped to the bit counts of 128
segments of two bits. Each grid looks at some of the segments, drawn by a fixed seed;
the cells are their counts. So many grids are taken that a pair at the least
similarity shares a cell with the wanted probability; larger inputs take more segments
a grid and more grids.

In a cell, fingerprints are compared in the order of their total bit count, whose
difference bounds the distance from below. The closest pairs that hold its components
together leave it and are compared by their exact shingles before they link. Where a
cell has further close pairs, its texts whose links did not join them meet once more,
and each close pair still apart is compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, join_by_size, stage
from .components import connected_components
from .simhash import AGREE, BYTE_BITS, LOWER, SEED, local_components, segment_counts

WIDE = 4  # numbers of 64 bits
SEGMENTS = 32 * WIDE
BLOCK, CHUNK, GROUP_ROWS = 8192, 256, 16384
ROW_S, PAIR_S = 2e-5, 4e-9  # to weigh grids: a row, a pair
RECALL = 0.98  # of sharing a cell, at the least similarity
MARGIN = 3.0  # standard deviations of the distance that are allowed for
CLOSEST, CROWD = 3, 8  # rows behind it that a row links to; only the closest of more than so many
PAIRS_EACH = 500  # pairs that one copy of a text serves
CHECK_BLOCK = 256  # texts of a cell that are held beside as many others
PRINTS = ["f0", "f1", "f2", "f3"]


def shingles(text: bytes, words: int) -> list[bytes]:
    """Word shingles, repeats included; a shorter text is one, a text without words none."""
    parts = text.translate(LOWER).split()
    if len(parts) <= words:
        return [b" ".join(parts)] if parts else []
    return [b" ".join(parts[i : i + words]) for i in range(len(parts) - words + 1)]


def wide_fingerprint(text: bytes, words: int) -> np.ndarray:
    """256 bits, each set if it is set in over half of the widened shingle hashes."""
    found = shingles(text, words)
    if not found:
        return np.zeros(WIDE, np.int64)
    base = np.frombuffer(b"".join([xxhash.xxh64_digest(s, SEED) for s in found]), ">u8").astype(np.uint64)
    out = []
    for i in range(WIDE):
        h = base + np.uint64(i * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        columns = h.view(np.uint8).reshape(-1, 8)
        ones = np.concatenate([np.bincount(columns[:, k], minlength=256) @ BYTE_BITS for k in range(8)])
        out.append(np.packbits(ones * 2 > len(found)).view(">i8").astype(np.int64)[0])
    return np.array(out)


def fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [wide_fingerprint(t.as_py() or b"", words) for t in batch.column(2).cast(pa.binary())]
            prints = np.array(found, np.int64).reshape(-1, WIDE)
            yield pa.record_batch(
                [batch.column(0), batch.column(1), *map(pa.array, prints.T)], names=["doc_id", "text_hash", *PRINTS]
            )

    return run


def differing(similarity: float) -> float:
    """Share of bits in which two texts of that Jaccard similarity differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def most_bits(similarity: float) -> int:
    share, bits = differing(similarity), 64 * WIDE
    return math.floor(bits * share + MARGIN * math.sqrt(bits * share * (1 - share)))


def layout(n: int, similarity: float) -> tuple[int, int]:
    """(segments a grid, grids) with the least expected work for ``n`` fingerprints."""
    share = differing(similarity)
    agree = (1 - share) ** 2 + share**2 / 2

    def grids(size: int) -> int:
        return math.ceil(math.log(1 - RECALL) / math.log(1 - agree**size))

    def work(size: int) -> float:
        return grids(size) * (n * ROW_S + n * n / 2 * AGREE**size * PAIR_S)

    size = min(range(3, 25), key=work)
    return size, grids(size)


def grid_masks(size: int, grids: int) -> list[list[int]]:
    """For each grid the bits of its segments in each of the numbers, as signed longs."""
    draw = np.random.default_rng(SEED)
    out = []
    for _ in range(grids):
        masks = [0] * WIDE
        for s in draw.choice(SEGMENTS, size, replace=False).tolist():
            masks[s // 32] |= 3 << 2 * (s % 32)
        out.append([m - (1 << 64) if m >> 63 else m for m in masks])
    return out


def closest(prints: np.ndarray, side: np.ndarray | None, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of ``near_pairs``."""
    return near_pairs(prints, side, limit)[:2]


def near_pairs(
    prints: np.ndarray, side: np.ndarray | None, limit: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (u, v) within ``limit`` that connect all that are within it, and what they leave.

    Each row links to the CLOSEST of those behind it, so that one pair less alike than
    its fingerprints does not part a group. In a crowd one will do, as each grid adds
    others. Further pairs come only where they join what is still apart. ``side``, if given, allows pairs of different sides only.
    Left are the rows with a pair within ``limit`` that is not among these.
    """
    weight = np.bitwise_count(prints).sum(axis=1).astype(int)
    turn = np.argsort(weight, kind="stable")
    prints, weight = prints[turn], weight[turn]
    side = side[turn] if side is not None else None
    n = len(prints)
    us, vs = [], []
    root = np.arange(n)
    left = np.zeros(n, bool)
    for at in range(0, n, CHUNK):
        stop = min(at + CHUNK, n)
        end = int(np.searchsorted(weight, weight[stop - 1] + limit, side="right"))
        apart = np.bitwise_count(prints[at:stop, None, 0] ^ prints[None, at:end, 0]).astype(np.uint16)
        for k in range(1, WIDE):
            apart += np.bitwise_count(prints[at:stop, None, k] ^ prints[None, at:end, k])
        near = apart <= limit
        near &= np.arange(at, stop)[:, None] < np.arange(at, end)[None, :]
        if side is not None:
            near &= side[at:stop, None] != side[None, at:end]
        rows = np.flatnonzero(near.any(axis=1))
        if not len(rows):
            continue
        far = np.where(near[rows], apart[rows], np.uint16(64 * WIDE + 1))
        best = np.argpartition(far, min(CLOSEST, far.shape[1]) - 1, axis=1)[:, :CLOSEST]
        gaps = np.take_along_axis(far, best, 1)
        crowded = near[rows].sum(axis=1) > CROWD
        gaps[crowded[:, None] & (np.arange(gaps.shape[1]) != gaps.argmin(axis=1)[:, None])] = 64 * WIDE + 1
        which, place = np.nonzero(gaps <= limit)
        us.append(rows[which] + at)
        vs.append(best[which, place] + at)
        others = near.copy()
        others[us[-1] - at, vs[-1] - at] = False
        root = local_components(n, np.concatenate([us[-1], np.arange(n)]), np.concatenate([vs[-1], root]))
        u, v = np.nonzero(near)
        while True:  # bridges between what the closest pairs left apart
            a, b = root[u + at], root[v + at]
            open_ = np.flatnonzero(a != b)
            if not len(open_):
                break
            u, v = u[open_], v[open_]
            # the closest way out of each part, as a spanning tree grows
            part = np.concatenate([a[open_], b[open_]])
            pair = np.tile(np.arange(len(u)), 2)
            order = np.lexsort([pair, apart[u, v][pair], part])
            first = pair[order[np.append(True, np.diff(part[order]) > 0)]]
            us.append(u[first] + at)
            vs.append(v[first] + at)
            others[u[first], v[first]] = False
            root = local_components(n, np.concatenate([us[-1], np.arange(n)]), np.concatenate([vs[-1], root]))
        left[at:stop] |= others.any(axis=1)
        left[at:end] |= others.any(axis=0)
    if not us:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, int)
    return turn[np.concatenate(us)], turn[np.concatenate(vs)], turn[left]


def links_of_group(limit: int):
    """Links of all blocks of cells that were dealt to one group.

    A row without v names a text u with close pairs in the cell beyond the links.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cell, lo, hi = (pdf[c].to_numpy() for c in ("cell", "lo", "hi"))
        order = np.lexsort([hi, lo, cell])
        cell, lo, hi = cell[order], lo[order], hi[order]
        own, node = pdf["own"].to_numpy()[order], pdf["text_hash"].to_numpy()[order]
        prints = pdf[PRINTS].to_numpy()[order].view(np.uint64)
        new = np.append(True, (np.diff(cell) != 0) | (np.diff(lo) != 0) | (np.diff(hi) != 0))
        edges = np.append(np.flatnonzero(new), len(cell))
        none = np.zeros(0, np.int64)
        us, vs, crowd, where = [none], [none], [none], [none]
        for i, j in zip(edges, edges[1:]):
            if j - i > 1:
                u, v, left = near_pairs(prints[i:j], own[i:j] if lo[i] != hi[i] else None, limit)
                us.append(node[i:j][u])
                vs.append(node[i:j][v])
                crowd.append(node[i:j][left])
                where.append(cell[i:j][left])
        u, v = np.concatenate(us), np.concatenate(vs)
        links = pd.DataFrame({"u": np.minimum(u, v), "v": np.maximum(u, v)}).drop_duplicates()
        more = pd.DataFrame({"u": np.concatenate(crowd), "cell": np.concatenate(where)}).drop_duplicates()
        # nullable longs from the start: hashes do not survive as floats
        links["cell"], more["v"] = (pd.array([pd.NA] * len(x), dtype="Int64") for x in (links, more))
        return pd.concat([x[["u", "v", "cell"]].astype("Int64") for x in (links, more)])

    return run


def candidate_links(nodes: DataFrame, n: int, similarity: float) -> DataFrame:
    """Distinct pairs (u, v) of close fingerprints that connect what shares cells.

    Rows without v are texts u of a ``cell`` that has close pairs beyond these.
    """
    size, number = layout(max(n, 1), similarity)
    counts = [segment_counts(F.col(f)) for f in PRINTS]
    cell = lambda i, masks: F.xxhash64(F.lit(i), *[c.bitwiseAND(F.lit(m)) for c, m in zip(counts, masks) if m])
    cells = nodes.select(
        "text_hash", *PRINTS, F.explode(F.array(*[cell(i, m) for i, m in enumerate(grid_masks(size, number))])).alias("cell")
    )
    sizes = stage(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "similar_cells")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = sizes.agg(F.sum(F.col("n") * blocks)).first()[0] or 0
    met = join_by_size(cells, sizes, "cell", "n", n * number)
    met = met.withColumn("own", F.pmod(F.xxhash64("text_hash", F.lit(SEED)), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    ).select(
        "text_hash", *PRINTS, "cell", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    )
    group = F.pmod(F.xxhash64("cell", "lo", "hi"), F.lit(1 + rows // GROUP_ROWS)).alias("group")
    links = met.withColumn("group", group).groupBy("group").applyInPandas(
        links_of_group(most_bits(similarity)), "u long, v long, cell long"
    )
    return links.distinct()


def jaccard(a: bytes, b: bytes, words: int) -> float:
    """Similarity of the sets of shingles; 1 for two texts without words."""
    one, two = set(shingles(a, words)), set(shingles(b, words))
    both = len(one & two)
    return both / (len(one) + len(two) - both) if one or two else 1.0


def verify(words: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (batch.column(c).cast(pa.binary()) for c in ("text_u", "text_v"))
            kept = [
                jaccard(x.as_py() or b"", y.as_py() or b"", words) >= similarity for x, y in zip(a, b)
            ]
            yield batch.select(["u", "v"]).filter(pa.array(kept, pa.bool_()))

    return run


def with_texts(links: DataFrame, texts: DataFrame, end: str) -> DataFrame:
    """Adds the text of one end; a text with many links comes in several copies."""
    total = links.count()
    degrees = stage(links.groupBy(end).agg(F.count(F.lit(1)).alias("n")), "similar_degrees")
    copies = F.ceil(F.col("n") / PAIRS_EACH).cast("int")
    salted = join_by_size(links, degrees, end, "n", total)
    salted = salted.withColumn("salt", F.pmod(F.xxhash64("u", "v"), copies).cast("int")).drop("n")
    held = texts.join(degrees.withColumnRenamed(end, "text_hash"), "text_hash")
    held = held.select(
        F.col("text_hash").alias(end), F.col("text").alias(f"text_{end}"),
        F.explode(F.sequence(F.lit(0), copies - 1)).alias("salt"),
    )
    return salted.join(held, [end, "salt"]).drop("salt")


def open_links(words: int, similarity: float):
    """Links among the texts of two blocks of a cell, as far as they join what is apart.

    Close pairs are taken in the order of their distance. The number of common hashes
    shows the pairs that are worth a comparison of their shingles.
    """
    limit = most_bits(similarity)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        prints = pdf[PRINTS].to_numpy().view(np.uint64)
        node, text, own = (pdf[c].to_numpy() for c in ("text_hash", "text", "own"))
        _, part = np.unique(pdf["root"].to_numpy(), return_inverse=True)
        apart = sum(np.bitwise_count(prints[:, None, k] ^ prints[None, :, k]).astype(np.int16) for k in range(WIDE))
        near = (apart <= limit) & (part[:, None] != part[None, :])
        if pdf["lo"].iloc[0] != pdf["hi"].iloc[0]:
            near &= own[:, None] != own[None, :]
        u, v = np.nonzero(np.triu(near, 1))
        order = np.argsort(apart[u, v], kind="stable")
        hashes: dict[int, np.ndarray] = {}
        root = list(range(part.max() + 1))

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        def hashed(i: int) -> np.ndarray:
            if i not in hashes:
                found = [xxhash.xxh64_intdigest(s, SEED) for s in shingles(raw(i), words)]
                hashes[i] = np.unique(np.array(found, np.uint64))
            return hashes[i]

        def raw(i: int) -> bytes:
            return (text[i] or "").encode()

        links = []
        for i, j in zip(u[order].tolist(), v[order].tolist()):
            a, b = find(part[i]), find(part[j])
            if a == b:
                continue
            x, y = hashed(i), hashed(j)
            if min(len(x), len(y)) < similarity * max(len(x), len(y)):
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both >= similarity * (len(x) + len(y) - both) - 1 and jaccard(raw(i), raw(j), words) >= similarity:
                root[b] = a
                links.append((node[i], node[j]))
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return run


def links_left(crowds: DataFrame, roots: DataFrame, nodes: DataFrame, texts: DataFrame, words: int, similarity: float) -> DataFrame:
    """Links (u, v) between what ``roots`` leave apart in cells with more close pairs than were compared.

    ``crowds`` (cell, text_hash) is a written table. Cells are cut into blocks, so a task
    holds the texts of two blocks however large the cell is.
    """
    rooted = crowds.join(roots, "text_hash", "left").select(
        "cell", "text_hash", F.coalesce("root", "text_hash").alias("root")
    )
    rooted = stage(rooted, "similar_crowds")
    sizes = rooted.groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("least"), F.max("root").alias("most")
    )
    sizes = stage(sizes.where("least <> most").select("cell", "n"), "similar_crowd_cells")
    blocks = F.ceil(F.col("n") / CHECK_BLOCK).cast("int")
    met = join_by_size(rooted, sizes, "cell", "n", rooted.count())
    met = met.withColumn("own", F.pmod(F.xxhash64("text_hash", F.lit(SEED)), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    ).select(
        "text_hash", "root", "cell", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    )
    whole = met.join(nodes.join(texts, "text_hash"), "text_hash")
    return whole.groupBy("cell", "lo", "hi").applyInPandas(open_links(words, similarity), "u long, v long")


def similar_documents(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8
) -> DataFrame:
    """One row per document: doc_id, component_id, kept and text_hash.

    Texts link when the Jaccard similarity of their sets of ``words``-word shingles
    (A-Z lower-cased, words end at ASCII white space) is at least ``similarity``. Every
    link is checked on the exact shingles. Candidates come from fingerprints: a pair at
    the least similarity is found with about RECALL, a closer one nearly always; all that
    share a cell are linked or compared.
    ``component_id`` is the smallest doc_id reachable over links; null doc_ids come last.
    Of each component one document is ``kept``: that with the smallest doc_id, then the
    smallest text_hash (xxhash64 of the text); rows repeated in both count as one
    document and are all marked. Texts of fewer words are one shingle; texts without
    words (null, empty) are alike. Other columns are not looked at. An empty table gives
    an empty result.
    """
    kind = dict(docs.dtypes)[doc_id]
    source = docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).cast("string").alias("text"),
    )
    prints = stage(
        source.mapInArrow(fingerprints(words), f"doc_id {kind}, text_hash long, " + ", ".join(f"{f} long" for f in PRINTS)),
        "wide_fingerprints",
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    nodes = stage(
        prints.groupBy("text_hash", *PRINTS).agg(first.alias("first"), F.count(F.lit(1)).alias("n")), "similar_nodes"
    )
    distinct = nodes.count()
    prints_of = nodes.select("text_hash", *PRINTS)
    found = stage(candidate_links(prints_of, distinct, similarity), "similar_pairs")
    pairs = found.where("v is not null").select("u", "v")
    crowds = found.where("v is null").select("cell", F.col("u").alias("text_hash"))
    ends = pairs.select("u").union(pairs.select("v")).distinct().withColumnRenamed("u", "text_hash")
    ends = stage(ends, "similar_ends")
    if ends.count() <= BROADCAST_ROWS:  # one number each; texts without a pair then stay where they are
        ends = F.broadcast(ends)
    # one text each: rows of one hash are copies
    texts = source.select("text_hash", "text").join(ends, "text_hash", "left_semi")
    texts = stage(texts.groupBy("text_hash").agg(F.first("text").alias("text")), "similar_texts")
    both = with_texts(with_texts(pairs, texts, "u"), texts, "v")
    links = stage(both.mapInArrow(verify(words, similarity), "u long, v long"), "similar_links")
    connected = lambda links: stage(
        connected_components(links).select(F.col("node").alias("text_hash"), "root"), "similar_roots"
    )
    roots = connected(links)
    if not crowds.isEmpty():
        more = stage(links_left(crowds, roots, prints_of, texts, words, similarity), "similar_links_left")
        if not more.isEmpty():
            roots = connected(links.unionByName(more))
    heads = stage(
        roots.join(nodes.select("text_hash", "first"), "text_hash").groupBy("root").agg(
            F.min("first").alias("head"), F.count(F.lit(1)).alias("m")
        ),
        "similar_heads",
    )
    linked = join_by_size(roots, heads, "root", "m", max(distinct, 1)).select("text_hash", "head")
    labels = stage(
        nodes.join(linked, "text_hash", "left").select("text_hash", "n", F.coalesce("head", "first").alias("head")),
        "similar_labels",
    )
    met = join_by_size(prints.select("doc_id", "text_hash"), labels, "text_hash", "n", prints.count())
    return met.select(
        "doc_id", F.col("head.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id"))
         & (F.col("text_hash") == F.col("head.text_hash"))).alias("kept"),
        "text_hash",
    )
