"""Alignment of two tokenizers' tokens over the bytes of the same texts.

Every token has a byte range. Per batch of texts ``merge_asof``, keyed by document,
finds the other side's token that covers each token start, in both directions; the
union is all overlapping pairs. Where both tokens of a pair end at the same byte a
group ends. All A-B pairs of tokens within a group are linked.

The id pairs of a chunk of documents are packed per bucket, sorted and compressed, so
that Spark moves blocks and not single links. All pairs of one A id share a bucket:
its document counts and the highest of them are known there. The number of buckets is
fixed, since pairs are bounded by both vocabularies; groups of chunks split them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import packed, unpacked
from .common import stage
from .tokens import Encoder, byte_of_symbol

# Bytes of text aligned at once, tokens of one text aligned at once, links and documents of a chunk.
BATCH_BYTES = 1 << 21
SEGMENT = 1 << 20
CHUNK_LINKS, CHUNK_DOCS = 4_000_000, 1 << 15
DOC_BITS = 16
# Links of a group from which its ids are counted before they are paired.
LARGE_GROUP = 64
BUCKETS = 64
# Blocks of one bucket that are added up at once, and bytes of them that are looked up at once.
FAN = 16
PIECE_BYTES = 64 << 20
MARK = "▁"  # fixed value: how pieces write a space


class Side:
    """One tokenizer: ids of a text that begins with a space, and the bytes of its ids."""

    def __init__(self, tokens: list[bytes]):
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.size = len(tokens)

    def spelled(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.starts[ids] - ends + lengths, lengths)
        return self.flat[shift + np.arange(len(shift))].tobytes()


class BytePairs(Side):
    def __init__(self, path: str):
        self.encoder = Encoder(path)
        symbols = byte_of_symbol()
        names = [self.encoder.full.id_to_token(i) or "" for i in range(self.encoder.size)]
        special = set(self.encoder.special)
        super().__init__([
            n.encode() if n in special else bytes(symbols[c] for c in n) for n in names
        ])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encoder.encode_plain(" " + t).astype(np.int64) for t in texts]


class Pieces(Side):
    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.get_piece_size())
        names = [self.model.id_to_piece(i) for i in ids]
        super().__init__([
            bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace(MARK, " ").encode()
            for i, n in zip(ids, names)
        ])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self.model.encode(texts, num_threads=1)]


def pieces_of(a_ends: np.ndarray, b_ends: np.ndarray) -> list[tuple[int, int]]:
    """Where to cut the tokens of one text: at common ends, after about SEGMENT tokens."""
    cuts, at = [], 0
    if max(len(a_ends), len(b_ends)) > SEGMENT:
        for end in np.intersect1d(a_ends, b_ends, assume_unique=True):
            i, j = np.searchsorted(a_ends, end) + 1, np.searchsorted(b_ends, end) + 1
            if i - at >= SEGMENT:
                cuts.append((int(i), int(j)))
                at = i
    return cuts if cuts and cuts[-1] == (len(a_ends), len(b_ends)) else [*cuts, (len(a_ends), len(b_ends))]


def decimal_table(size: int) -> np.ndarray:
    """Decimal digits of each id, right-aligned behind a place for a separator; 0 is no character."""
    width = len(str(size))
    rows = [str(i).encode().rjust(width + 1, b"\0") for i in range(size)]
    return np.frombuffer(b"".join(rows), np.uint8).reshape(size, width + 1)


class Aligned:
    """Groups and links of a batch of parts of texts, each with tokens on both sides."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], sides: tuple[Side, Side]):
        self.n_a, self.n_b = np.array([len(x) for x in a]), np.array([len(x) for x in b])
        docs = np.arange(len(a))
        self.a, self.b = np.concatenate(a), np.concatenate(b)
        self.doc_a, self.doc_b = np.repeat(docs, self.n_a), np.repeat(docs, self.n_b)
        a_len, b_len = sides[0].lengths[self.a], sides[1].lengths[self.b]
        # parts lie one behind the other, so places are sorted over the whole batch
        a_end, b_end = np.cumsum(a_len), np.cumsum(b_len)
        left = pd.DataFrame({"at": a_end - a_len, "doc": self.doc_a, "a": np.arange(len(self.a))})
        right = pd.DataFrame({"at": b_end - b_len, "doc": self.doc_b, "b": np.arange(len(self.b))})
        covering_b = pd.merge_asof(left, right, on="at", by="doc")
        covering_a = pd.merge_asof(right, left, on="at", by="doc")
        pairs = np.concatenate([
            covering_b["a"].to_numpy() << 32 | covering_b["b"].to_numpy(),
            covering_a["a"].to_numpy() << 32 | covering_a["b"].to_numpy(),
        ])
        pairs.sort(kind="stable")  # two sorted runs
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
        over_a, over_b = pairs >> 32, pairs & 0xFFFFFFFF
        closes = a_end[over_a] == b_end[over_b]
        group = np.cumsum(closes) - closes
        self.group_a, self.group_b = np.empty_like(self.a), np.empty_like(self.b)
        self.group_a[over_a], self.group_b[over_b] = group, group
        self.groups = int(closes.sum())
        self.in_a = np.bincount(self.group_a, minlength=self.groups)
        self.in_b = np.bincount(self.group_b, minlength=self.groups)
        self.first_a, self.first_b = np.cumsum(self.in_a) - self.in_a, np.cumsum(self.in_b) - self.in_b
        self.doc = self.doc_a[self.first_a]
        self.links = self.in_a * self.in_b

    def linked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(part, A id, B id, occurrences); a pair of a part may come several times."""
        small = np.flatnonzero(self.links <= LARGE_GROUP)
        n = self.links[small]
        which = np.repeat(small, n)
        place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        step = self.in_b[which]
        a = self.a[self.first_a[which] + place // step]
        b = self.b[self.first_b[which] + place % step]
        out = [(self.doc[which], a, b, np.ones(len(a), np.int64))]
        for g in np.flatnonzero(self.links > LARGE_GROUP):
            ids_a, times_a = np.unique(self.a[self.first_a[g] :][: self.in_a[g]], return_counts=True)
            ids_b, times_b = np.unique(self.b[self.first_b[g] :][: self.in_b[g]], return_counts=True)
            out.append((
                np.full(len(ids_a) * len(ids_b), self.doc[g]), np.repeat(ids_a, len(ids_b)),
                np.tile(ids_b, len(ids_a)), np.outer(times_a, times_b).ravel(),
            ))
        return tuple(np.concatenate(x) for x in zip(*out))

    def written(self, tables: tuple[np.ndarray, np.ndarray]) -> list[bytes]:
        """``;a1,a2|b1;a3|b2,b3`` of each part, with the leading separator."""
        n = len(self.a) + len(self.b)
        width = max(t.shape[1] for t in tables)
        rows = np.zeros((n, width), np.uint8)
        at_a = np.arange(len(self.a)) + self.first_b[self.group_a]
        at_b = np.arange(len(self.b)) + (self.first_a + self.in_a)[self.group_b]
        rows[at_a, width - tables[0].shape[1] :] = tables[0][self.a]
        rows[at_b, width - tables[1].shape[1] :] = tables[1][self.b]
        rows[:, 0] = ord(",")
        rows[at_a[self.first_a], 0] = ord(";")
        rows[at_b[self.first_b], 0] = ord("|")
        shown = rows != 0
        flat = rows[shown]
        tokens = self.n_a + self.n_b
        ends = np.cumsum(np.add.reduceat(shown.sum(axis=1), np.cumsum(tokens) - tokens))
        return [flat[i:j].tobytes() for i, j in zip([0, *ends[:-1]], ends)]


class Chunk:
    """Id pairs of up to CHUNK_DOCS documents, at most about CHUNK_LINKS of them."""

    def __init__(self, number: int, size_b: int):
        self.number, self.size_b = number, size_b
        self.docs, self.n, self.keys, self.times = 0, 0, [], []

    def add(self, doc: np.ndarray, a: np.ndarray, b: np.ndarray, times: np.ndarray) -> None:
        key = (a * self.size_b + b) << DOC_BITS | doc
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
        self.keys.append(key[first])
        self.times.append(np.add.reduceat(times[order], first) if len(first) else times[:0])
        self.n += len(first)

    def rows(self) -> Iterator[dict]:
        """One block for each bucket: its pairs, their number of documents, those, and occurrences."""
        key = np.concatenate(self.keys)
        times = np.concatenate(self.times)
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        bucket = bucket_of(key >> DOC_BITS, self.size_b)
        order = np.argsort(bucket, kind="stable")
        key, times, bucket = key[order], times[order], bucket[order]
        edges = np.searchsorted(bucket, np.arange(BUCKETS + 1))
        for k, (i, j) in enumerate(zip(edges, edges[1:])):
            if i < j:
                pairs, docs = np.unique(key[i:j] >> DOC_BITS, return_counts=True)
                yield {
                    "chunk": self.number, "n_docs": self.docs, "bucket": k,
                    "pairs": packed(np.diff(pairs, prepend=0)), "counts": packed(docs),
                    "docs": packed((key[i:j] & ((1 << DOC_BITS) - 1)).astype(np.uint16)),
                    "times": packed(times[i:j]),
                }


def bucket_of(pairs: np.ndarray, size_b: int) -> np.ndarray:
    """By the A id alone."""
    return (((pairs // size_b).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % BUCKETS


ROWS = (
    "doc_id {kind}, doc_no long, chunk long, n_docs long, n_a long, n_b long, n_groups long, n_links long,"
    " groups_sha256 string, groups string, bucket int, pairs binary, counts binary, docs binary, times binary"
)


def align(path_a: str, path_b: str, schema: pa.Schema, with_groups: bool):
    """Rows of documents and blocks of pairs from batches of (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = BytePairs(path_a), Pieces(path_b)
        tables = decimal_table(sides[0].size), decimal_table(sides[1].size)
        number = TaskContext.get().partitionId() << 32
        chunk = Chunk(number, sides[1].size)

        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema)

        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi in by_bytes(texts):
                rows = documents(ids[lo:hi].to_pylist(), texts[lo:hi].to_pylist(), sides, tables, chunk, with_groups)
                yield out(rows)
                if chunk.n >= CHUNK_LINKS or chunk.docs >= CHUNK_DOCS:
                    for row in chunk.rows():
                        yield out([row])
                    number += 1
                    chunk = Chunk(number, sides[1].size)
        for row in chunk.rows() if chunk.n else ():
            yield out([row])

    return run


def by_bytes(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about BATCH_BYTES of text and few enough documents."""
    lo, held = 0, 0
    for i, n in enumerate(pa.compute.binary_length(texts).to_pylist()):
        held += n or 0
        if held >= BATCH_BYTES or i + 1 - lo >= 4096:
            yield lo, i + 1
            lo, held = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def documents(ids, texts, sides, tables, chunk: Chunk, with_groups: bool) -> list[dict]:
    """One row for each text; its pairs go to the chunk."""
    asked = [t or "" for t in texts]
    found = list(zip(sides[0].encode(asked), sides[1].encode(asked)))
    rows = []
    parts: list[tuple[dict, np.ndarray, np.ndarray]] = []
    for doc_id, text, (a, b) in zip(ids, asked, found):
        row = {
            "doc_id": doc_id, "doc_no": chunk.docs + len(rows), "chunk": chunk.number, "n_a": 0, "n_b": 0,
            "n_groups": 0, "n_links": 0, "groups_sha256": "", "groups": "" if with_groups else None,
        }
        rows.append(row)
        whole = (" " + text).encode()
        if text and sides[0].spelled(a) == whole and sides[1].spelled(b) == whole:
            row["n_a"], row["n_b"], row["digest"], row["text"] = len(a), len(b), hashlib.sha256(), []
            ends = np.cumsum(sides[0].lengths[a]), np.cumsum(sides[1].lengths[b])
            i = j = 0
            for p, q in pieces_of(*ends):
                parts.append((row, a[i:p], b[j:q]))
                i, j = p, q
    first = 0
    while first < len(parts):
        last, tokens = first, 0
        while last < len(parts) and (last == first or tokens + len(parts[last][1]) <= SEGMENT):
            tokens += len(parts[last][1])
            last += 1
        add_parts(parts[first:last], sides, tables, chunk, with_groups)
        first = last
    chunk.docs += len(rows)
    for row in rows:
        if "digest" in row:
            row["groups_sha256"] = row.pop("digest").hexdigest()
            row["groups"] = b"".join(row.pop("text")).decode() if with_groups else None
    return rows


def add_parts(parts, sides, tables, chunk: Chunk, with_groups: bool) -> None:
    aligned = Aligned([p[1] for p in parts], [p[2] for p in parts], sides)
    groups = np.bincount(aligned.doc, minlength=len(parts))
    links = np.zeros(len(parts), np.int64)
    np.add.at(links, aligned.doc, aligned.links)
    for (row, _, _), text, g, n in zip(parts, aligned.written(tables), groups, links):
        text = text if row["n_groups"] else text[1:]
        row["digest"].update(text)
        if with_groups:
            row["text"].append(text)
        row["n_groups"] += int(g)
        row["n_links"] += int(n)
    part, a, b, times = aligned.linked()
    chunk.add(np.array([p[0]["doc_no"] for p in parts])[part], a, b, times)


def add_up(table: pa.Table) -> pa.Table:
    """Blocks of one bucket to one block: distinct pairs with the sum of their counts."""
    pairs = np.concatenate([np.cumsum(unpacked(x.as_py())) for x in table["pairs"]])
    counts = np.concatenate([unpacked(x.as_py()) for x in table["counts"]])
    order = np.argsort(pairs, kind="stable")
    pairs, counts = pairs[order], counts[order]
    first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    return pa.table({
        "bucket": table["bucket"][:1], "piece": table["piece"][:1],
        "pairs": pa.array([packed(np.diff(pairs[first], prepend=0))], pa.binary()),
        "counts": pa.array([packed(np.add.reduceat(counts, first))], pa.binary()),
    })


def look_up(size_b: int):
    """Sums over the links of each document of a chunk, for one bucket of pairs."""

    def run(blocks: pa.Table, known: pa.Table) -> pa.Table:
        pairs = np.cumsum(unpacked(known["pairs"][0].as_py()))
        counts = unpacked(known["counts"][0].as_py())
        ids = pairs // size_b
        first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        highest = np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(ids))))
        best = counts == highest
        rows = {"chunk": [], "n_best": [], "count_sum": []}
        for i in range(len(blocks)):
            mine = np.cumsum(unpacked(blocks["pairs"][i].as_py()))
            at = np.repeat(np.searchsorted(pairs, mine), unpacked(blocks["counts"][i].as_py()))
            docs = unpacked(blocks["docs"][i].as_py(), np.uint16).astype(np.int64)
            times = unpacked(blocks["times"][i].as_py())
            sums = np.zeros((2, blocks["n_docs"][i].as_py()), np.int64)
            np.add.at(sums[0], docs, times * best[at])
            np.add.at(sums[1], docs, times * counts[at])
            rows["chunk"].append(blocks["chunk"][i].as_py())
            rows["n_best"].append(packed(sums[0]))
            rows["count_sum"].append(packed(sums[1]))
        return pa.table(rows, pa.schema([("chunk", pa.int64()), ("n_best", pa.binary()), ("count_sum", pa.binary())]))

    return run


def sums_of_chunk(table: pa.Table) -> pa.Table:
    total = lambda name: sum(unpacked(x.as_py()) for x in table[name])
    best, sums = total("n_best"), total("count_sum")
    return pa.table({
        "chunk": pa.array([table["chunk"][0].as_py()] * len(best), pa.int64()),
        "doc_no": pa.array(np.arange(len(best))), "n_best": pa.array(best), "count_sum": pa.array(sums),
    })


def align_tokenizers(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text",
    with_groups: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256 and ``groups``.

    A is a byte-level vocabulary that gets a space and the text, B a piece model that
    gets the text. ``groups`` is ``a1,a2|b1;a3|b2,b3``, ids in order, null unless
    asked for. An id pair's count is how many documents hold it linked; ``n_best`` are
    the links whose count is the highest of their A id, ``count_sum`` the counts of all.

    Texts that are null, empty or not spelled exactly by both sides have zeros and ''.
    Every row is a document of its own, repeated ones and null ids too. Long texts are
    aligned in parts that end where both sides do. Other columns are not looked at. An
    empty table gives an empty result. Both files must be there on every executor.
    """
    size_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    kind = dict(docs.dtypes)[doc_id]
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    ddl = ROWS.format(kind=kind)
    schema = docs.sparkSession.createDataFrame([], ddl).toArrow().schema
    every = stage(source.mapInArrow(align(path_a, path_b, schema, with_groups), ddl), "aligned")

    rows = every.where("bucket is null").select(
        "chunk", "doc_no", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups"
    )
    blocks = every.where("bucket is not null").select("bucket", "chunk", "n_docs", "pairs", "counts", "docs", "times")
    size = blocks.agg(
        F.count(F.lit(1)), F.sum(F.length("pairs") + F.length("counts") + F.length("docs") + F.length("times"))
    ).first()

    pieces = 1 + size[0] // (BUCKETS * FAN)
    at = lambda n, name="chunk": F.pmod(F.xxhash64(name), F.lit(n)).alias("piece")
    known = blocks.select("bucket", at(pieces), "pairs", "counts")
    layout = "bucket int, piece long, pairs binary, counts binary"
    known = known.groupBy("bucket", "piece").applyInArrow(add_up, layout)
    while pieces > 1:
        pieces = 1 + (pieces - 1) // FAN
        known = known.select("bucket", at(pieces, "piece"), "pairs", "counts")
        known = known.groupBy("bucket", "piece").applyInArrow(add_up, layout)
    known = stage(known, "pair_counts")

    pieces = 1 + (size[1] or 0) // (BUCKETS * PIECE_BYTES)
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))
    copies = known.select("bucket", F.explode(numbers).alias("piece"), "pairs", "counts")
    sums = blocks.select("*", at(pieces)).groupBy("bucket", "piece").cogroup(
        copies.groupBy("bucket", "piece")
    ).applyInArrow(look_up(size_b), "chunk long, n_best binary, count_sum binary")
    sums = sums.groupBy("chunk").applyInArrow(
        sums_of_chunk, "chunk long, doc_no long, n_best long, count_sum long"
    )
    found = rows.join(sums, ["chunk", "doc_no"], "left")
    none = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return found.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", none("n_best"), none("count_sum"), "groups_sha256", "groups"
    )
