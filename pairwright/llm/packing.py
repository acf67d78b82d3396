"""Packing documents into sequences by lexical retrieval.

Tokenized documents are laid out so that those sharing their least token pair, a
MinHash that near copies and texts with common phrases agree on, lie side by
side. Each task reads its part as shards of bounded size. A shard has a BM25
inverted index over token ids, with document frequencies of the whole corpus. A
window starts with a seed document; the index returns the unused documents most
like it, and they fill the window in that order. The last one is cut at the
window's end, and its rest seeds the next window, so windows are full.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairwright.sources.sinks import stage_path

from .tokens import encoder_of

K1, B = 1.2, 0.75
SHARD_TOKENS = 4 << 20
# Documents whose ids leave a task at a time.
TEXTS = 2048
# Ids that one in so many documents holds go to the matrix; shards up to so many documents
# have one, and all their scores by it are at most 128 MB. Seeds multiplied at once.
DENSE, MATRIX_DOCS, SEEDS = 12, 4096, 256
PARTITION_TOKENS = 16 << 20
NONE = np.zeros(0, int), np.zeros(0, int), np.zeros((0, 0))
PAIR_A, PAIR_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
PIECES = (
    "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def route_of(ids: np.ndarray) -> int:
    """Least hash of two neighbouring ids."""
    wide = ids.astype(np.uint64)
    pairs = (wide[:-1] * PAIR_A) ^ ((wide[1:] + np.uint64(1)) * PAIR_B) if len(ids) > 1 else wide * PAIR_A
    pairs ^= pairs >> np.uint64(29)
    return int((pairs * PAIR_B >> np.uint64(1)).min())


def tokenize(vocabulary: str, end_id: int):
    """Documents (kind 0) as ids, count and route; last, the task's document frequencies (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(vocabulary)
        size = max(encoder.size, end_id + 1)
        width = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        frequency, last = np.zeros(size, np.int64), np.zeros(size, np.int64)

        def rows(ids, data, counts, routes, kind):
            return pa.record_batch(
                [ids, pa.array(data, pa.binary()), pa.array(counts, pa.int64()),
                 pa.array(routes, pa.int64()), pa.array([kind] * len(data), pa.int32())],
                names=["doc_id", "ids", "n", "route", "kind"],
            )

        seen = None
        parts = (batch.slice(at, TEXTS) for batch in batches for at in range(0, batch.num_rows, TEXTS))
        for batch in parts:
            data, counts, routes = [], [], []
            for plain in encoder.encode_all(text.as_py() or "" for text in batch.column(1)):
                ids = np.empty(len(plain) + 1, width)
                ids[:-1], ids[-1] = plain, end_id
                places = np.arange(len(ids))
                last[ids] = places
                frequency[ids[last[ids] == places]] += 1  # each id at its last place
                data.append(ids.tobytes())
                counts.append(len(ids))
                routes.append(route_of(ids))
            seen = batch.column(0)
            yield rows(seen, data, counts, routes, 0)
        if seen is not None:
            yield rows(pa.nulls(1, seen.type), [frequency.astype("<i8").tobytes()], [width.itemsize], [0], 1)

    return run


def add_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums whole vectors, one for each id of the vocabulary."""
    total = None
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            part = np.frombuffer(raw, "<i8")
            total = part if total is None else total + part
    if total is not None:
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["ids"])


class Shard:
    """A BM25 inverted index over some documents.

    Postings of ids that at least one in DENSE documents holds are rows of a matrix,
    the others lists. Scores of many seeds are then one product of matrices, and only
    the short lists are walked seed by seed. All terms of a seed count. Shards of more
    than MATRIX_DOCS documents, which are short ones, have lists only.
    """

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray):
        lengths = np.array([len(d) for d in docs], float)
        bits = int(len(idf)).bit_length()
        kind = np.uint32 if (len(docs) << bits) <= 1 << 32 else np.uint64  # half the bytes sort twice as fast
        pairs = np.concatenate(docs).astype(kind)
        pairs |= np.repeat(np.arange(len(docs), dtype=kind) << kind(bits), [len(d) for d in docs])
        pairs.sort()
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        tf = np.diff(np.append(first, len(pairs)))
        pairs = pairs[first]
        del first  # all of these are as long as the shard
        doc = (pairs >> kind(bits)).astype(np.int32)
        term = (pairs & kind((1 << bits) - 1)).astype(np.int32)
        del pairs
        self.starts = np.searchsorted(doc, np.arange(len(docs) + 1))
        weight = (idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[doc] / lengths.mean())))
        held = np.bincount(term, minlength=len(idf))
        often = np.flatnonzero(held * DENSE >= len(docs)) if len(docs) <= MATRIX_DOCS else np.zeros(0, int)
        self.row = np.full(len(idf), -1, np.int32)
        self.row[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), len(docs)))
        dense = self.row[term] >= 0
        self.matrix[self.row[term[dense]], doc[dense]] = weight[dense]
        del tf
        self.term = term  # by document
        turn = np.flatnonzero(~dense)
        turn = turn[np.argsort(term[turn], kind="stable")]
        self.doc, self.by_term = doc[turn], weight[turn]
        self.edges = np.searchsorted(term[turn], np.arange(len(idf) + 1))
        self.n = self.live = len(docs)
        self.unused, self.columns = np.ones(len(docs), bool), np.arange(len(docs))
        self.known: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def keep(self, unused: np.ndarray):
        """Leave used documents out of the lists once they are an eighth, of the matrix once a third."""
        live = int(unused.sum())
        if 8 * live <= 7 * self.live:
            stay = unused[self.doc]
            self.edges = np.concatenate([[0], np.cumsum(stay)])[self.edges]
            self.doc, self.by_term, self.live = self.doc[stay], self.by_term[stay], live
            if len(self.matrix) and 3 * live <= 2 * len(self.columns):
                left = unused[self.columns]
                self.matrix, self.columns = self.matrix[:, left], self.columns[left]
                for block, (seeds, columns, scores) in self.known.items():
                    rows, left = unused[seeds], unused[columns]
                    self.known[block] = seeds[rows], columns[left], scores[np.ix_(rows, left)]
            self.unused = unused.copy()

    def terms(self, seed: int) -> np.ndarray:
        return self.term[self.starts[seed] : self.starts[seed + 1]]

    def by_matrix(self, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and the matrix's part of their scores.

        Made at once for the seeds of a block that are unused, this one included.
        """
        block = seed // SEEDS
        seeds, columns, scores = self.known.get(block, NONE)
        at = int(np.searchsorted(seeds, seed))
        if at == len(seeds) or seeds[at] != seed:
            first = block * SEEDS
            seeds = np.union1d(np.flatnonzero(self.unused[first : first + SEEDS]) + first, [seed])
            asked = np.zeros((len(seeds), len(self.matrix)))
            for i, one in enumerate(seeds.tolist()):
                rows = self.row[self.terms(one)]
                asked[i, rows[rows >= 0]] = 1
            columns, scores = self.columns, asked @ self.matrix
            self.known[block] = seeds, columns, scores
            at = int(np.searchsorted(seeds, seed))
        return columns, scores[at]

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every document in the index for all terms of the seed."""
        terms = self.terms(seed)
        total = np.zeros(self.n)
        if len(self.matrix):
            columns, scores = self.by_matrix(seed)
            total[columns] = scores * self.unused[columns]
            terms = terms[self.row[terms] < 0]
        lists = [slice(i, j) for i, j in zip(self.edges[terms].tolist(), self.edges[terms + 1].tolist()) if i < j]
        if lists:
            found = np.concatenate([self.doc[s] for s in lists])
            total += np.bincount(found, np.concatenate([self.by_term[s] for s in lists]), self.n)
        return total


class Packer:
    """Windows of one task; sequence numbers start with the task's."""

    def __init__(self, first_sequence: int, window: int):
        self.sequence, self.window, self.offset = first_sequence, window, 0
        self.rows: list[tuple] = []

    def put(self, index: int, start: int, size: int) -> int:
        """Place as much of a document as the window holds; returns what is left."""
        length = min(size - start, self.window - self.offset)
        self.rows.append((index, start, length, self.sequence, self.offset))
        self.offset += length
        if self.offset == self.window:
            self.sequence, self.offset = self.sequence + 1, 0
        return size - start - length

    def fill(self, shard: Shard, docs: list[np.ndarray], unused: np.ndarray, seed: int):
        """Fill the open window with the seed's unused neighbours, the most alike first.

        Returns the neighbour cut at the window's end and where its rest starts: it
        opens the next window and is its seed. None if nothing was cut.
        """
        if self.offset:
            shard.keep(unused)
            scores = np.where(unused, shard.scores(seed), -1.0)
            while self.offset:
                best = int(scores.argmax())
                if scores[best] <= 0:
                    break
                scores[best], unused[best] = -1.0, False
                if left := self.put(best, 0, len(docs[best])):
                    return best, len(docs[best]) - left
        return None, 0

    def pack(self, docs: list[np.ndarray], idf: np.ndarray) -> list[tuple]:
        """Pieces (document, start, length, sequence, offset) of one shard's documents.

        A window left open by the shard before is filled first.
        """
        shard = Shard(docs, idf)
        unused = np.ones(len(docs), bool)
        for first in range(len(docs)):
            if not unused[first]:
                continue
            unused[first] = False
            seed, at = first, 0
            while seed is not None:
                size = len(docs[seed])
                while at < size:  # a long document fills windows by itself
                    at = size - self.put(seed, at, size)
                seed, at = self.fill(shard, docs, unused, seed)
        rows, self.rows = self.rows, []
        return rows


def pack_partition(shared, window: int, shard_tokens: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder_of.cache_clear()  # no text is encoded from here on
        pa.default_memory_pool().release_unused()
        idf, width = shared.value
        packer = Packer(TaskContext.get().partitionId() << 40, window)
        names, docs, held = [], [], 0

        def shard() -> pa.RecordBatch:
            rows = packer.pack(docs, idf)
            index, start, length, sequence, offset = (list(c) for c in zip(*rows))
            wide: dict[int, np.ndarray] = {}
            pieces = []
            for i, s, n in zip(index, start, length):
                if i not in wide:
                    wide[i] = docs[i].astype("<u4")
                pieces.append(wide[i][s : s + n])
            columns = [
                pa.concat_arrays(names).take(pa.array(index)), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array([zlib.crc32(p.tobytes()) for p in pieces], pa.int64()),
                pa.array([len(docs[i]) for i in index], pa.int64()), pa.array(sequence, pa.int64()),
                pa.array(offset, pa.int64()),
            ]
            labels = [c.split()[0] for c in PIECES.split(", ")]
            if with_ids:
                columns.append(pa.array([p.astype(np.int32) for p in pieces], pa.list_(pa.int32())))
                labels.append("ids")
            return pa.record_batch(columns, names=labels)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                names.append(part.column(0))
                for raw in part.column(1):
                    docs.append(np.frombuffer(raw.as_py(), width))
                    held += len(docs[-1])
                if held >= shard_tokens:
                    yield shard()
                    names, docs, held = [], [], 0
        if docs:
            yield shard()

    return run


def pack_documents(
    docs: DataFrame, vocabulary: str, window: int = 1024, end_id: int = 0, doc_id: str = "doc_id",
    text: str = "text", with_ids: bool = True, shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and ids.

    Every row of ``docs`` becomes the ids of its text (null: empty) and then
    ``end_id``, and each id lies in exactly one piece; repeated rows are packed as
    often as they stand. Pieces lie without gaps from offset 0 of their sequence,
    and all sequences are full but the last one of each task. ``ids_crc32`` is the
    CRC-32 of the piece's ids as little-endian 32-bit integers. ``vocabulary`` is
    the path of a tokenizer file that every executor has. Other columns are not
    looked at. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[doc_id]
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    path = stage_path(spark, "tokens")
    schema = f"doc_id {kind}, ids binary, n long, route long, kind int"
    source.mapInArrow(tokenize(vocabulary, end_id), schema).write.partitionBy("kind").option(
        "compression", "zstd").parquet(path)
    stored = spark.read.schema(schema).parquet(path)
    tokens = stored.where("kind = 0").select("doc_id", "ids", "n", "route")
    tasks = stored.where("kind = 1").select("ids", F.col("n").alias("width"))
    size, count = tokens.agg(F.sum("n"), F.count(F.lit(1))).first()
    result = PIECES.format(kind) + (", ids array<int>" if with_ids else "")
    if not count:
        return spark.createDataFrame([], result)
    width = "<u2" if tasks.first().width == 2 else "<u4"
    # whole vectors meet twice: within tasks, then those of the tasks; each is one number per id
    some = tasks.select("ids").mapInArrow(add_frequencies, "ids binary")
    total = some.repartition(1).mapInArrow(add_frequencies, "ids binary").first().ids
    frequency = np.frombuffer(total, "<i8")
    idf = np.log1p((count - frequency + 0.5) / (frequency + 0.5))
    shared = spark.sparkContext.broadcast((idf, width))
    partitions = max(1, -(-size // PARTITION_TOKENS))
    laid = tokens.repartitionByRange(partitions, "route", F.xxhash64("doc_id", "n")).sortWithinPartitions(
        "route", F.xxhash64("doc_id", "n"))
    return laid.select("doc_id", "ids").mapInArrow(
        pack_partition(shared, window, shard_tokens, with_ids), result
    )
