"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Each document becomes a short vector of statistics of its whole text. Random
Fourier features of that vector approximate a Gaussian kernel; every task sums the
normal equations of its rows, the sums meet in one small system, and its ridge
solution gives raw scores. Labelled rows left out of the fit calibrate them: raw
scores are counted in narrow bins and pooled until they never fall.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

FEATURES = 384
RIDGE = 0.3
BINS = 512
LOWEST, HIGHEST = -0.5, 1.5  # raw scores outside share the outermost bins
CLIP = 6.0


def _classes() -> np.ndarray:
    """Character classes of bytes: one row a class."""
    groups = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t\r", b"\n",
              b".?", b",;:", b"!", b"|", b"#$%&*+=@^~\\/_", b"\"'`()[]{}<>-", bytes(range(128, 256))]
    out = np.zeros((len(groups), 256))
    for row, group in zip(out, groups):
        row[np.frombuffer(group, np.uint8)] = 1
    return out


CLASSES = _classes()
WORD_END = CLASSES[[0, 1, 2, 5, 6, 7, 9, 11]].argmax(0)
STATISTICS = 6 + len(CLASSES) + 8 + 6


def statistics(text: bytes) -> np.ndarray:
    """Length, words, characters, word ends, repetition and lines of one whole text."""
    out = np.zeros(STATISTICS)
    raw = np.frombuffer(text, np.uint8)
    words = text.split()
    if not words:
        return out
    counts = np.bincount(raw, minlength=256)
    share = counts / len(raw)
    seen = share[share > 0]
    n = len(words)
    distinct = len(set(words))
    again = sum(map(operator.eq, words, words[1:]))
    lines = [line for line in text.split(b"\n") if line.strip()]
    line_lengths = np.fromiter(map(len, lines), float, len(lines))
    out[:6] = (np.log1p(len(raw)), np.log1p(n), len(raw) / n, -(seen * np.log(seen)).sum(),
               distinct / n, np.log1p(n) * distinct / n)
    out[6 : 6 + len(CLASSES)] = np.sqrt(CLASSES @ share)
    blank = raw <= 32
    ends = raw[:-1][blank[1:] & ~blank[:-1]]
    if not blank[-1]:
        ends = np.append(ends, raw[-1])
    at = 6 + len(CLASSES)
    out[at : at + 8] = np.bincount(WORD_END[ends], minlength=8) / len(ends)
    out[at + 8 :] = (again / n, np.log1p(len(lines)), len(set(lines)) / len(lines),
                     np.log1p(line_lengths.mean()), np.log1p(line_lengths.std()),
                     max(map(len, words)) ** 0.5)
    return out


def document_statistics(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``stats`` of every document; a null or blank text has all zeros."""
    kind = dict(docs.dtypes)[doc_id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py() or b"").astype(np.float32) for t in batch.column(1).cast(pa.binary())]
            yield pa.record_batch(
                [batch.column(0), pa.array(found, pa.list_(pa.float32()))], names=["doc_id", "stats"]
            )

    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, stats array<float>")


@dataclass
class Scorer:
    """A fitted model, of the same size for any input."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    nodes: tuple[np.ndarray, np.ndarray] | None = None

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        """Random Fourier features of a matrix of statistics, and a constant."""
        draw = np.random.default_rng(11)
        width = np.sqrt(stats.shape[1])
        turn = draw.normal(0, 1 / width, (stats.shape[1], FEATURES))
        start = draw.uniform(0, 2 * np.pi, FEATURES)
        x = np.clip((stats - self.mean) / self.scale, -CLIP, CLIP)
        z = np.sqrt(2 / FEATURES) * np.cos(x @ turn + start)
        return np.hstack([z, np.ones((len(z), 1))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.fourier(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        """Calibrated scores; a sliver of the raw score orders rows on one step."""
        if self.weights is None:
            return np.full(len(stats), 0.5)
        raw = np.clip(self.raw(stats), LOWEST, HIGHEST)
        level = np.interp(raw, *self.nodes) if self.nodes else np.clip(raw, 0, 1)
        # equal rows may differ in the last bits, by where they stand in a batch
        return np.round(0.999 * level + 0.001 * (raw - LOWEST) / (HIGHEST - LOWEST), 9)


def matrix_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(float)


def task_sums(model: Scorer):
    """The normal equations of one task: one row for each row of the system."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        rows = 0
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                z = model.fourier(matrix_of(part.column(0)))
                total[:, :-1] += z.T @ z
                total[:, -1] += z.T @ part.column(1).to_numpy(zero_copy_only=False)
                rows += len(z)
        if rows:
            yield pa.record_batch(
                [pa.array(range(len(total)), pa.int32()), pa.array([r.tobytes() for r in total], pa.binary())],
                names=["i", "sums"],
            )

    return run


def add_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up what all tasks have for a row of the system, as a stream."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for i, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            row = np.frombuffer(raw)
            held[i] = held[i] + row if i in held else row
    if held:
        yield pa.record_batch(
            [pa.array(held, pa.int32()), pa.array([r.tobytes() for r in held.values()], pa.binary())],
            names=["i", "sums"],
        )


def pooled(bins: list[tuple[float, float, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over (rows, label sum, score sum); nodes of the steps' centres."""
    stack: list[list[float]] = []
    for n, y, s in bins:
        stack.append([n, y, s])
        while len(stack) > 1 and stack[-2][1] * stack[-1][0] >= stack[-1][1] * stack[-2][0]:
            last = stack.pop()
            stack[-1] = [a + b for a, b in zip(stack[-1], last)]
    # one row more of either label keeps small steps off 0 and 1
    return (np.array([s / n for n, _, s in stack]), np.maximum.accumulate([(y + 0.5) / (n + 1) for n, y, _ in stack]))


def fit_quality(stats: DataFrame, labels: DataFrame) -> Scorer:
    """Fit on ``labels`` (doc_id, label 0 or 1) joined to ``stats``.

    Centre and spread come from all of ``stats``. Labels are averaged over repeated
    rows; null ones are left out. A quarter of the labelled documents, by a digest
    of the id, calibrates. Without labels the model scores 0.5 for all.
    """
    spark = stats.sparkSession
    every = stats.agg(*[f(F.col("stats")[i]) for i in range(STATISTICS) for f in (F.avg, F.stddev_pop)]).first()
    centre = np.array([v or 0.0 for v in every], float).reshape(-1, 2)
    model = Scorer(centre[:, 0], np.where(centre[:, 1] > 1e-9, centre[:, 1], 1.0))
    known = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(
        F.avg(F.col("label").cast("double")).alias("label")
    )
    rows = stats.join(known, "doc_id").withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(4)) == 0)
    rows = stage(rows.select("stats", "label", "calibrates"), "labelled_stats")
    sums = rows.where("not calibrates").select("stats", "label").mapInArrow(task_sums(model), "i int, sums binary")
    merged = sums.repartition(16, "i").mapInArrow(add_sums, "i int, sums binary").collect()  # FEATURES + 1 rows
    if not merged:
        return model
    system = np.stack([np.frombuffer(r.sums) for r in sorted(merged, key=lambda r: r.i)])
    penalty = np.full(FEATURES + 1, RIDGE)
    penalty[-1] = 1e-6
    model.weights = np.linalg.solve(system[:, :-1] + np.diag(penalty), system[:, -1])

    shared = spark.sparkContext.broadcast(model)

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = np.clip(shared.value.raw(matrix_of(batch.column(0))), LOWEST, HIGHEST)
                yield pa.record_batch([pa.array(found), batch.column(1)], names=["raw", "label"])

    scored = rows.where("calibrates").select("stats", "label").mapInArrow(raw, "raw double, label double")
    place = F.floor((F.col("raw") - LOWEST) / (HIGHEST - LOWEST) * BINS)
    bins = scored.groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).cast("double"), F.sum("label"), F.sum("raw")
    ).orderBy("bin").collect()  # at most BINS + 1 rows
    if bins:
        model.nodes = pooled([tuple(b)[1:] for b in bins])
    return model


def score_quality(stats: DataFrame, model: Scorer) -> DataFrame:
    """Adds ``score`` in [0, 1] to doc_id, in place of the statistics."""
    kind = dict(stats.dtypes)["doc_id"]
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = shared.value.score(matrix_of(batch.column(1)))
                yield pa.record_batch([batch.column(0), pa.array(found)], names=["doc_id", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id {kind}, score double")
