"""Language identification by sparse multinomial logistic regression.

Features are TF-IDF weights of hashed character 1- to 3-grams. Document
frequencies are counted over all rows that may be learnt from; the weights are
fitted on a bounded sample of them by follow-the-regularised-leader with L1 and L2
penalties, and one temperature, fitted on sample rows left out of training,
calibrates the probabilities. Predictions read the whole text and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stage

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
FIT_ROWS = 4_000  # at most about so many rows are fitted on, shared by the languages
FIT_ENTRIES = 12_000_000  # and on about so many gram counts; fewer rows of each language where they have more
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-5, 1e-5
UNDETERMINED = "und"
CODE_PIECE = 1 << 20  # characters counted at once


def gram_buckets(text: str) -> np.ndarray:
    """Buckets of all 1- to 3-grams of one piece of lower-cased text."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    mixed = codes * np.uint32(0x9E3779B1)
    grams = [mixed]
    for n in (2, 3):
        if len(codes) >= n:
            grams.append(grams[-1][:-1] * np.uint32(0x85EBCA6B) + mixed[n - 1 :])
    return np.concatenate([(g ^ (g >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(32 - BUCKET_BITS)
                           for g in grams])


def gram_counts(text: str) -> np.ndarray:
    """Occurrences per bucket over the whole text, in pieces that overlap by two."""
    text = text.lower()
    if len(text) <= CODE_PIECE:
        return np.bincount(gram_buckets(text), minlength=BUCKETS)
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(text), CODE_PIECE):
        piece = text[max(0, at - 2) : at + CODE_PIECE]
        total += np.bincount(gram_buckets(piece), minlength=BUCKETS)
        if at:  # what lies in the overlap was counted with the piece before
            total -= np.bincount(gram_buckets(piece[:2]), minlength=BUCKETS)
    return total


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows per bucket of one task, as sparse (bucket, rows)."""
    found, rows = np.zeros(BUCKETS, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            found += gram_counts(text) > 0
            rows += 1
    hit = np.flatnonzero(found)
    if rows:  # bucket -1: all rows
        yield pa.record_batch(
            [pa.array(np.append(hit, -1), pa.int64()), pa.array(np.append(found[hit], rows), pa.int64())],
            names=["bucket", "rows"],
        )


@dataclass
class Model:
    """A fitted classifier: bounded by buckets x languages."""

    languages: list[str]
    weights: np.ndarray  # BUCKETS x languages, IDF included
    bias: np.ndarray
    temperature: float

    def scores(self, text: str) -> np.ndarray:
        counts = gram_counts(text)
        hit = np.flatnonzero(counts)
        tf = counts[hit] / max(1, counts.sum())
        return tf @ self.weights[hit] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not has_letter(text) or not self.languages:
            return UNDETERMINED, 0.0
        p = softmax(self.scores(text) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class SparseRows:
    """TF-IDF rows over packed gram counts, with 1 for the bias; a row is unpacked while it is looked at.

    A count takes six bytes packed and twelve unpacked, and all rows are in the driver.
    """

    def __init__(self, sample: list, idf: np.ndarray, scale: float | None = None):
        self.sample, self.idf, self.scale = sample, idf, scale
        if scale is None:  # one scale for all keeps a prediction linear in the counts
            norms = [np.sqrt((self.tfidf(i)[1] ** 2).sum()) or 1.0 for i in range(len(sample))]
            self.scale = 1 / float(np.median(norms))

    def part(self, chosen: np.ndarray) -> SparseRows:
        return SparseRows([self.sample[i] for i in np.flatnonzero(chosen)], self.idf, self.scale)

    def __len__(self) -> int:
        return len(self.sample)

    def tfidf(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        hit, times = np.frombuffer(self.sample[i].hit, "<u2"), np.frombuffer(self.sample[i].times, "<u4")
        return hit, times / max(1, times.sum(dtype=np.int64)) * self.idf[hit]

    def __getitem__(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i >= len(self):
            raise IndexError(i)
        hit, weight = self.tfidf(i)
        return np.append(hit.astype(np.int32), np.int32(BUCKETS)), np.append(weight * self.scale, 1.0)


def ftrl(rows: Sequence[tuple[np.ndarray, np.ndarray]], y: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """FTRL-proximal over sparse rows; returns weights and bias."""
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))

    def current(i):
        zi = z[i]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[i])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for r in order.permutation(len(rows)):
            index, x = rows[r]
            w = current(index)
            p = softmax(x @ w)
            p[y[r]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[index] + g * g) - np.sqrt(n[index])) / ALPHA
            z[index] += g - sigma * w
            n[index] += g * g
    w = current(slice(None))
    return w[:-1], w[-1]


def temperature_of(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by a search on a grid of ratios."""
    if not len(y):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(20), 121))
    loss = []
    for t in grid:
        log_p = np.log(softmax(logits / t) + 1e-12)
        # a little mass on the other languages: rows told apart perfectly must not end in certainty
        loss.append(-(0.998 * log_p[np.arange(len(y)), y] + 0.002 * log_p.mean(1)).mean())
    return float(grid[int(np.argmin(loss))])


def sparse_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram counts of (lang, pick, text), once for rows of a task that are equal."""
    seen = set()
    for batch in batches:
        for lang, pick, text in zip(*batch.columns):
            key = (lang.as_py(), pick.as_py())
            if key in seen:
                continue
            seen.add(key)
            counts = gram_counts(text.as_py())
            hit = np.flatnonzero(counts)
            yield pa.record_batch(
                [pa.array([key[0]], pa.string()), pa.array([key[1]], pa.int64()), pa.array([len(hit)], pa.int64()),
                 pa.array([hit.astype("<u2").tobytes()], pa.binary()),
                 pa.array([np.minimum(counts[hit], 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary())],
                names=["lang", "pick", "n", "hit", "times"],
            )


def fit_rows(labelled: DataFrame, fit_rows: int) -> tuple[list[str], list]:
    """Languages in order, and rows (lang, hit, times) of a bounded sample with like numbers of each.

    Drawn are distinct texts, whatever their length, and each language has its own
    limit. Rows too rich for FIT_ENTRIES make the samples smaller, never other: a
    language's first rows in the order of the draw stay, one at least.
    """
    picked = labelled.withColumn("pick", F.xxhash64("text", F.lit("fit")))
    distinct = picked.select("lang", "pick").distinct()
    counts = distinct.groupBy("lang").count().orderBy("lang").collect()  # one row a language
    if not counts:
        return [], []
    share = max(1, fit_rows // len(counts))
    ample = share + 4 * share**0.5 + 8  # so that hardly any language gets less than its share
    part = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, ample / r["count"])))])
    draw = F.pmod("pick", F.lit(1 << 30)) / float(1 << 30)
    by_pick = Window.partitionBy("lang").orderBy("pick")
    keys = distinct.where(draw < F.element_at(part, F.col("lang"))).withColumn(
        "rank", F.row_number().over(by_pick)
    ).where(F.col("rank") <= share).select("lang", "pick")
    found = picked.select("lang", "pick", "text").join(F.broadcast(stage(keys, "fit_keys")), ["lang", "pick"], "left_semi")
    rows = stage(found.mapInArrow(sparse_counts, "lang string, pick long, n long, hit binary, times binary"), "fit_rows")
    sized = rows.groupBy("lang", "pick").agg(F.first("n").alias("n")).withColumn(
        "before", F.sum("n").over(by_pick) - F.col("n"))
    room = FIT_ENTRIES // len(counts)
    chosen = sized.where((F.col("before") == 0) | (F.col("before") + F.col("n") <= room)).select("lang", "pick")
    sample = rows.join(F.broadcast(chosen), ["lang", "pick"], "left_semi").dropDuplicates(["lang", "pick"])
    return [r["lang"] for r in counts], sample.orderBy("pick", "lang").select("lang", "hit", "times").collect()


def train(labelled: DataFrame, rows: int = FIT_ROWS) -> Model:
    """Fit on (text, lang): frequencies over all rows, weights on a sample."""
    labelled = labelled.where("lang is not null and text is not null and text <> ''").select("text", "lang")
    spark = labelled.sparkSession
    counted = labelled.select("text").mapInArrow(document_frequencies, "bucket long, rows long")
    frequency = np.zeros(BUCKETS)
    total = 0
    for row in counted.groupBy("bucket").agg(F.sum("rows").alias("rows")).collect():  # BUCKETS + 1 rows
        if row.bucket < 0:
            total = row.rows
        else:
            frequency[row.bucket] = row.rows
    idf = np.log((1 + total) / (1 + frequency)) + 1
    languages, sample = fit_rows(labelled, rows)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0)
    x = SparseRows(sample, idf)
    at = {lang: i for i, lang in enumerate(languages)}
    y = np.array([at[row.lang] for row in sample])
    held = np.arange(len(x)) % 5 == 0
    if held.all():
        held[:] = False
    weights, bias = ftrl(x.part(~held), y[~held], len(languages))
    full = np.vstack([weights, bias])
    logits = np.array([t @ full[i] for i, t in x.part(held)]).reshape(-1, len(languages))
    return Model(languages, weights * (idf * x.scale)[:, None], bias, temperature_of(logits, y[held]))


def language_of(model: Model, spark: SparkSession):
    """A function of a text column: struct of lang_pred and score."""
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x languages

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for texts in batches:
            yield pd.DataFrame([known.predict(t) for t in texts], columns=["lang_pred", "score"])

    return predict


def identify_languages(
    docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, text_hash (xxhash64 of the text), lang_pred and score.

    ``und`` with score 0 where the text is null or has no letter, or where nothing
    could be learnt. Other columns are not looked at.
    """
    found = language_of(model, docs.sparkSession)(F.col(text).cast("string"))
    return docs.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), found.alias("found")
    ).select("doc_id", "text_hash", "found.lang_pred", "found.score")


def in_fold(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` modulo ``folds``; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))
