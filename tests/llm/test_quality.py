import random

import numpy as np

from pairwright.llm.quality import (
    STATISTICS, Scorer, document_statistics, fit_quality, pooled, score_quality, statistics,
)

SCHEMA = "doc_id long, text string"


def corpus(seed, n):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(draw.choices("abcdefgh", k=draw.randint(2, 8))) for _ in range(draw.randint(5, 120))]
        good = draw.random() < 0.6
        rows.append((i, " ".join(words) + "." if good else "!! ".join(words).upper(), int(good)))
    return rows


def test_held_out_scores(spark):
    rows = corpus(2, 500)
    stats = document_statistics(spark.createDataFrame([r[:2] for r in rows], SCHEMA)).cache()
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 4 != 2] + [(0, None), (None, 1), (1, rows[1][2])],
                                   "doc_id long, label int")
    model = fit_quality(stats, labels)
    got = {r.doc_id: r.score for r in score_quality(stats, model).collect()}
    assert len(got) == 500 and all(0 <= s <= 1 for s in got.values())
    held = [(got[i], y) for i, _, y in rows if i % 4 == 2]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    odd = [(1, None), (2, ""), (3, " \n"), (None, "some text"), (4, "w " * 300_000), (4, "w " * 300_000)]
    clash = spark.createDataFrame(odd, SCHEMA).selectExpr("*", "1 AS stats", "2 AS score")
    found = score_quality(document_statistics(clash), model).collect()
    assert len(found) == 6 and len({r.score for r in found if r.doc_id in (1, 2, 3)}) == 1


def test_without_labels_or_rows(spark):
    none = spark.createDataFrame([], "doc_id long, label int")
    stats = document_statistics(spark.createDataFrame([(1, "a")], SCHEMA))
    assert score_quality(stats, fit_quality(stats, none)).first().score == 0.5
    empty = document_statistics(spark.createDataFrame([], SCHEMA))
    assert score_quality(empty, fit_quality(empty, none)).count() == 0


def test_fourier_features_approximate_the_kernel():
    draw = np.random.default_rng(1)
    x = draw.normal(0, 1, (30, STATISTICS))
    z = Scorer(np.zeros(STATISTICS), np.ones(STATISTICS)).fourier(x)[:, :-1]
    exact = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * STATISTICS))
    assert np.abs(z @ z.T - exact).max() < 0.2


def test_pooled_steps_never_fall_and_keep_the_mean():
    draw = np.random.default_rng(2)
    bins = [(n, draw.integers(0, n + 1), n * i / 50) for i, n in enumerate(draw.integers(1, 20, 50))]
    scores, levels = pooled(bins)
    assert (np.diff(scores) > 0).all() and (np.diff(levels) >= 0).all()


def test_statistics_are_finite():
    for text in (b"", b" ", b"a", b"\n\n", "é ñ".encode(), b"A" * 100_000, bytes(range(256))):
        assert np.isfinite(statistics(text)).all() and len(statistics(text)) == STATISTICS
