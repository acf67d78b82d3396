"""Similar documents against all pairs of exact shingles."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairwright.llm import similar
from pairwright.llm.similar import closest, jaccard, layout, most_bits, similar_documents


def plain_jaccard(a, b, words=5):
    def grams(text):
        parts = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
        if not parts:
            return set()
        return {tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))}

    one, two = grams(a), grams(b)
    return len(one & two) / len(one | two) if one | two else 1.0


def test_jaccard_is_the_plain_one():
    rng = random.Random(1)
    for _ in range(300):
        a = [rng.choice("abcdef") for _ in range(rng.randrange(0, 14))]
        b = [rng.choice([x, "z"]) if rng.random() < 0.2 else x for x in a]
        assert jaccard(" ".join(a).encode(), " ".join(b).encode(), 5) == plain_jaccard(" ".join(a), " ".join(b))


def changed(words, share, rng):
    return [f"new{rng.randrange(9**9)}" if rng.random() < share else w for w in words]


def corpus(rng, clusters):
    rows = []
    for c in range(clusters):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([40, 80, 200, 500, 900]))]
        rows.append(" ".join(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            rows.append(" ".join(changed(base, rng.choice([0.002, 0.01, 0.02, 0.03, 0.05]), rng)))
    return rows


def components(texts, links):
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(len(texts))]


def test_recall_and_precision_against_all_pairs(spark):
    """Measured: 0.98 or more of the pairs at 0.8 or more, no unlike pair by itself."""
    rng = random.Random(7)
    texts = corpus(rng, 260)
    pairs = [
        (i, j) for i in range(len(texts)) for j in range(i + 1, min(i + 6, len(texts))) if plain_jaccard(texts[i], texts[j]) >= 0.8
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in similar_documents(df).collect()}
    found = sum(got[i].component_id == got[j].component_id for i, j in pairs)
    assert len(pairs) > 150 and found >= 0.97 * len(pairs)
    want = components(texts, pairs)
    for i, r in got.items():
        assert want[r.component_id] == want[i]  # no component joins what exact links do not
        assert r.kept == (r.component_id == i)


def test_recall_by_similarity():
    """The distance limit keeps 0.97 of the pairs between 0.8 and 0.85."""
    rng, near = random.Random(3), []
    while len(near) < 300:
        base = [f"w{rng.randrange(9999)}" for _ in range(rng.randrange(60, 900))]
        other = changed(base, 0.02, rng)
        if 0.8 <= plain_jaccard(" ".join(base), " ".join(other)) < 0.85:
            a, b = (similar.wide_fingerprint(" ".join(x).encode(), 5).view(np.uint64) for x in (base, other))
            near.append(int(np.bitwise_count(a ^ b).sum()))
    assert sum(d <= most_bits(0.8) for d in near) >= 0.97 * len(near)


def test_larger_inputs_take_finer_grids():
    sizes = [layout(n, 0.8) for n in (10**3, 10**5, 10**7, 10**9)]
    assert sizes == sorted(sizes) and sizes[0][0] < sizes[-1][0]


@pytest.mark.parametrize("with_sides", [False, True])
def test_closest_pairs_connect_all_near_ones(with_sides):
    draw = np.random.default_rng(5)
    base = draw.integers(0, 1 << 63, (40, 4), dtype=np.int64).view(np.uint64)
    rows = base[draw.integers(0, 40, 700)]
    for k in range(4):
        rows[:, k] ^= np.uint64(1) << draw.integers(0, 64, 700).astype(np.uint64)
    side = draw.integers(0, 2, 700) if with_sides else None
    u, v = closest(rows, side, 12)
    apart = sum(np.bitwise_count(rows[:, None, k] ^ rows[None, :, k]).astype(int) for k in range(4))
    near = apart <= 12
    if with_sides:
        near &= side[:, None] != side[None, :]
    assert near[u, v].all() and len(u) < 5 * 700
    every = components(range(700), [(i, j) for i, j in zip(*np.nonzero(near)) if i < j])
    assert components(range(700), list(zip(u.tolist(), v.tolist()))) == every


def test_blocks_of_a_hot_cell(spark, monkeypatch):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(300)]
    texts = [" ".join(changed(base, 0.004, rng)) for _ in range(120)] + [f"other text number {i} of its own kind here" for i in range(20)]
    monkeypatch.setattr(similar, "BLOCK", 16)
    monkeypatch.setattr(similar, "PAIRS_EACH", 3)
    df = spark.createDataFrame([(i + 5, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = similar_documents(df).collect()
    assert sum(r.kept for r in got if r.doc_id < 125) == 1 and {r.component_id for r in got if r.doc_id < 125} == {5}
    assert all(r.kept for r in got if r.doc_id >= 125)


def test_crowd_of_unlike_neighbours_keeps_every_link(spark):
    """Copies that are alike to one text only: their closest neighbours are too unlike, the further one is not."""
    rng = random.Random(23)
    base = [f"w{rng.randrange(9**6)}" for _ in range(220)]
    texts = [" ".join(base)]
    for i in range(40):
        other = list(base)
        for at in range(i % 44, 220, 55):  # 4 words, 20 of 216 shingles
            other[at] = f"new{i}x{at}"
        texts.append(" ".join(other))
    pairs = [(i, j) for i in range(41) for j in range(i) if plain_jaccard(texts[i], texts[j]) >= 0.8]
    assert len(pairs) >= 40
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in similar_documents(df).collect()}
    want = components(texts, pairs)
    assert [got[i] for i in range(41)] == [want[i] for i in range(41)]


def test_rows_with_pairs_beyond_the_chosen_are_named():
    draw = np.random.default_rng(8)
    base = draw.integers(0, 1 << 63, (12, 4), dtype=np.int64).view(np.uint64)
    rows = base[draw.integers(0, 12, 300)]
    for k in range(4):
        rows[:, k] ^= np.uint64(1) << draw.integers(0, 64, 300).astype(np.uint64)
    u, v, left = similar.near_pairs(rows, None, 12)
    apart = sum(np.bitwise_count(rows[:, None, k] ^ rows[None, :, k]).astype(int) for k in range(4))
    near = apart <= 12
    np.fill_diagonal(near, False)
    near[u, v] = near[v, u] = False
    assert set(left.tolist()) == set(np.flatnonzero(near.any(axis=1)).tolist())


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b c"), (4, "A B c"), (4, "a b c"), (4, "a b c"), (9, "x " * 20000), (8, "x " * 19000), (7, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("cell", F.lit(1)).withColumn("u", F.lit("u"))
    got = sorted(((r.doc_id or 0), r.component_id) for r in similar_documents(df).collect())
    assert got == [(0, 4), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (4, 4), (7, 7), (8, 8), (9, 8)]
    # "a b c" comes in two cases: two texts, of which the one with the smaller hash stays, with its copies
    kept = [r.doc_id for r in similar_documents(df).collect() if r.kept]
    assert sorted(kept) in ([1, 4, 7, 8], [1, 4, 4, 7, 8])
    assert similar_documents(df.limit(0)).collect() == []
