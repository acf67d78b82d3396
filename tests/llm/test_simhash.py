import random

import pytest
import xxhash

from pairwright.llm.components import connected_components
from pairwright.llm.simhash import best_k, close_pairs, grids, segment_counts, simhash_dedup
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string"


def brute_print(text, words=4):
    parts = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not parts:
        return 0
    shingles = [b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least.setdefault(find(i), []).append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        known = [d for d in least[find(i)] if d is not None]
        out.append((doc_id, f"{prints[i]:016x}", min(known) if known else None))
    return out


def corpus(seed, n):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdeé ", k=5)).replace(" ", "x") for _ in range(300)]
    texts = []
    for _ in range(n):
        if texts and draw.random() < 0.6:
            parts = (draw.choice(texts) or "a").split(" ")
            for _ in range(draw.choice([0, 0, 1, 1, 2])):
                parts[draw.randrange(len(parts))] = draw.choice(words)
            texts.append(" ".join(parts))
        else:
            texts.append(" ".join(draw.choices(words, k=draw.choice([1, 3, 4, 60, 200]))))
    return texts


def key(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0))


def test_equals_all_pairs(spark):
    texts = [None, "", " \t\n", "one", "ONE", "One two", "a b c", "É é", *corpus(3, 150)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "one"), (7, "a b c"), (7, "a b c"), (None, "lone text")]
    got = simhash_dedup(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "fingerprint", "component_id")
    assert key(map(tuple, got.collect())) == key(brute(rows))


def test_one_document_of_each_component_is_kept(spark):
    rows = [(i, t) for i, t in enumerate(corpus(5, 80))]
    got = simhash_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(r.doc_id for r in got if r.kept) == sorted({r.component_id for r in got})


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash_dedup(empty).count() == 0
    clash = spark.createDataFrame([(1, "a b", 5, 6)], "doc_id long, text string, fp int, n int")
    assert simhash_dedup(clash).first().component_id == 1


@pytest.mark.parametrize("k", [1, 2, 3])
def test_close_fingerprints_share_a_cell(spark, k):
    draw = random.Random(k)
    masks = grids(4, k)
    pairs = []
    for _ in range(300):
        a = draw.getrandbits(64)
        b = a
        for bit in draw.sample(range(64), draw.randint(0, 4)):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    counted = df.select(segment_counts(F.col("a")).alias("a"), segment_counts(F.col("b")).alias("b"))
    for a, b in counted.collect():
        assert any((a & m) == (b & m) for m in masks)


def test_larger_inputs_take_finer_grids():
    ks = [best_k(n, 4) for n in (1_000, 10**6, 10**8, 10**10)]
    assert ks == sorted(ks) and ks[0] == 1 and ks[-1] > 2


def test_blocks_of_a_cell_keep_all_links():
    import pandas as pd

    draw = random.Random(1)
    base = draw.getrandbits(64)
    prints = sorted({base ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for _ in range(700)})
    pdf = pd.DataFrame({"fp": pd.Series(prints, dtype="uint64").to_numpy().view("int64"), "own": 0, "lo": 0, "hi": 0})
    links = close_pairs(4)(pdf)
    assert len(links) == len(prints) - 1 and links.v.nunique() == 1


def test_components_of_a_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    links = spark.createDataFrame(chain + hub + [(5, 5), (None, 3), (3, 2)], "u long, v long")
    got = {r.node: r.root for r in connected_components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(300)}
