"""The stages one after the other against plain Python on a small fixture."""

import random
import zlib

import pytest

import corpus_pipeline
from pairwright.llm.common import stage

from test_similar import components

SYLLABLES = {"en": ["the", "and", "ing", "er"], "de": ["sch", "ein", "ung", "der"]}


def corpus():
    draw = random.Random(9)
    rows = []
    for i in range(160):
        lang = draw.choice(list(SYLLABLES))
        words = ["".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 4))) for _ in range(draw.randint(20, 120))]
        rows.append([i, " ".join(words), lang, f"src{i % 4}", 0])
    rows += [[200 + i, rows[i][1].upper() if i % 2 else rows[i][1], rows[i][2], "src1", 0] for i in range(30)]
    for i in range(30, 50):
        words = rows[i][1].split(" ") * 6
        rows[i][1] = " ".join(words)
        words[3] = "changed"
        rows.append([300 + i, " ".join(words), rows[i][2], None, 0])
    rows += [[400, None, "en", "src0", 0], [401, "", None, "src0", 0], [402, "123 !!", "en", None, 0],
             [None, rows[60][1] + " more", "en", "src2", 0], [70, rows[70][1], rows[70][2], "src9", 0]]
    return [tuple(r) for r in rows]


def kept_of_similar(rows):
    """Of texts joined by 5-word shingles alike to 0.8 or more the one with the smallest doc_id."""
    grams = []
    for _, text in rows:
        parts = text.lower().split()
        grams.append({tuple(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))})
    alike = lambda a, b: len(a & b) >= 0.8 * (len(a) + len(b) - len(a & b))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if grams[i] & grams[j] and alike(grams[i], grams[j])]
    first = {}
    for row, root in zip(rows, components(rows, links)):
        key = (row[0] is None, row[0] or 0)
        first[root] = min(first.get(root, (key, row)), (key, row))
    return sorted((row for _, row in first.values()), key=str)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(corpus(), "doc_id long, text string, lang string, source string, n_chars long").repartition(
        3).write.parquet(path + "/documents.parquet")
    spark.createDataFrame([(i, i % 2, 0) for i in range(0, 100, 3)], "doc_id long, quality int, toxic int").write.parquet(
        path + "/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet")
    columns = docs.columns
    steps = dict(corpus_pipeline.STAGES)
    assert [*steps] == ["language_id", "exact_dedup", "simhash_dedup", "mixing", "packing"]
    rows = lambda df: sorted(((r.doc_id, r.text) for r in df.collect()), key=str)

    docs = stage(steps["language_id"](spark, docs, folder), "one")
    assert docs.columns == columns
    kept = rows(docs)
    assert kept == sorted(((d, t) for d, t, *_ in corpus() if t and any(c.isalpha() for c in t)), key=str)

    docs = stage(steps["exact_dedup"](spark, docs, folder), "two")
    groups = {}
    for d, t in kept:
        groups.setdefault(t.translate({c: c + 32 for c in range(65, 91)}), []).append((d is not None, d or 0, t))
    unique = sorted(((d if known else None, t) for known, d, t in map(max, groups.values())), key=str)
    assert rows(docs) == unique and docs.columns == columns

    docs = stage(steps["simhash_dedup"](spark, docs, folder), "three")
    first = kept_of_similar(unique)
    assert rows(docs) == first
    assert len(first) < len(unique) - 15 and docs.columns == columns

    before = rows(docs)
    docs = stage(steps["mixing"](spark, docs, folder), "four")
    after = rows(docs)
    assert set(after) <= set(before) and max(after.count(r) for r in set(after)) <= 2 and docs.columns == columns
    words = lambda rs: sum(len(t.split()) for _, t in rs)
    assert abs(words(after) - 1.5 * words(before)) < 0.15 * words(before)

    pieces = steps["packing"](spark, docs, folder).collect()
    ids = sum(p.length for p in pieces)
    assert ids == sum({(p.doc_id, p.start): p.doc_tokens for p in pieces if p.start == 0}[(d, 0)] for d, _ in after)
    assert all(p.length == len(p.ids) for p in pieces)
    assert all(zlib.crc32(b"".join(i.to_bytes(4, "little") for i in p.ids)) == p.ids_crc32 for p in pieces)


def test_empty_documents(spark, folder, tmp_path):
    path = str(tmp_path)
    spark.read.parquet(folder + "/documents.parquet").limit(0).write.parquet(path + "/documents.parquet")
    spark.read.parquet(folder + "/labels.parquet").write.parquet(path + "/labels.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
