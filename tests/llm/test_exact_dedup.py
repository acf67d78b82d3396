import hashlib

import pytest

from pairwright.llm.common import keep_documents, repeat_documents
from pairwright.llm.exact_dedup import exact_dedup
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(doc_id)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        seen = False
        for i in sorted(ids, key=lambda i: (i is None, i)):
            out.append((i, keep, len(ids), i == keep and not seen, sha))
            seen = seen or i == keep
    return out


def key(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v) for v in r))


ROWS = (
    [(i, f"text {i % 37}".upper() if i % 3 else f"text {i % 37}") for i in range(200)]
    + [(1000 + i, f"lone {i}") for i in range(300)] + [(2000 + i, "very common") for i in range(400)]
    + [(3000, None), (3001, ""), (None, ""), (None, "nobody's"), (None, "nobody's"), (7, "TEXT 7"), (199, "text 14")]
    + [(4000, "É"), (4001, "é"), (4002, "x" * 200_000), (4003, "X" * 200_000)]
)


@pytest.mark.parametrize("filter_bits", [1 << 30, 1 << 12])
def test_equals_brute_force(spark, filter_bits):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(5).selectExpr("*", "1 AS digest", "2 AS rid")
    got = exact_dedup(df, filter_bits=filter_bits).drop("text_hash").collect()
    assert key(got) == key(brute(ROWS))


def test_empty_table(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).count() == 0


def test_kept_rows_with_all_their_columns(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("text_hash", F.lit("own")).withColumn("n", F.lit(1))
    found = exact_dedup(df).where("group_size > 1").select("doc_id", "text_hash", "kept")
    kept = keep_documents(df, found)
    assert kept.columns == df.columns
    want = sorted(((d is None, d), s) for d, _, _, k, s in brute(ROWS) if k)
    got = sorted(((r.doc_id is None, r.doc_id), hashlib.sha256((r.text or "").translate(LOWER).encode()).hexdigest())
                 for r in kept.collect())
    assert got == want


def test_documents_as_often_as_taken(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (None, "c"), (4, None)], SCHEMA)
    times = df.select("doc_id", F.xxhash64("text").alias("text_hash"),
                      F.when(F.col("doc_id") == 4, 0).otherwise(2).alias("times"))
    got = [(r.doc_id, r.text) for r in repeat_documents(df.withColumn("times", F.lit(9)), times).collect()]
    assert sorted(got, key=str) == sorted([(1, "a")] * 2 + [(2, "b")] * 4 + [(None, "c")] * 2, key=str)
