"""Token alignment against plain counting over byte positions."""

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from pairwright.llm import alignment
from pairwright.llm.alignment import BytePairs, Pieces, align_tokenizers

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def plain(rows):
    """Independent of the operator: python loops over byte ends."""
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(A)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=B)
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}

    def groups(text):
        if not text:
            return None
        a = left.encode(" " + text, add_special_tokens=False).ids
        b = right.encode(text)
        a_bytes = [bytes(byte[c] for c in left.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(right.id_to_piece(i)[3:5], 16)]) if right.is_byte(i)
                   else right.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            return None
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]).tolist(), np.cumsum([len(x) for x in b_bytes]).tolist()
        out = defaultdict(lambda: ([], []))
        cuts = sorted(set(a_ends) & set(b_ends))
        for side, (ids, ends) in enumerate([(a, a_ends), (b, b_ends)]):
            for i, end in zip(ids, ends):
                out[next(c for c in cuts if c >= end)][side].append(i)
        return [out[c] for c in cuts]

    found = [(doc_id, groups(text)) for doc_id, text in rows]
    counts = Counter()
    for _, g in found:
        counts.update({(a, b) for x, y in g or [] for a in x for b in y})
    highest = defaultdict(int)
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    result = []
    for doc_id, g in found:
        links = [(a, b) for x, y in g or [] for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g or [])
        result.append((
            doc_id, sum(len(x) for x, _ in g or []), sum(len(y) for _, y in g or []), len(g or []), len(links),
            sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if g else "", text,
        ))
    return result


ROWS = [
    (1, "The cat sat on the mat."), (2, "the cat, the CAT and the ca"), (3, None), (4, ""), (5, " "),
    (6, "  two  spaces \n\t and\r\nlines "), (7, "naïve café über straße ñandú"), (8, "日本語のテキスト 🙂🙂 \U0001f469‍\U0001f4bb"),
    (9, "a <|endoftext|> b <s> c </s> <unk> <0x41>"), (10, "mark ▁ inside"), (11, "\x00 nul �"),
    (None, "The cat sat on the mat."), (1, "The cat sat on the mat."), (12, "=" * 300 + "-" * 77 + "ab" * 90),
    (13, "1234567890" * 20), (14, "hahahahaha" * 50 + "é" * 31), (15, "x"), (16, "é́ ﬁ ½"),
] + [(20 + i, f"word{i % 3} the shared passage of some words number {i}") for i in range(12)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").withColumnsRenamed({}).selectExpr(
        "*", "1 as chunk", "'x' as groups"
    )


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_equals_plain_alignment(spark, docs):
    got = align_tokenizers(docs.repartition(3), A, B, with_groups=True).select(*COLUMNS, "groups").collect()
    assert order(map(tuple, got)) == order(plain(ROWS))


def test_small_chunks_parts_and_pieces(spark, docs, monkeypatch):
    for name, value in [("SEGMENT", 8), ("CHUNK_LINKS", 30), ("BATCH_BYTES", 64), ("FAN", 2), ("PIECE_BYTES", 8), ("LARGE_GROUP", 2)]:
        monkeypatch.setattr(alignment, name, value)
    # the values must hold in the tasks too, so the rows are made here
    rows = []
    import pyarrow as pa

    batch = pa.record_batch([pa.array([r[0] for r in ROWS], pa.int64()), pa.array([r[1] for r in ROWS])], names=["doc_id", "text"])
    sides = BytePairs(A), Pieces(B)
    tables = alignment.decimal_table(sides[0].size), alignment.decimal_table(sides[1].size)
    chunk = alignment.Chunk(0, sides[1].size)
    for lo, hi in alignment.by_bytes(batch.column(1)):
        rows += alignment.documents(batch.column(0)[lo:hi].to_pylist(), batch.column(1)[lo:hi].to_pylist(), sides, tables, chunk, True)
    want = plain(ROWS)
    assert [(r["doc_id"], r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["groups_sha256"], r["groups"]) for r in rows] == [
        (*w[:5], *w[7:]) for w in want
    ]
    counts = Counter()
    for row in chunk.rows():
        pairs = np.cumsum(alignment.unpacked(row["pairs"]))
        counts.update(dict(zip(pairs.tolist(), alignment.unpacked(row["counts"]).tolist())))
    assert counts and sum(alignment.unpacked(r["times"]).sum() for r in chunk.rows()) == sum(w[4] for w in want)
    got = align_tokenizers(docs.repartition(5), A, B).select(*COLUMNS).collect()
    assert order(map(tuple, got)) == order(w[:8] for w in want)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align_tokenizers(empty, A, B).collect() == []
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r)[:8] for r in align_tokenizers(nothing, A, B).collect()) == [
        (1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")
    ]


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_query_equals_plain_alignment(spark):
    from pairwright.llm.queries import op12_alignment

    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_alignment(spark, SF).select(*COLUMNS).collect()
    assert order(map(tuple, got)) == order(w[:8] for w in plain(rows))
