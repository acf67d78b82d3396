import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pairwright.llm.packing import Packer, Shard, pack_documents
from pairwright.llm.tokens import SETTLED, Encoder, long_run

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH)


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def test_fast_ids_on_every_settled_character(encoder, plain):
    chars = [chr(c) for c in range(0x530)] + [chr(c) for c in range(0x2000, 0x2070)]
    text = "".join(f"a{c}b {c} {c}{c}  {c}1{c}\n" for c in chars)
    assert not SETTLED.search(text)
    assert encoder.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_pieces_without_looking_ahead(encoder, plain):
    """Runs of white space that need no look ahead go to the faster encoding, all others do not."""
    spaces = [" ", "\n", "\t", "\r", "\x0b", "\x1c", "\x85", "\xa0", "\u2003", "\u2028"]
    runs = ["".join(run) for n in (1, 2, 3) for run in itertools.product(spaces, repeat=n)]
    for run in runs:
        for text in (f"a{run}b", f"a{run}1", f"a.{run}!", f"{run}'s", f"it's{run}", run):
            assert encoder.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
    assert [long_run(t) for t in ("a\n\nb  c", "a b\n", "a\n\n\nb", "a \n", "a\t b", "a\t \u2003b")] == [False, False, True, True, False, True]
    assert encoder.faster.encode_ordinary("One two's.\n\nThree  4") == encoder.fast.encode_ordinary("One two's.\n\nThree  4")


SOME = ["a", "Word", " ", "  ", " \n", "\n\n", "\n", "\t", "\u2003", "é", "'s", "12", "!?", "ß", "語", "<|endoftext|>", "\x85", "x" * 40]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from(SOME), max_size=12), max_size=9))
def test_texts_encoded_at_once_have_the_tokenizers_ids(encoder, plain, parts):
    texts = ["".join(p) for p in parts]
    assert [i.tolist() for i in encoder.encode_all(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_word_of_many_texts_is_encoded_once(plain, monkeypatch):
    from pairwright.llm import tokens

    fresh, seen = Encoder(PATH), []
    fast = fresh.faster.encode_ordinary

    class Counting:
        def encode_ordinary(self, text):
            seen.append(text)
            return fast(text)

    monkeypatch.setitem(fresh.__dict__, "faster", Counting())
    monkeypatch.setattr(tokens, "GATHERED", 1 << 20)
    texts = [f"{'unheardof ' * 50}in {i}" for i in range(40)] + ["", "unheardof"]
    assert [i.tolist() for i in fresh.encode_all(texts)] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(t.count("unheardof") for t in seen) <= len(texts) + 1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", "\n", "\t", "é", "'s", "12", "!?", "ß", "語", "<|endoftext|>", " ", "\x85"]), max_size=20))
def test_ids_are_the_tokenizers(parts):
    text = "".join(parts)
    assert Encoder(PATH).encode(text).tolist() == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


def check(rows, pieces, window, encoder):
    """Every id in one piece, sequences without gaps, at most one short sequence a task."""
    wanted = sorted(
        (d if d is not None else -1, zlib.crc32(np.append(encoder.encode(t or ""), 0).astype("<u4").tobytes()))
        for d, t in rows
    )
    by_text = {}
    for d, t in rows:
        ids = np.append(encoder.encode(t or ""), 0).astype("<u4")
        by_text.setdefault((d, len(ids)), []).append(ids)
    total = 0
    spaces = {}
    for p in pieces:
        candidates = by_text[(p.doc_id, p.doc_tokens)]
        assert any(zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for ids in candidates)
        total += p.length
        spaces.setdefault(p.sequence_id, []).append((p.offset, p.length))
    assert total == sum(len(ids) for group in by_text.values() for ids in group) and len(wanted) == len(rows)
    short = 0
    for parts in spaces.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        short += at < window
    return short


def test_round_trip(spark, encoder):
    texts = [None, "", "a", "long words " * 900, *(f"text {i} about {i % 7} " * (5 + i % 60) for i in range(120))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (5, texts[5]), (5, texts[5])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = pack_documents(df, PATH, window=256, shard_tokens=2000)
    pieces = got.collect()
    assert check(rows, pieces, 256, encoder) <= 1
    assert all(zlib.crc32(np.array(p.ids, "<u4").tobytes()) == p.ids_crc32 for p in pieces)


def test_empty_table_and_clashing_columns(spark):
    assert pack_documents(spark.createDataFrame([], SCHEMA), PATH).count() == 0
    clash = spark.createDataFrame([(1, "a b", 2, 3)], "doc_id long, text string, ids int, kind int")
    assert pack_documents(clash, PATH).count() == 1


def test_the_window_is_filled_with_the_most_alike():
    docs = [np.array(d) for d in ([1, 2, 3, 4], [9, 9, 9, 8], [1, 2, 3, 5], [8, 7, 6, 9])]
    packer = Packer(0, 8)
    rows = packer.pack(docs, np.ones(10))
    assert [(r[0], r[3]) for r in rows] == [(0, 0), (2, 0), (1, 1), (3, 1)]


def test_scores_equal_brute_force():
    draw = np.random.default_rng(2)
    docs = [draw.integers(0, 50, draw.integers(5, 40)) for _ in range(30)]
    idf = draw.uniform(0.1, 3, 50)
    shard = Shard(docs, idf)
    mean = np.mean([len(d) for d in docs])
    for seed in range(5):
        for j, doc in enumerate(docs):
            want = 0.0
            for t in set(docs[seed].tolist()):
                tf = (doc == t).sum()
                want += idf[t] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(doc) / mean))
            if len(set(docs[seed].tolist())) <= 32:
                assert abs(shard.scores(seed)[j] - want) < 1e-9


def test_all_terms_of_a_long_seed_count():
    """The seed's 40 rarest ids are its own; it shares ten commoner ones with the last document."""
    docs = [np.arange(50), np.array([60, 61, 62]), np.arange(40, 50)]
    idf = np.where(np.arange(70) < 40, 9.0, 1.0)
    rows = Packer(0, 60).pack(docs, idf)
    assert [r[0] for r in rows] == [0, 2, 1]


def test_scores_stay_when_used_documents_leave_the_index():
    draw = np.random.default_rng(3)
    docs = [draw.integers(0, 90, draw.integers(40, 80)) for _ in range(40)]
    shard, unused = Shard(docs, draw.uniform(0.1, 3, 90)), np.ones(40, bool)
    before = shard.scores(2)
    unused[:20] = False
    shard.keep(unused)
    assert shard.live == 20 and np.allclose(shard.scores(2)[20:], before[20:]) and (shard.scores(2)[:20] == 0).all()


def test_the_matrix_changes_no_window(monkeypatch):
    from pairwright.llm import packing

    draw = np.random.default_rng(4)
    common = draw.integers(0, 40, (60, 90))
    docs = [np.concatenate([common[i % 60][: 10 + i % 70], draw.integers(0, 900, 5 + i % 60)]) for i in range(400)]
    idf = draw.uniform(0.1, 3, 900)
    with_matrix = Packer(0, 128).pack(docs, idf)
    assert len(Shard(docs, idf).matrix) > 20
    monkeypatch.setattr(packing, "MATRIX_DOCS", 0)
    assert len(Shard(docs, idf).matrix) == 0
    assert Packer(0, 128).pack(docs, idf) == with_matrix


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", " ", " ", "\n", "\t", "the", "é", "'s", "12", "!?", "ß", "  ", " \n", "\xa0", " ", "x" * 50, ","]), max_size=30))
def test_ids_around_white_space_are_the_tokenizers(encoder, plain, parts):
    text = "".join(parts)
    assert encoder.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids
    assert encoder.encode_plain(" " + text).tolist() == plain.encode(" " + text, add_special_tokens=False).ids
