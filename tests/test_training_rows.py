import os

import pytest
from pyspark.sql import functions as F

from pairwright.operators.training_rows import (
    format_training_rows,
    tokenizer_counter,
    within_length,
    word_tokens,
)


def pairs_df(spark):
    return spark.createDataFrame([("　问 ", "w", " good ", "bad")], "instruction string, source string, chosen_response string, rejected_response string")


def test_families(spark):
    qwen = format_training_rows(pairs_df(spark), "qwen").first()
    assert tuple(qwen) == (
        "<|im_start|>user\n问<|im_end|>\n<|im_start|>assistant\n", " good <|im_end|>", "bad<|im_end|>",
    )
    llama = format_training_rows(pairs_df(spark), "llama3").first()
    assert llama.prompt == (
        "<|start_header_id|>user<|end_header_id|>\n\n问\n<|eot_id|>"
        "<|start_header_id|>assistant<|end_header_id|>\n\n"
    )
    assert llama.chosen == " good <|eot_id|>"
    with pytest.raises(ValueError, match="family"):
        format_training_rows(pairs_df(spark), "gpt")


def test_short_names_win(spark):
    df = pairs_df(spark).withColumns({"prompt": F.lit("P"), "chosen": F.lit("C"), "rejected": F.lit("R")})
    row = format_training_rows(df).first()
    assert "P<|im_end|>" in row.prompt and row.chosen.startswith("C") and row.rejected.startswith("R")
    only = pairs_df(spark).withColumn("chosen", F.lit("C"))
    assert format_training_rows(only).first().chosen == " good <|im_end|>"


def test_length_budget_holds_for_both_sides(spark):
    rows = [("fits", "p", "a" * 2046, "b"), ("chosen", "p", "a" * 2047, "b"), ("rejected", "p", "b", "a" * 2047)]
    df = spark.createDataFrame(rows, "id string, prompt string, chosen string, rejected string")
    assert [r.id for r in within_length(df).collect()] == ["fits"]
    assert [r.id for r in within_length(df, overhead=1).collect()] == []
    assert within_length(df, double_wrap=True).count() == 0
    wrapped = len("<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    assert within_length(df, 2048 + wrapped, double_wrap=True).count() == 1


def test_word_tokens(spark):
    df = spark.createDataFrame([("汉字, two words_1\n?!",), ("",)], "t string")
    assert [r[0] for r in df.select(word_tokens(F.col("t"))).collect()] == [7, 0]


def test_own_tokenizer(spark):
    def load():
        from tokenizers import Tokenizer, models, pre_tokenizers

        tokenizer = Tokenizer(models.WordLevel({"[UNK]": 0, "a": 1}, unk_token="[UNK]"))
        tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
        return lambda text: len(tokenizer.encode(text).ids)

    df = spark.createDataFrame([("p ", "a a", "b"), ("p ", "a a a", "b")], "prompt string, chosen string, rejected string")
    kept = within_length(df, 4, count_tokens=tokenizer_counter(load))
    assert [r.chosen for r in kept.collect()] == ["a a"]


def test_token_length_by_bounds(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    from pairwright.operators.training_rows import Vocabulary, length_bound, within_token_length

    path = public_tokenizers.path("byte_bpe_50k.json")
    vocabulary, whole = Vocabulary(path), Tokenizer.from_file(path)
    assert vocabulary.longest == max(len(t) for t in whole.get_vocab())
    texts = ["", "word " * 30, "é" * 40, " " * 400, "=" * 700, "日本語" * 20, "x" * 63, "<|endoftext|>" * 9, "a b c " * 200]
    rows = [(p, c, r) for p in texts[:4] for c in texts for r in texts[2:]] + [(None, "a", "b"), ("a", None, "b"), ("a", "b", None)]
    df = spark.createDataFrame(rows, "prompt string, chosen string, rejected string").withColumn("bound", F.lit(1))
    size = lambda text: len(whole.encode(text, add_special_tokens=False).ids)
    for limit, overhead in [(64, 0), (64, 5), (10, 0), (1, 0)]:
        want = sorted(r for r in rows if None not in r and max(size(r[0] + r[1]), size(r[0] + r[2])) + overhead < limit)
        got = within_token_length(df.drop("bound"), vocabulary, limit, overhead)
        assert sorted(map(tuple, got.collect())) == want
        for r in df.withColumn("bound", length_bound(vocabulary, limit, overhead)).na.drop().collect():
            longest = max(size(r.prompt + r.chosen), size(r.prompt + r.rejected)) + overhead
            assert {"fits": longest < limit, "too_long": longest >= limit, "undecided": True}[r.bound]
    decided = {r.bound for r in df.na.drop().select(length_bound(vocabulary, 64).alias("bound")).collect()}
    assert decided == {"fits", "too_long", "undecided"} or decided == {"fits", "undecided"}


def test_vocabularies_without_bounds_count_every_row(spark):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from pairwright.operators.training_rows import Vocabulary, within_token_length

    vocabulary = Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    assert vocabulary.longest is None
    rows = spark.createDataFrame([("a " * 90, "b", "c"), ("a", "b", "c")], "prompt string, chosen string, rejected string")
    assert [r.prompt for r in within_token_length(rows, vocabulary, 20).collect()] == ["a"]


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_token_length_query_equals_counting_every_row(spark):
    pytest.importorskip("public_tokenizers")
    from pairwright.operators.training_rows import within_length
    from workloads import queries

    vocabulary = queries._vocabulary()
    every = within_length(queries._token_rows(spark, SF), 2048, vocabulary.counter())
    full = sorted(map(tuple, every.select(*queries.digest("prompt", "chosen", "rejected")).collect()))
    assert sorted(map(tuple, queries.training_rows_token_length(spark, SF).collect())) == full and full


def test_texts_of_more_words_than_the_budget_are_not_tokenized(spark, monkeypatch):
    import public_tokenizers
    import tokenizers
    from pairwright.operators import training_rows as train

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, seen = tokenizers.Tokenizer.from_file(path), []
    texts = ["a b " * 40, "\n\n \t x" * 30, "\x1c ! \x85  é" * 30, "word" * 60, "", "! " * 100, "a \n \n \n b" * 12]
    counts = [len(whole.encode(t, add_special_tokens=False).ids) for t in texts]
    monkeypatch.setattr(train, "tokenizer_counter", lambda load: seen.append(load()))
    train.Vocabulary(path).counter(enough=20)
    train.Vocabulary(path).counter()
    bounded, exact = seen
    assert [exact(t) for t in texts] == counts
    assert [min(bounded(t), 20) for t in texts] == [min(n, 20) for n in counts]
    assert all(bounded(t) <= n for t, n in zip(texts, counts))
    assert bounded(texts[0]) == 79  # starts behind white space, not tokens
