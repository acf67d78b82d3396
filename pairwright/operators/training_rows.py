"""Training rows: chat formatting and the length budget."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import fixed
from ..functions import settle, strip_text


def _family(name: str) -> dict:
    if name not in fixed.CHAT_FAMILIES:
        raise ValueError(f"family must be one of {sorted(fixed.CHAT_FAMILIES)}, got {name!r}")
    return fixed.CHAT_FAMILIES[name]


def format_training_rows(pairs: DataFrame, family: str = "qwen") -> DataFrame:
    """(prompt, chosen, rejected) with the chat markers of ``family``.

    Takes ``prompt`` else ``instruction``, and ``chosen``/``rejected`` else the
    ``*_response`` columns; all other columns are dropped.
    """
    marks = _family(family)
    before, after = marks["prompt"]
    prompt = "prompt" if "prompt" in pairs.columns else "instruction"
    short = "chosen" in pairs.columns and "rejected" in pairs.columns
    chosen, rejected = ("chosen", "rejected") if short else ("chosen_response", "rejected_response")
    return pairs.select(
        F.concat(F.lit(before), strip_text(F.col(prompt)), F.lit(after)).alias("prompt"),
        F.concat(F.col(chosen), F.lit(marks["end"])).alias("chosen"),
        F.concat(F.col(rejected), F.lit(marks["end"])).alias("rejected"),
    )


def char_tokens(text: Column) -> Column:
    """Code points, one token each."""
    return F.length(text)


def word_tokens(text: Column) -> Column:
    """Runs of word characters, single other characters; Han counts one by one."""
    return F.regexp_count(
        text,
        F.lit(r"[\x{4e00}-\x{9fff}]|[a-zA-Z0-9_\x{c0}-\x{24f}]+|"
              r"[^\x{9}-\x{d}\x{20}a-zA-Z0-9_\x{c0}-\x{24f}\x{4e00}-\x{9fff}]"),
    )


def tokenizer_counter(load: Callable[[], Callable[[str], int]]) -> Callable[[Column], Column]:
    """Counter backed by a tokenizer: ``load()`` runs once per Python worker task."""

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        size = load()
        for batch in batches:
            yield batch.map(lambda text: 0 if text is None else size(text)).astype("int32")

    return count


class Vocabulary:
    """A tokenizer file, and what its tokens tell about lengths without running it.

    In a byte-level vocabulary without normalisation the tokens of a text spell its
    bytes, so their number lies between bytes / longest token and bytes. ``longest`` is
    None where that does not hold, and every row is then tokenized.
    """

    def __init__(self, path: str):
        self.path = path
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        before = spec.get("pre_tokenizer") or {}
        plain = (
            spec.get("normalizer") is None and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space")
        )
        names = [*spec["model"]["vocab"], *(t["content"] for t in spec.get("added_tokens", []))]
        # one letter stands for one byte; special tokens are written as they are
        self.longest = max(len(n.encode()) if n.isascii() else len(n) for n in names) if plain else None
        self.apart = plain and before.get("use_regex", True) and not any(
            c.isspace() for t in spec.get("added_tokens", []) for c in t["content"]
        )

    def counter(self, enough: int | None = None) -> Callable[[Column], Column]:
        """Tokens of a text. From ``enough`` on, any number that is at least that many tells as much.

        Tokens of such a vocabulary never reach over white space to what follows it, so
        there are no fewer of them than places where something follows white space.
        """
        path, apart = self.path, self.apart and enough is not None

        def load() -> Callable[[str], int]:
            import re

            from ..llm.tokens import encoder_of

            whole = encoder_of(path)
            starts = re.compile(r"[ \t\n][!-~]")

            def size(text: str) -> int:
                if apart and len(text) >= 2 * enough:
                    least = len(starts.findall(text))
                    if least >= enough:
                        return least
                return len(whole.encode(text))

            return size

        return tokenizer_counter(load)


def length_bound(vocabulary: Vocabulary, max_len: int = fixed.MAX_TRAINING_TOKENS, overhead: int = 0) -> Column:
    """What the byte lengths say about a formatted row: ``fits``, ``too_long`` or ``undecided``."""
    if vocabulary.longest is None:
        return F.lit("undecided")
    prompt = F.octet_length("prompt")
    longer = prompt + F.greatest(F.octet_length("chosen"), F.octet_length("rejected"))
    return (
        F.when(longer + overhead < max_len, "fits")
        .when(F.ceil(longer / vocabulary.longest) + overhead >= max_len, "too_long")
        .otherwise("undecided")
    )


def within_token_length(
    rows: DataFrame, vocabulary: Vocabulary, max_len: int = fixed.MAX_TRAINING_TOKENS, overhead: int = 0
) -> DataFrame:
    """``within_length`` by the tokens of a vocabulary.

    Rows whose bytes decide are neither sent to Python nor tokenized. Rows with a null
    side have no length and are left out.
    """
    tagged = settle(rows, rows.columns, bound=length_bound(vocabulary, max_len, overhead))
    count = vocabulary.counter(enough=max_len - overhead)
    asked = lambda answer: F.when(F.col("bound") == "undecided", F.concat("prompt", answer))
    long = lambda answer: count(asked(answer)) + overhead >= max_len
    whole = F.concat("prompt", "chosen", "rejected").isNotNull()
    kept = tagged.where(whole & (F.col("bound") != "too_long"))
    kept = kept.withColumn("over", long("chosen") | long("rejected"))
    return kept.where((F.col("bound") == "fits") | ~F.col("over")).select(*rows.columns)


def conversation_text(prompt: Column, answer: Column, family: str) -> Column:
    """User and assistant turns rendered around an already formatted row."""
    marks = _family(family)
    before, after = marks["prompt"]
    return F.concat(
        F.lit(before), prompt, F.lit(after), answer, F.lit(marks["answer_tail"])
    )


def within_length(
    rows: DataFrame,
    max_len: int = fixed.MAX_TRAINING_TOKENS,
    count_tokens: Callable[[Column], Column] = char_tokens,
    overhead: int = 0,
    double_wrap: bool = False,
    family: str = "qwen",
) -> DataFrame:
    """Keep rows where both conversations stay below ``max_len`` tokens.

    A formatted prompt is a whole conversation opening, so prompt + answer is
    counted as it stands. ``double_wrap`` renders the chat template around it once
    more before counting. ``overhead`` stands for tokens a tokenizer adds itself.
    """

    def size(answer: str) -> Column:
        if double_wrap:
            return count_tokens(conversation_text(F.col("prompt"), F.col(answer), family))
        return count_tokens(F.concat("prompt", answer))

    return rows.where(
        (size("chosen") + overhead < max_len) & (size("rejected") + overhead < max_len)
    )
