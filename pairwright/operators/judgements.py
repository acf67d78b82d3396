"""Judge requests and the parsing of their free-text answers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import fixed, texts
from ..functions import render, settle
from .late import settled_calls
from .requests import messages, request_id, with_call_settings

STAGE = "judge"

# Java flags: dot matches newline, any case, with Python's case rules for non-ASCII letters.
_FLAGS = "(?isu)"
_DIGITS = r"(\p{Nd}+)"


def world_knowledge(correct: Column, incorrect: Column) -> Column:
    """Two labelled lines from the reference answers."""
    return F.concat(
        F.lit(texts.CORRECT_LABEL), F.coalesce(correct, F.lit("")),
        F.lit("\n" + texts.INCORRECT_LABEL), F.coalesce(incorrect, F.lit("")),
    )


def judge_prompt(
    aspect: Column,
    templates: dict = texts.JUDGE_TEMPLATES,
    answered_templates: dict = texts.ANSWERED_JUDGE_TEMPLATES,
    answered_sources: Sequence[str] = tuple(fixed.ANSWERED_SOURCES),
    k: int = fixed.SLOTS,
) -> Column:
    """The judge prompt of a completions row for one aspect."""
    fields = {"instruction": F.col("instruction")}
    for i in range(k):
        fields[f"text_{i + 1}"] = F.get(F.col("completions")["response"], F.lit(i))
    fields["world_knowledge"] = world_knowledge(
        F.col("correct_answers"), F.col("incorrect_answers")
    )
    prompt = F.lit(None).cast("string")
    for name, template in templates.items():
        prompt = F.when(aspect == name, render(template, fields)).otherwise(prompt)
    for name, template in answered_templates.items():
        prompt = F.when(
            (aspect == name) & F.col("source").isin(*answered_sources), render(template, fields)
        ).otherwise(prompt)
    return prompt


def plan_judgements(
    completions: DataFrame,
    aspects: Sequence[str] = tuple(fixed.ASPECTS),
    model: str = fixed.JUDGE_MODEL,
    **prompt_options,
) -> DataFrame:
    """One judge request per (prompt, aspect), each showing all four responses."""
    rows = completions.withColumn("aspect", F.explode(F.array(*[F.lit(a) for a in aspects])))
    requests = rows.select(
        request_id(STAGE, "prompt_id", "aspect"),
        "prompt_id",
        "aspect",
        F.lit(model).alias("model"),
        messages(F.lit(texts.JUDGE_SYSTEM_PROMPT), judge_prompt(F.col("aspect"), **prompt_options)),
    )
    return with_call_settings(
        requests, fixed.MODEL_POOL, fixed.JUDGE_MAX_TOKENS, fixed.JUDGE_TEMPERATURE
    )


def judgement_sections(response: Column) -> Column:
    """Pieces of an answer cut at ``####``; the first is the text before any section."""
    return F.split(F.replace(response, F.lit("："), F.lit(":")), fixed.SECTION_MARK, -1)


def _rating(tail: Column) -> Column:
    """``N/A`` or the first digit run; ``''`` when there is neither."""
    return F.coalesce(
        F.when(tail.contains(fixed.NOT_APPLICABLE), fixed.NOT_APPLICABLE).otherwise(
            F.regexp_extract(tail, _DIGITS, 1)
        ),
        F.lit(""),
    )


def _types(text: Column) -> Column:
    return F.when(text.contains("None"), F.array(F.lit("None"))).otherwise(
        F.regexp_extract_all(text, F.lit(_DIGITS), 1)
    )


def _typed() -> Column:
    return F.col("aspect").isin(*fixed.TYPED_ASPECTS)


def _sectioned(responses: DataFrame, keep: list[str], k: int) -> DataFrame:
    """``keep`` with ``_empty`` and ``_sections``, null unless there are ``k``."""
    cut = responses.select(
        *keep,
        (F.coalesce(F.col("response"), F.lit("")) == "").alias("_empty"),
        judgement_sections(F.col("response")).alias("_pieces"),
    )
    fits = F.size("_pieces") == k + 1
    return cut.select(
        *keep, "_empty", F.when(fits, F.slice("_pieces", 2, k)).alias("_sections")
    )


def _status() -> Column:
    # One bad section voids the whole call.
    return (
        F.when(F.col("_empty"), "empty_response")
        .when(F.col("_ratings").isNull(), "section_count")
        .when(F.array_contains("_ratings", ""), "unparsed_section")
        .otherwise("ok")
    )


# A label is looked for in so many bytes before a colon.
_NEAR = 64
# Letters that are others in another case, beside the usual pair.
_FOLDED = {"i": "iIıİ", "k": "kK\u212a", "s": "sSſ"}


def _end(text: Column, label: str) -> Column:
    """The last bytes of ``text``, whole where many ``*`` leave no room for the label in them."""
    many = text.endswith("*" * (_NEAR - 4 - 2 * len(label)))
    last = F.substring(text.cast("binary"), -_NEAR, _NEAR).cast("string")
    return F.when(many, text).otherwise(last)


def _ends_with(text: Column, label: str, before: str = "") -> Column:
    """Whether ``text`` ends with a label and any number of ``*``; only its end is looked at."""
    last = label[-1].lower()
    may = text.endswith("*")
    for letter in _FOLDED.get(last, last + last.upper()):
        may = may | text.endswith(letter)
    return may & _end(text, label).rlike(rf"{_FLAGS}{before}{label}\**\z")


def _before(text: Column, label: str) -> Column:
    """``text`` without the label and the ``*`` at its end; cut by bytes, which need no counting."""
    width = F.octet_length(F.regexp_extract(_end(text, label), rf"{_FLAGS}({label}\**)\z", 1))
    return F.substring(text.cast("binary"), F.lit(1), F.octet_length(text) - width).cast("string")


def _places(pieces: Column, labels: list[str]) -> Column:
    """Places in ``pieces``, a section cut at its colons, that end with the labels.

    Each label is taken at the first colon it can stand before, behind the one before it
    and with a character between; that finds what a lazy pattern finds. Fewer places
    than labels where one is missing. The texts are long and colons are few, so no
    pattern runs over the texts.
    """
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("found"))

    def step(state: Column, piece: Column) -> Column:
        known = F.size(state["found"])
        hit = F.lit(False)
        for n, label in reversed(list(enumerate(labels))):
            here = _ends_with(piece, label)
            if n:
                adjacent = F.element_at(state["found"], -1) == state["at"]
                here = F.when(adjacent, _ends_with(piece, label, ".")).otherwise(here)
            hit = F.when(known == n, here).otherwise(hit)
        found = F.when(hit, F.concat(state["found"], F.array(state["at"] + 1))).otherwise(state["found"])
        return F.struct((state["at"] + 1).alias("at"), found.alias("found"))

    closed = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.aggregate(closed, start, step, lambda state: state["found"])


def _tail(pieces: Column, places: Column, labels: list[str]) -> Column:
    """Everything behind the last label, null where a label is missing."""
    rest = F.slice(pieces, F.get(places, F.lit(len(labels) - 1)) + 1, F.size(pieces))
    return F.when(F.size(places) == len(labels), F.array_join(rest, ":"))


def _parts(pieces: Column, places: Column, labels: list[str]) -> Column:
    """The texts between the labels, then everything behind the last one."""

    def between(n: int) -> Column:
        first, last = F.get(places, F.lit(n)), F.get(places, F.lit(n + 1))
        text = F.array_join(F.slice(pieces, first + 1, last - first), ":")
        return _before(text, labels[n + 1])

    texts_between = [between(n) for n in range(len(labels) - 1)]
    return F.when(F.size(places) == len(labels), F.array(*texts_between, _tail(pieces, places, labels)))


def _by_labels(take) -> Column:
    """``take(labels)`` with the labels of the row's aspect."""
    return F.when(_typed(), take(fixed.TYPED_LABELS)).otherwise(take(fixed.PLAIN_LABELS))


def _placed(responses: DataFrame, keep: list[str], k: int) -> DataFrame:
    """``keep`` and ``_empty`` with the pieces and label places of every section."""
    df = _sectioned(responses, keep, k).select(
        *keep, "_empty", F.transform("_sections", lambda text: F.split(text, ":", -1)).alias("_cut")
    )
    places = _by_labels(lambda labels: F.transform("_cut", lambda pieces: _places(pieces, labels)))
    return df.withColumn("_places", places)


def _fields(responses: DataFrame, k: int) -> DataFrame:
    """Cut every section at its labels.

    Column ``_parts`` holds per section the texts between the labels and the one behind
    them, null where a label is missing.
    """
    df = _placed(responses, responses.columns, k)
    parts = _by_labels(lambda labels: F.zip_with("_cut", "_places", lambda c, p: _parts(c, p, labels)))
    df = df.select(*responses.columns, "_empty", parts.alias("_parts"))
    return df.withColumn("_ratings", F.transform("_parts", lambda p: _rating(F.element_at(p, -1))))


def _checked(status: Column, strict: bool) -> Column:
    if not strict:
        return status
    message = F.concat(F.lit("judgement of "), F.col("prompt_id"), F.lit(": "), status)
    return F.when(status == "ok", status).otherwise(F.raise_error(message))


def parse_judgements(
    responses: DataFrame, k: int = fixed.SLOTS, strict: bool = False
) -> DataFrame:
    """Judge answers -> ``parse_status`` and ``sections``, one row per judge call.

    ``responses`` needs (prompt_id, aspect, response). ``sections`` holds one
    annotation per slot, or null when the call did not parse. No shuffle.
    """
    typed = _typed()

    def field(n: int, slot: int) -> Column:
        return F.get(F.get("_parts", F.lit(slot)), F.lit(n))

    def section(slot: int) -> Column:
        return F.struct(
            F.get("_ratings", F.lit(slot)).alias("rating"),
            F.when(~typed, field(0, slot)).alias("rationale"),
            F.when(typed, _types(field(1, slot))).alias("types"),
            F.when(typed, field(0, slot)).alias("rationale_for_type"),
            F.when(typed, field(2, slot)).alias("rationale_for_rating"),
        )

    sections = F.array(*[section(i) for i in range(k)])
    status = F.col("_status")
    return settle(
        _fields(responses, k).withColumn("_status", _status()),
        responses.columns,
        parse_status=_checked(status, strict),
        sections=F.when(status == "ok", sections),
    )


def settled_judgements(responses: DataFrame, k: int = fixed.SLOTS, dealt: bool = False) -> DataFrame:
    """One answer per prompt and aspect of a written table of judge answers.

    Of repeated calls one that parses comes first, then the smallest digest of the raw
    answer, as in ``gather_ratings``. Only repeated calls are parsed for it. A table ``dealt``
    to buckets by prompt stays where it lies.
    """

    def mark(rows: DataFrame) -> DataFrame:
        return parse_judgements(rows, k).withColumn("poor", F.col("sections").isNull())

    return settled_calls(responses, ("prompt_id", "aspect"), mark=mark, dealt=dealt)


def judge_ratings(responses: DataFrame, k: int = fixed.SLOTS) -> DataFrame:
    """(prompt_id, aspect, answer_md5, parse_status, ratings): what scoring needs, no rationale.

    The long text is dropped right behind its rating. What is shuffled afterwards is
    four short strings per call.
    """
    keys = ["prompt_id", "aspect", "answer_md5"]
    responses = responses.withColumn("answer_md5", F.md5(F.coalesce("response", F.lit(""))))
    tails = _by_labels(lambda labels: F.zip_with("_cut", "_places", lambda c, p: _tail(c, p, labels)))
    rated = _placed(responses, keys, k).select(
        *keys, "_empty", F.transform(tails, _rating).alias("_ratings")
    )
    status = F.col("_status")
    return settle(
        rated.withColumn("_status", _status()),
        keys,
        parse_status=status,
        ratings=F.when(status == "ok", F.col("_ratings")),
    )


def judgement_rejects(parsed: DataFrame) -> DataFrame:
    """Calls that did not parse, with their raw text."""
    return parsed.where(F.col("parse_status") != "ok").select(
        "prompt_id", "aspect", F.col("response").alias("raw"),
        F.col("parse_status").alias("reject_reason"),
    )


def explode_annotations(parsed: DataFrame) -> DataFrame:
    """Long form: one row per (prompt, aspect, slot) of the calls that parsed."""
    return parsed.where(F.col("parse_status") == "ok").select(
        "prompt_id", "aspect", F.posexplode("sections").alias("slot", "a")
    ).select("prompt_id", "aspect", "slot", "a.*")
