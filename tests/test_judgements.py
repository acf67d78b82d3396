import re

import pytest
from pyspark.sql import functions as F

from pairwright.config import fixed
from pairwright.operators.judgements import (
    explode_annotations,
    judge_ratings,
    judgement_rejects,
    parse_judgements,
)

GOOD = "#### Output\nRationale: fine\nRating: 4\n"
TYPED = "#### t\nRationale for type: why\nType: {t}\nRationale for rating: so\nRating: {r}\n"
SCHEMA = "prompt_id string, aspect string, response string"

PLAIN_CASES = [
    ("#### 1\nRationale： 好\nRating： 5\n", "5"),
    ("####\n**Rationale**: x **Rating**: 5", "5"),
    ("#### rationale: x rating: 2", "2"),
    ("#### Rationale: x Rating: 4/5", "4"),
    ("#### Rationale: x Rating: 3.5", "3"),
    ("#### Rationale: x Rating: N/A", "N/A"),
    ("#### Rationale: x Rating: 4 but later N/A\n", "N/A"),
    ("#### Rationale: the rating: bar of 2 things. Rating: 5", "2"),
    ("#### Rationale:Rating: 1 Rating: 3", "3"),
    ("#### Rationale: a Rationale: b Rating: 2", "2"),
    ("#### Ratıonale: dotless Rating: 3", "3"),
    ("#### Rationale: x Rating: ٣", "٣"),
]


def parsed_by_id(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    full = {r.prompt_id: r for r in parse_judgements(df).collect()}
    slim = {r.prompt_id: r for r in judge_ratings(df).collect()}
    for key, row in full.items():
        assert slim[key].parse_status == row.parse_status
        assert slim[key].ratings == (row.sections and [s.rating for s in row.sections])
    return full


def test_plain_ratings(spark):
    rows = [
        (str(i), "honesty", "intro, ignored " + text + GOOD * 3)
        for i, (text, _) in enumerate(PLAIN_CASES)
    ]
    found = parsed_by_id(spark, rows)
    for i, (text, rating) in enumerate(PLAIN_CASES):
        row = found[str(i)]
        assert row.parse_status == "ok", text
        assert [s.rating for s in row.sections] == [rating, "4", "4", "4"], text
        # the same section as one lazy pattern reads it
        section = rows[i][2].replace("：", ":").split("####")[1]
        hit = re.search(r"rationale\**:(.+?)rating\**:(.+)", section, re.S | re.I)
        assert row.sections[0].rationale == hit[1]


def test_one_bad_section_voids_the_call(spark):
    cases = {
        "no digits": ("#### Rationale: x Rating: good\n" + GOOD * 3, "unparsed_section"),
        "no labels": ("#### nothing here\n" + GOOD * 3, "unparsed_section"),
        "no gap": ("#### Rationale:Rating: 3\n" + GOOD * 3, "unparsed_section"),
        "no tail": (GOOD * 3 + "#### Rationale: x Rating:", "unparsed_section"),
        "three": (GOOD * 3, "section_count"),
        "five": (GOOD * 4 + "#### stray", "section_count"),
        "empty": ("", "empty_response"),
        "null": (None, "empty_response"),
    }
    found = parsed_by_id(spark, [(k, "honesty", text) for k, (text, _) in cases.items()])
    for key, (_, status) in cases.items():
        assert (found[key].parse_status, found[key].sections) == (status, None), key


def test_types(spark):
    cases = {"1, 3": ["1", "3"], "None": ["None"], "none": [], "1 and None": ["None"]}
    rows = [(t, "helpfulness", "".join(TYPED.format(t=t, r=3) for _ in range(4))) for t in cases]
    found = parsed_by_id(spark, rows)
    for given, types in cases.items():
        section = found[given].sections[2]
        assert section.types == types
        assert section.rationale_for_type == " why\n"
        assert section.rationale_for_rating == " so\n"
        assert section.rationale is None


def test_cuts_agree_with_one_lazy_pattern(spark):
    """All short sequences of labels and fillers, in any order."""
    from itertools import product

    words = ["Rationale for type:", "type**:", "Rationale for rating:", "Rating:", "7", "N/A"]
    texts = ["#### " + "".join(p) for n in (5, 6) for p in product(words, repeat=n) if p[0] == words[0]]
    df = spark.createDataFrame(
        [(str(i), "truthfulness", t + TYPED.format(t=1, r=2) * 3) for i, t in enumerate(texts)], SCHEMA
    )
    pattern = re.compile("(.+?)".join(label + r"\**:" for label in fixed.TYPED_LABELS) + "(.+)", re.S | re.I)
    got = {r.prompt_id: r.ratings for r in judge_ratings(df).collect()}
    fields = {r.prompt_id: r.sections for r in parse_judgements(df).collect()}
    for i, text in enumerate(texts):
        hit = pattern.search(text)
        tail = hit[4] if hit else ""
        digits = re.findall(r"\d+", tail)
        want = "N/A" if "N/A" in tail else digits[0] if digits else None
        assert (got[str(i)] and got[str(i)][0]) == want, text
        assert (fields[str(i)] is None) == (want is None), text
        if want is not None:
            first = fields[str(i)][0]
            types = ["None"] if "None" in hit[2] else re.findall(r"\d+", hit[2])
            assert (first.rationale_for_type, first.types, first.rationale_for_rating, first.rating) == (
                hit[1], types, hit[3], want), text


def test_counts_add_up_and_strict_raises(spark):
    rows = [("a", "honesty", GOOD * 4), ("b", "honesty", GOOD * 3), ("c", "truthfulness", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    parsed = parse_judgements(df)
    assert explode_annotations(parsed).count() == 4
    rejects = judgement_rejects(parsed).orderBy("prompt_id").collect()
    assert [(r.prompt_id, r.raw, r.reject_reason) for r in rejects] == [
        ("b", GOOD * 3, "section_count"), ("c", "x", "section_count"),
    ]
    with pytest.raises(Exception, match="judgement of"):
        parse_judgements(df, strict=True).collect()


def test_parsing_is_one_pass(spark):
    df = spark.range(10).select(
        F.col("id").cast("string").alias("prompt_id"), F.lit("honesty").alias("aspect"),
        F.concat(F.lit(GOOD * 4), F.col("id").cast("string")).alias("response"),
    )
    plan = judgement_rejects(parse_judgements(df))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert plan.count("split(replace") == 1


LETTERS = ["Rationale", "RATING", "rating", "Ratıng", "Type", "tYpe", "Rationale for type", "rationale for Rating", ":", ":", "：", "*", "**",
           "*" * 70, "x", " ", "\n", "5", "٣", "N/A", "None", "2, 3", "漢字", "a longer run of words between the labels and the colons "]


def test_labels_stand_where_lazy_patterns_find_them(spark):
    """Random sections, against one pattern a layout; colons, stars and labels in any order."""
    import random

    rng = random.Random(5)
    rows = []
    for i in range(4000):
        aspect = rng.choice(["honesty", "helpfulness"])
        labels = fixed.TYPED_LABELS if aspect == "helpfulness" else fixed.PLAIN_LABELS
        ordered = [x for label in labels for x in (*rng.choices(LETTERS, k=rng.randrange(3)), label, rng.choice(["", "*", "**:"]), ":")]
        text = "".join([*ordered, *rng.choices(LETTERS, k=rng.randrange(4))] if rng.random() < 0.7 else rng.choices(LETTERS, k=rng.randrange(25)))
        good = TYPED.format(t="1", r="4") if aspect == "helpfulness" else GOOD
        rows.append((str(i), aspect, "####" + text + good * 3))
    found = parsed_by_id(spark, rows)
    ok = 0
    for key, aspect, response in rows:
        labels = fixed.TYPED_LABELS if aspect == "helpfulness" else fixed.PLAIN_LABELS
        section = response.replace("：", ":").split("####")[1].replace("ı", "i")
        groups = "(.+?)".join(label + r"\**:" for label in labels)
        hit = re.search(groups + "(.+)", section, re.S | re.I)
        rating = hit and ("N/A" if "N/A" in hit[len(labels)] else (re.findall(r"\d+", hit[len(labels)]) or [""])[0])
        row = found[key]
        assert (row.parse_status == "ok") == bool(rating), section
        if rating:
            ok += 1
            first = row.sections[0]
            texts = [first.rationale_for_type, first.rationale_for_rating] if aspect == "helpfulness" else [first.rationale]
            assert [t.replace("ı", "i") for t in texts] == [hit[1], hit[len(labels) - 1]][: len(texts)], section
            assert first.rating == rating, section
    assert ok > 300


def test_no_pattern_runs_over_the_text_of_a_section(spark):
    """Labels are tested on the ends of pieces: the time of a long answer is that of cutting it."""
    df = spark.createDataFrame([("1", "honesty", ("#### " + "word ratin ratin " * 50 + "Rationale: x Rating: 4\n") * 4)], SCHEMA)
    for parsed in (judge_ratings(df), parse_judgements(df)):
        plan = parsed._jdf.queryExecution().analyzed().toString()
        assert ".*?" not in plan and ".+?" not in plan and "?<!" not in plan
    assert judge_ratings(df).first().ratings == ["4"] * 4
