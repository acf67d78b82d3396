import itertools
import random

import pytest
from pyspark.sql import functions as F

from pairwright.config import fixed
from pairwright.operators.pairs import binarized, make_chat_pairs, make_pairs
from pairwright.operators.scoring import (
    attach_annotations,
    gather_ratings,
    gathered_from_annotated,
    incomplete_reasons,
    not_applicable_counts,
    scored_completions,
    weighted_score,
)
from pairwright.operators.judgements import explode_annotations, parse_judgements
from pairwright.sources import save_bucketed

ORDER = ["instruction_following", "truthfulness", "helpfulness", "honesty"]


def rating_rows(prompt, slots):
    """slots: four rating tuples in ORDER -> one row per aspect."""
    return [
        (prompt, aspect, "ok", [str(s[i]) for s in slots]) for i, aspect in enumerate(ORDER)
    ]


def ratings_df(spark, prompts):
    rows = [row for prompt, slots in prompts.items() for row in rating_rows(prompt, slots)]
    return spark.createDataFrame(
        rows, "prompt_id string, aspect string, parse_status string, ratings array<string>"
    )


def completions_df(spark, prompts, response=lambda p, i: f" {p}{i}　"):
    rows = [
        (p, f"do {p}", "wizard_zh", [(f"m{i}", "honesty", f"sys{i}", response(p, i)) for i in range(4)])
        for p in prompts
    ]
    return spark.createDataFrame(
        rows,
        "prompt_id string, instruction string, source string, completions array<struct<model:string,"
        "principle:string,custom_system_prompt:string,response:string>>",
    )


def test_score_rules(spark):
    five = (5, 5, 5, 5)
    prompts = {
        "top": [five] * 4,
        "honesty na": [(5, 5, 5, "N/A"), five, five, (1, 2, 3, 4)],
        "helpfulness na": [(5, 5, "N/A", 5), five, five, five],
        "both na": [(5, 5, 5, "N/A"), five, (5, "N/A", 5, 5), five],
        "wide digits": [("５", "٣", 1, 1), five, five, five],
        "huge": [("9" * 30, 1, 1, 1), five, five, five],
        "huge honesty ignored": [(1, 1, 1, "9" * 30), five, five, (5, 5, 5, "N/A")],
    }
    df = ratings_df(spark, prompts).unionByName(
        ratings_df(spark, {"partial": [five] * 4}).where("aspect <> 'honesty'")
    )
    got = {r.prompt_id: r for r in weighted_score(gather_ratings(df)).collect()}
    assert got["top"].scores == [5.0] * 4
    assert got["honesty na"].tenths == [40, 40, 40, 18] and got["honesty na"].optional_dropped
    assert got["helpfulness na"].score_status == "required_not_applicable"
    assert got["both na"].score_status == "required_not_applicable"
    assert got["wide digits"].tenths[0] == 10 + 6 + 4 + 2
    assert got["huge"].score_status == "rating_out_of_range"
    assert got["huge honesty ignored"].tenths == [8, 40, 40, 40]
    assert got["partial"].score_status == "missing_annotation" and got["partial"].scores is None


def test_a_parsed_call_wins_over_a_failed_repeat(spark):
    df = ratings_df(spark, {"p": [(1, 2, 3, 4)] * 4})
    failed = df.withColumn("parse_status", F.lit("section_count")).withColumn(
        "ratings", F.lit(None).cast("array<string>")
    )
    assert weighted_score(gather_ratings(failed.unionByName(df))).first().tenths == [26] * 4


def fold(rating):
    total = 0
    for value, weight in zip(rating, (0.2, 0.2, 0.4, 0.2)):
        total += value * weight
    return total


def test_all_rating_tuples_in_both_modes(spark):
    tuples = list(itertools.product(range(1, 6), repeat=4))
    prompts = {f"p{i}": [t] * 4 for i, t in enumerate(tuples)}
    gathered = gather_ratings(ratings_df(spark, prompts))
    exact = {r.prompt_id: r for r in weighted_score(gathered).collect()}
    compat = {r.prompt_id: r for r in weighted_score(gathered, mode="float_compat").collect()}
    for i, t in enumerate(tuples):
        tenths = 2 * t[0] + 2 * t[1] + 4 * t[2] + 2 * t[3]
        assert exact[f"p{i}"].tenths[0] == tenths
        assert exact[f"p{i}"].scores[0] == tenths / 10
        assert compat[f"p{i}"].scores[3] == fold(t)


def test_float_ties(spark):
    prompts = {"p": [(2, 1, 1, 1), (1, 1, 1, 2), (2, 1, 1, 1), (1, 1, 1, 2)]}
    gathered = gather_ratings(ratings_df(spark, prompts))
    completed = completions_df(spark, prompts)
    assert make_pairs(weighted_score(gathered), completed).count() == 0
    compat = weighted_score(gathered, mode="float_compat")
    assert fold((2, 1, 1, 1)) != fold((1, 1, 1, 2))
    assert make_pairs(compat, completed, score="scores").count() == 1


def test_pairs_against_brute_force(spark):
    rng = random.Random(5)
    prompts = {f"p{i}": [tuple(rng.randint(1, 3) for _ in range(4)) for _ in range(4)] for i in range(200)}
    scored = weighted_score(gather_ratings(ratings_df(spark, prompts)))
    pairs = {r.prompt_id: r for r in make_pairs(scored, completions_df(spark, prompts)).collect()}
    seen_rejected = set()
    for prompt, slots in prompts.items():
        totals = [2 * a + 2 * b + 4 * c + 2 * d for a, b, c, d in slots]
        if len(set(totals)) == 1:
            assert prompt not in pairs
            continue
        row = pairs[prompt]
        chosen = totals.index(max(totals))
        assert row.chosen_response == f"{prompt}{chosen}"
        rejected = int(row.rejected_response[-1])
        assert totals[rejected] < max(totals)
        assert row.chosen_rating.overall_score == max(totals) / 10
        assert row.rejected_rating.asDict() == {
            "overall_score": totals[rejected] / 10,
            **{a: str(slots[rejected][i]) for i, a in enumerate(ORDER)},
        }
        seen_rejected.add(rejected)
    assert seen_rejected == {0, 1, 2, 3}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    again = make_pairs(scored, completions_df(spark, prompts).repartition(3))
    assert {r.prompt_id: r for r in again.collect()} == pairs
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_responses_make_no_pair(spark):
    prompts = {"good": [(5, 5, 5, 5)] + [(1, 1, 1, 1)] * 3, "hole": [(5, 5, 5, 5)] + [(1, 1, 1, 1)] * 3}
    scored = weighted_score(gather_ratings(ratings_df(spark, prompts)))
    completed = completions_df(spark, prompts, lambda p, i: "" if p == "hole" and i == 2 else "ok")
    pairs = make_pairs(scored, completed)
    assert [r.prompt_id for r in pairs.collect()] == ["good"]
    assert binarized(pairs).columns == [
        "instruction", "source", "chosen_response", "rejected_response", "chosen_rating", "rejected_rating",
    ]
    assert [tuple(r) for r in incomplete_reasons(completed, scored).collect()] == [("hole", "empty_response")]


@pytest.mark.parametrize("role", ["assistant", "user"])
def test_chat_pairs_keep_text_and_role(spark, role):
    prompts = {"p": [(1, 1, 1, 1), (5, 5, 5, 5), (1, 1, 1, 1), (1, 1, 1, 1)]}
    scored = weighted_score(gather_ratings(ratings_df(spark, prompts)))
    row = make_chat_pairs(scored, completions_df(spark, prompts), response_role=role).first()
    assert [tuple(m) for m in row.chosen_response] == [("system", "sys1"), (role, " p1　")]


def judge_text(aspect, ratings):
    if aspect in fixed.TYPED_ASPECTS:
        return "".join(
            f"#### {i}\nRationale for type: t{i}\nType: 1\nRationale for rating: r{i}\nRating: {r}\n"
            for i, r in enumerate(ratings)
        )
    return "".join(f"#### {i}\nRationale: r{i}\nRating: {r}\n" for i, r in enumerate(ratings))


def test_nested_route_equals_narrow_route(spark):
    rng = random.Random(9)
    prompts = {f"p{i}": [tuple(rng.choice([1, 2, 3, 4, 5, 5, 5]) for _ in range(4)) for _ in range(4)]
               for i in range(40)}
    prompts["na"] = [(5, 5, 5, "N/A"), (1, 1, 1, 1), (2, 2, 2, 2), (3, 3, 3, 3)]
    rows = [(p, a, judge_text(a, [s[i] for s in slots]))
            for p, slots in prompts.items() for i, a in enumerate(ORDER)]
    rows.append(("lost", "honesty", ""))
    responses = spark.createDataFrame(rows, "prompt_id string, aspect string, response string")
    parsed = parse_judgements(responses)
    completed = completions_df(spark, [*prompts, "lost"])
    annotated = attach_annotations(completed, parsed)
    nested = weighted_score(gathered_from_annotated(annotated))
    narrow = weighted_score(gather_ratings(parsed.select(
        "prompt_id", "aspect", "parse_status", F.col("sections.rating").alias("ratings"))))
    a = {r.prompt_id: r for r in make_pairs(nested).collect()}
    b = {r.prompt_id: r for r in make_pairs(narrow, completed).collect()}
    assert a == b and len(a) > 30
    done = {r.prompt_id: r for r in scored_completions(nested).collect()}
    assert set(done) == set(prompts)
    entry = done["na"].completions[3]
    assert entry.overall_score == 2.4
    assert entry.annotations.helpfulness.asDict() == {
        "Rating": "3", "Type": ["1"], "Rationale for type": " t3\n", "Rationale for rating": " r3\n",
    }
    counts = {r.aspect: r.n_not_applicable for r in not_applicable_counts(explode_annotations(parsed)).collect()}
    assert counts == {"instruction_following": 0, "truthfulness": 0, "helpfulness": 0, "honesty": 1}


def test_bucketed_stages_join_without_a_shuffle(spark, tmp_path):
    prompts = {f"p{i}": [(5, 5, 5, 5)] + [(1, 1, 1, 1)] * 3 for i in range(20)}
    scored = weighted_score(gather_ratings(ratings_df(spark, prompts)))
    left = save_bucketed(scored, "scored_t", "prompt_id", 4, str(tmp_path / "s"))
    right = save_bucketed(completions_df(spark, prompts), "completions_t", "prompt_id", 4, str(tmp_path / "c"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    pairs = make_pairs(left, right)
    assert pairs.count() == 20
    assert "Exchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_calls_give_one_answer_everywhere(spark):
    """Ratings and annotations take the same one of several answers to a call."""
    from pairwright.operators.judgements import judge_ratings, parse_judgements
    from pairwright.operators.scoring import attach_annotations, gather_ratings, gathered_from_annotated

    def text(ratings):
        return "".join(f"#### a\nRationale: because {r}\nRating: {r}\n" for r in ratings)

    answers = [text([3, 5, 1, 1]), text([3, 2, 1, 1]), text([5, 5, 5, 5]), "unreadable"]
    rows = [("p", "honesty", a) for a in answers] + [("q", "honesty", a) for a in reversed(answers)]
    calls = spark.createDataFrame(rows, "prompt_id string, aspect string, response string")
    completions = spark.createDataFrame(
        [(p, [(str(i),) for i in range(4)]) for p in "pq"], "prompt_id string, completions array<struct<response string>>"
    )
    by_ratings = {r.prompt_id: r.ratings.honesty for r in gather_ratings(judge_ratings(calls)).collect()}
    annotated = gathered_from_annotated(attach_annotations(completions, parse_judgements(calls)))
    assert {r.prompt_id: r.ratings.honesty for r in annotated.collect()} == by_ratings
    assert by_ratings["p"] == by_ratings["q"]
