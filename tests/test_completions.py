from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairwright.config import fixed, texts
from pairwright.operators.completions import (
    assemble_completions,
    plan_completions,
    plan_prompts,
    plan_rejects,
)
from pairwright.operators.critiques import collect_critiques, critique_rejects, parse_critiques, plan_critiques
from pairwright.operators.judgements import plan_judgements
from pairwright.operators.requests import provider


def prompts_df(spark, n=3000):
    return spark.range(n).select(
        F.md5(F.col("id").cast("string")).alias("prompt_id"),
        F.concat(F.lit("do "), F.col("id")).alias("instruction"),
        F.element_at(F.array(*[F.lit(s) for s in fixed.SOURCES]), (F.col("id") % 5 + 1).cast("int")).alias("source"),
        F.lit(None).cast("string").alias("correct_answers"),
        F.lit(None).cast("string").alias("incorrect_answers"),
    )


def test_shares_of_the_draws(spark):
    rows = plan_prompts(prompts_df(spark)).collect()
    models = Counter(m for r in rows for m in r.models)
    assert set(models) == set(fixed.MODEL_POOL)
    assert all(len(set(r.models)) == 4 for r in rows)
    assert all(abs(n / len(rows) - 4 / 9) < 0.05 for n in models.values())
    first = Counter(r.models[0] for r in rows)
    assert all(abs(n / len(rows) - 1 / 9) < 0.03 for n in first.values())
    by_source = {s: Counter() for s in fixed.SOURCES}
    system = {name: Counter() for name in texts.PRINCIPLE_TEXTS}
    for r in rows:
        for p in r.plan:
            by_source[r.source][p.principle] += 1
            system[p.principle][p.custom_system_prompt] += 1
    for source, weights in fixed.PRINCIPLE_WEIGHTS.items():
        total = sum(weights.values())
        honesty = weights["honesty"] / total
        want = {k: v / total for k, v in weights.items()}
        want["honesty"] = honesty * 0.9
        want["verbalized_calibration"] = want.get("verbalized_calibration", 0) + honesty * 0.1
        n = sum(by_source[source].values())
        for principle, share in want.items():
            assert abs(by_source[source][principle] / n - share) < 0.04, (source, principle)
    assert [len(texts.PRINCIPLE_TEXTS[p]) for p in ("helpfulness", "honesty", "verbalized_calibration", "truthfulness")] == [11, 11, 1, 11]
    assert all(set(system[p]) == set(options) for p, options in texts.PRINCIPLE_TEXTS.items())


def test_plans_do_not_depend_on_partitions(spark):
    df = prompts_df(spark, 200)
    a = {r.prompt_id: r for r in plan_prompts(df.repartition(7)).collect()}
    b = {r.prompt_id: r for r in plan_prompts(df.coalesce(1)).collect()}
    c = {r.prompt_id: r for r in plan_prompts(df, seed=1).collect()}
    assert a == b and a != c


def test_unknown_source(spark):
    df = prompts_df(spark, 2).withColumn("source", F.lit("elsewhere"))
    planned = plan_prompts(df)
    assert plan_rejects(planned).count() == 2
    assert plan_completions(planned).count() == 0
    with pytest.raises(Exception, match="no principle weights for source elsewhere"):
        plan_prompts(df, strict=True).collect()


def test_request_settings(spark):
    rows = plan_completions(plan_prompts(prompts_df(spark, 300))).collect()
    assert len({r.request_id for r in rows}) == len(rows) == 1200
    for r in rows:
        assert [m.role for m in r.messages] == ["system", "user"]
        assert r.messages[0].content == r.custom_system_prompt
        assert (r.temperature, r.max_tokens, r.top_p, r.timeout_seconds) == (1.0, 1500, 0.9, 60)
        assert r.base_url is None
        assert r.provider == {"deepseek-chat": "deepseek", "gpt-4o-mini": "gpt-4o"}.get(r.model, "local")
    served = {m: c | {"base_url": f"https://models.example/{m}"} for m, c in fixed.MODEL_POOL.items()}
    for r in plan_completions(plan_prompts(prompts_df(spark, 50)), served).collect():
        assert r.base_url == (f"https://models.example/{r.model}" if r.provider == "local" else None)
    names = spark.createDataFrame([("gemini-2",), ("x-gpt-4o-deepseek",), ("own",)], "m string")
    assert [r[0] for r in names.select(provider(F.col("m"))).collect()] == ["gemini", "gpt-4o", "local"]


def test_assembly_keeps_order_and_fills_gaps(spark):
    planned = plan_prompts(prompts_df(spark, 3))
    ids = [r.prompt_id for r in planned.collect()]
    rows = [(ids[0], i, f"r{i}") for i in (3, 1, 0, 2)] + [(ids[1], 2, "only"), (ids[1], 0, None)]
    done = assemble_completions(planned, spark.createDataFrame(rows, "prompt_id string, slot int, response string"))
    got = {r.prompt_id: r for r in done.collect()}
    assert [c.response for c in got[ids[0]].completions] == ["r0", "r1", "r2", "r3"]
    assert [c.model for c in got[ids[0]].completions] == got[ids[0]].models
    assert [c.response for c in got[ids[1]].completions] == ["", "", "only", ""]
    assert [c.response for c in got[ids[2]].completions] == [""] * 4


def completed_df(spark):
    rows = [
        ("p", "use {text_1} please", "TrufulQA_zh", "yes", None, [("m", "honesty", f"s{i}", f"t{i}") for i in range(4)]),
        ("q", "plain", "wizard_zh", None, None, [("m", "honesty", None, f"u{i}") for i in range(4)]),
    ]
    return spark.createDataFrame(
        rows,
        "prompt_id string, instruction string, source string, correct_answers string, incorrect_answers string,"
        "completions array<struct<model:string,principle:string,custom_system_prompt:string,response:string>>",
    )


def test_judge_prompts(spark):
    rows = {(r.prompt_id, r.aspect): r for r in plan_judgements(completed_df(spark)).collect()}
    assert len(rows) == 8
    for (prompt, aspect), r in rows.items():
        system, user = (m.content for m in r.messages)
        assert system == texts.JUDGE_SYSTEM_PROMPT
        assert (r.model, r.temperature, r.max_tokens) == ("deepseek-chat", 0.0, 1000)
        answered = prompt == "p" and aspect == "truthfulness"
        template = (texts.ANSWERED_JUDGE_TEMPLATES if answered else texts.JUDGE_TEMPLATES)[aspect]
        letter, instruction = ("t", "use {text_1} please") if prompt == "p" else ("u", "plain")
        knowledge = f"{texts.CORRECT_LABEL}yes\n{texts.INCORRECT_LABEL}"
        assert user == template.format(
            instruction=instruction, world_knowledge=knowledge,
            **{f"text_{i + 1}": f"{letter}{i}" for i in range(4)},
        )
        assert template.split("####")[0] and template.count("####") == 4


def test_critique_prompts(spark):
    rows = {(r.prompt_id, r.slot): r for r in plan_critiques(completed_df(spark)).collect()}
    assert len(rows) == 8
    assert rows[("p", 2)].messages[1].content == texts.CRITIQUE_TEMPLATE.format(
        instruction="use {text_1} please\nNote: s2", completion="t2"
    )
    assert "plain\nNote: \n" in rows[("q", 0)].messages[1].content


def test_critique_parsing(spark):
    cases = {
        "english": ("　good \nOverall Score: 8/10", "ok", "good", 8),
        "chinese": ("不错\n总体评分: 7", "ok", "不错", 7),
        "wide": ("x Overall Score: ９", "ok", "x", 9),
        "twice": ("x Overall Score: 1 Overall Score: 2", "marker_count", None, None),
        "both": ("x 总体评分: 1 Overall Score: 2", "marker_count", None, None),
        "none": ("x score 3", "marker_count", None, None),
        "no digits": ("x Overall Score: high", "no_score", None, None),
        "huge": ("x Overall Score: 99999999999", "no_score", None, None),
        "empty": ("", "empty_response", None, None),
    }
    rows = [(k, i % 4, text) for i, (k, (text, *_)) in enumerate(cases.items())]
    df = spark.createDataFrame(rows, "prompt_id string, slot int, response string")
    parsed = parse_critiques(df)
    got = {r.prompt_id: (r.parse_status, r.critique, r.score) for r in parsed.collect()}
    assert got == {k: tuple(v[1:]) for k, v in cases.items()}
    assert critique_rejects(parsed).count() == 6
    strict = {r.prompt_id: r.parse_status for r in parse_critiques(df, fixed.STRICT_CRITIQUE_MARKERS).collect()}
    assert strict["chinese"] == "marker_count" and strict["both"] == "ok"
    four = spark.createDataFrame(
        [("p", i, f"c{i} Overall Score: {i}" if i != 2 else "bad") for i in (2, 0, 3, 1)],
        "prompt_id string, slot int, response string",
    )
    row = collect_critiques(parse_critiques(four)).first()
    assert [c and tuple(c) for c in row.critiques] == [("c0", 0), ("c1", 1), None, ("c3", 3)]
