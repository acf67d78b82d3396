import pytest
from pyspark.sql import functions as F

from pairwright.plans import (
    build_preferences,
    complete_and_judge,
    critique_completions,
    export_training_rows,
    gather_instructions,
    read_published,
    stage_table,
    write_counted,
    write_preferences,
)
from pairwright.sources import read_annotations, read_instruction_sources

PROMPTS = [(f"{i:032d}", f"问题{i}", "TrufulQA_zh" if i % 2 else "wizard_zh", "是", "否") for i in range(12)]


def make_answer():
    def answer(request):
        text = request["messages"][-1]["content"]
        stage, prompt, part = request["request_id"].split("/")
        if stage == "completion":
            return f"  {request['model']} says {part} "
        if stage == "critique":
            return f"fine\nOverall Score: {int(part) + 1}"
        if prompt.endswith("3") and part == "honesty":
            raise TimeoutError
        lines = []
        for i in range(4):
            rating = 5 if i == int(prompt) % 4 else 2
            assert f"says {i}" in text
            if part in ("truthfulness", "helpfulness"):
                lines.append(f"#### {i}\nRationale for type: a\nType: None\nRationale for rating: b\nRating: {rating}\n")
            else:
                lines.append(f"#### {i}\nRationale：a\nRating：{rating}\n")
        return "".join(lines)

    return answer


def test_prompts_to_training_rows(spark, tmp_path):
    prompts = spark.createDataFrame(
        PROMPTS, "prompt_id string, instruction string, source string, correct_answers string, incorrect_answers string"
    )
    root = str(tmp_path)
    done = complete_and_judge(prompts, make_answer(), root, threads=2)
    assert done["completions"].count() == 12
    assert done["rejects"].count() == 0 and done["failed_completions"].count() == 0
    lost = done["failed_judgements"].collect()
    assert [(r.request_id[-9:], r.attempts) for r in lost] == [("3/honesty", 1)]
    annotated = {r.prompt_id: r.completions for r in done["annotated"].collect()}
    assert [c.annotations.helpfulness.Rating for c in annotated[PROMPTS[1][0]]] == ["2", "5", "2", "2"]
    assert annotated[PROMPTS[3][0]][0].annotations.honesty is None

    responses = spark.read.parquet(f"{root}/judge_responses")
    assert responses.where("error is not null").count() == 1
    pairs = build_preferences(done["completions"], responses)
    rows = {r.prompt_id: r for r in pairs.collect()}
    assert set(rows) == {p[0] for p in PROMPTS} - {PROMPTS[3][0]}
    for prompt, row in rows.items():
        assert row.chosen_response.endswith(f"says {int(prompt) % 4}")
        assert row.chosen_rating.overall_score == 5.0 and row.rejected_rating.overall_score == 2.0

    training = export_training_rows(pairs, "llama3")
    assert training.columns == ["prompt", "chosen", "rejected"] and training.count() == 11
    assert export_training_rows(pairs, max_len=10).count() == 0
    assert write_counted(training, f"{root}/training") == 11

    # a second run with the same root asks for the failed call alone
    def late(request):
        if request["request_id"].split("/")[1:] != [PROMPTS[3][0], "honesty"]:
            raise AssertionError("asked again")
        return "no sections"

    again = complete_and_judge(prompts, late, root)
    assert [r.reject_reason for r in again["rejects"].collect()] == ["section_count"]
    assert again["failed_judgements"].count() == 0
    critiques = critique_completions(again["completions"], make_answer(), root)
    row = critiques["critiqued"].first()
    assert [c.score for c in row.critiques] == [1, 2, 3, 4] and critiques["rejects"].count() == 0
    assert row.completions[0].response.endswith("says 0") or row.completions[0].response.endswith("says 0 ")
    assert spark.read.json(f"{root}/critiqued").count() == 12


def test_stage_tables_keep_the_schema_and_cut_the_lineage(spark, tmp_path):
    df = spark.range(3).select(F.array("id").alias("a"))
    staged = stage_table(df, "x", str(tmp_path / "x"))
    assert sorted(r.a for r in staged.collect()) == [[0], [1], [2]]
    assert "Range" not in staged._jdf.queryExecution().optimizedPlan().toString()


def test_five_source_files_to_instructions(spark, tmp_path):
    import json

    import pandas as pd

    def text(tag, i):
        return f"{'汉' * 25}{tag}{'一二三四五六七八九十'[i]}"

    def lines(name, rows):
        (tmp_path / name).write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))
        return str(tmp_path / name)

    (tmp_path / "magpie").mkdir()
    for name, ids in {"b": [0, 1, 2, 3], "a": [4, 5]}.items():
        pd.DataFrame({
            "conversations": [[{"content": text("e", i), "role": "user"}, {"content": "x", "role": "a"}] for i in ids],
            "system_prompt_key": ["document-qa" if i < 4 else "translate" if i == 4 else None for i in ids],
            "score": [4.0 if i == 2 else 5.0 for i in ids],
        }).to_parquet(tmp_path / "magpie" / f"{name}.parquet")
    pd.DataFrame({"chosen": ["c"] * 2, "prompt": [text("b", 0), text("a", 1) + "\n"]}).to_parquet(tmp_path / "dpo.parquet")
    (tmp_path / "truth.csv").write_text(
        'Type,Question,Incorrect Answers,Correct Answers\nt,汉字,"坏,一",好\nt,"汉\n字",,好二\n'
    )
    paths = {
        "smoltalk_zh": str(tmp_path / "magpie"),
        "wizard_zh": lines("w.jsonl", [{"instruction": "en", "instruction_zh": text("a", i)} for i in range(3)]),
        "chinese-dpo": str(tmp_path / "dpo.parquet"),
        "TrufulQA_zh": str(tmp_path / "truth.csv"),
        "sharegpt_zh": lines("s.jsonl", [{"conversation": [{"human": text("d", 0), "assistant": "y"}]}, {"conversation": []}]),
    }
    with open(paths["wizard_zh"], "a") as file:
        file.write('\n{"instruction_zh": cut')
    sources, unread = read_instruction_sources(spark, paths)
    assert [tuple(r) for r in unread.collect()] == [("wizard_zh", '{"instruction_zh": cut', "corrupt_json")]
    with pytest.raises(ValueError, match="wizard_zh"):
        read_instruction_sources(spark, paths, strict=True)
    assert [tag for tag, _ in sources] == ["wizard_zh", "chinese-dpo", "TrufulQA_zh", "sharegpt_zh", "smoltalk_zh"]
    kept, rejects = gather_instructions(sources, dict.fromkeys(paths, 1.0))
    got = {r.instruction: (r.source, r.correct_answers, r.incorrect_answers) for r in kept.collect()}
    want = {text("a", i): ("wizard_zh", None, None) for i in range(3)}
    want[text("b", 0)] = ("chinese-dpo", None, None)
    want["汉字"] = ("TrufulQA_zh", "好", "坏,一")
    want["汉\n字"] = ("TrufulQA_zh", "好二", None)
    want[text("d", 0)] = ("sharegpt_zh", None, None)
    # descending file names: b is rows 0-3, a is 4-5; odd document-qa rows and low scores go
    want[text("e", 0)] = ("smoltalk_zh", None, None)
    want[text("e", 5)] = ("smoltalk_zh", None, None)
    assert got == want
    assert [r.reject_reason for r in rejects.collect()] == ["null_text"]


def test_annotation_files_to_preference_files(spark, tmp_path):
    import json

    def entry(aspect, rating):
        if aspect in ("truthfulness", "helpfulness"):
            return {"Rating": rating, "Type": "None", "Rationale for type": "t", "Rationale for rating": "r"}
        return {"Rating": rating, "Rationale": "因为"}

    def row(name, ratings, response="答"):
        done = [
            {"model": f"m{i}", "principle": "honesty", "custom_system_prompt": "s", "response": response and f" {response}{i} ",
             "annotations": {a: entry(a, r) if r else "" for a in ("instruction_following", "honesty", "truthfulness", "helpfulness")}}
            for i, r in enumerate(ratings)
        ]
        return json.dumps({"instruction": name, "source": "wizard_zh", "models": [], "completions": done})

    for i in range(2):
        (tmp_path / f"annotations_{i}.jsonl").write_text("\n".join([
            row(f"pair{i}", "2522"), row(f"tie{i}", "3333"), row(f"void{i}", ["1", "", "2", "3"]), row(f"mute{i}", "1234", ""),
        ]))
    annotated, unread = read_annotations(spark, [str(tmp_path / f"annotations_{i}.jsonl") for i in range(2)])
    assert unread.count() == 0
    root = str(tmp_path / "out")
    assert [tuple(r) for r in write_preferences(annotated, root).collect()] == [("wizard_zh", 2)]
    pairs = read_published(spark, root, "annotations_binarized.jsonl").collect()
    assert {r.instruction for r in pairs} == {"pair0", "pair1"}
    assert all(r.chosen_response == "答1" and r.chosen_rating.overall_score == 5.0 for r in pairs)
    weighted = read_published(spark, root, "annotations_weighted_sum.parquet").collect()
    assert {r.instruction for r in weighted} == {"pair0", "pair1", "tie0", "tie1"}
    tie = next(r for r in weighted if r.instruction == "tie0").completions[2]
    assert tie.overall_score == 3.0 and tie.annotations.helpfulness["Type"] == ["None"]
