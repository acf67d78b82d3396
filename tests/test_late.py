"""Choosing rows by short keys before texts move."""

import re

import pytest
from pyspark.sql import functions as F

from pairwright.functions import packed, unpacked
from pairwright.operators.completions import assemble_completions, plan_prompts
from pairwright.operators.instructions import strip_and_dedup, strip_and_dedup_written
from pairwright.operators.judgements import parse_judgements, settled_judgements
from pairwright.operators.late import dedup_written, settled_calls
from pairwright.operators.requests import attach_responses
from pairwright.operators.scoring import attach_annotations
from pairwright.plans import stage_bucketed
from workloads import derive


def written(df, tmp_path, name):
    path = str(tmp_path / name)
    df.repartition(3).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def section(text, node):
    """Descriptions of all nodes of a kind in a formatted plan."""
    return re.findall(rf"^\(\d+\) {node}.*\n(?:.+\n)*", text, re.M)


ROWS = [
    ("  same text ", "x", 1, 5), ("same text", "y", 0, 9), ("　same text", "z", 0, 9), ("other", "x", 2, 1),
    ("same text", "w", 0, 3), ("", "e", 0, 1), (" ", "f", 0, 2), (None, "n", 0, 1), (None, "m", 1, 1), ("Other", "o", 0, 0),
] + [("hot " * 50, f"h{i}", i % 3, i) for i in range(300)]


@pytest.fixture
def table(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "instruction string, source string, source_rank int, position long")
    return written(df, tmp_path, "united")


def test_written_dedup_equals_the_plain_one(table):
    got = sorted(map(str, strip_and_dedup_written(table).where("instruction is not null").collect()))
    assert got == sorted(map(str, strip_and_dedup(table).where("instruction is not null").collect()))
    assert len(got) == 5 and strip_and_dedup_written(table).count() == 6


def test_rows_equal_in_order_stay_once(spark, tmp_path):
    rows = [("a", "s", 0, 1)] * 5 + [("a", "t", 0, 1)]
    df = spark.createDataFrame(rows, "instruction string, source string, source_rank int, position long")
    assert strip_and_dedup_written(written(df, tmp_path, "ties")).count() == 1


def test_colliding_digests_are_compared_in_full(table):
    weak = lambda text: F.length(text).cast("string")
    got = dedup_written(table.na.drop(), F.trim("instruction"), ["source_rank", "position"],
                        lambda odd: odd.dropDuplicates(["instruction"]), weak)
    texts = {r.instruction for r in got.collect()}
    assert {"other", "Other"} <= texts


def test_no_text_in_the_shuffle_that_chooses(table):
    text = plan(strip_and_dedup_written(table))
    first = min(section(text, "Exchange"), key=lambda s: int(re.match(r"\((\d+)\)", s)[1]))
    choosing = [s for s in section(text, "Exchange") if "_digest" in s]
    assert choosing and all("instruction" not in s for s in choosing), first
    aggregates = section(text, "SortAggregate") + section(text, "HashAggregate") + section(text, "ObjectHashAggregate")
    assert aggregates and all("instruction" not in s for s in aggregates)


def calls(spark, tmp_path):
    rows = [("p0", 0, "a"), ("p0", 0, ""), ("p0", 1, "b"), ("p0", 1, "b"), ("p0", 1, "c"), ("p1", 0, ""), ("p1", 0, ""), ("p1", 3, None)]
    rows += [("p2", 2, f"hot {i % 7}") for i in range(200)]
    df = spark.createDataFrame(rows, "prompt_id string, slot int, response string").withColumn("extra", F.lit(1))
    return rows, written(df, tmp_path, "calls")


def test_repeated_calls_are_settled_by_rule(spark, tmp_path):
    import hashlib

    rows, table = calls(spark, tmp_path)
    got = {(r.prompt_id, r.slot): r.response for r in settled_calls(table, ("prompt_id", "slot")).collect()}
    want = {}
    for prompt, slot, text in rows:
        rank = ((text or "") == "", hashlib.md5((text or "").encode()).hexdigest())
        if (prompt, slot) not in want or rank < want[prompt, slot][0]:
            want[prompt, slot] = rank, text
    assert got == {k: text for k, (_, text) in want.items()}
    assert settled_calls(table, ("prompt_id", "slot")).count() == len(want)
    single = table.where("prompt_id = 'p9'")
    assert settled_calls(single, ("prompt_id", "slot")) is single


def test_assembling_settled_calls(spark, tmp_path):
    _, table = calls(spark, tmp_path)
    plan_of = F.array(*[F.struct(F.lit(f"m{i}").alias("model"), F.lit("p").alias("principle"), F.lit("s").alias("custom_system_prompt")) for i in range(4)])
    planned = spark.createDataFrame([(f"p{i}",) for i in range(4)], "prompt_id string").withColumn("plan", plan_of)
    once = settled_calls(table, ("prompt_id", "slot"))
    flat = lambda df: sorted((r.prompt_id, tuple(c.response for c in r.completions)) for r in df.collect())
    assembled = assemble_completions(planned, once, settled=True)
    assert flat(assembled) == flat(assemble_completions(planned, table))
    # answers are sorted once, behind their only shuffle
    text = plan(assemble_completions(planned, table.dropDuplicates(["prompt_id"]), settled=True))
    assert sum("response" in s for s in section(text, "Exchange")) <= 2


def test_attaching_settled_calls_has_no_aggregate_over_answers(spark, tmp_path):
    df = spark.createDataFrame([("r1", "a"), ("r2", "b"), ("r2", ""), ("r2", "b")], "request_id string, response string")
    table = written(df, tmp_path, "responses")
    requests = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "request_id string")
    joined = attach_responses(requests, settled_calls(table, ["request_id"]), settled=True)
    assert sorted(map(tuple, joined.collect())) == [("r1", "a"), ("r2", "b"), ("r3", "")]
    text = plan(joined)
    for s in section(text, "SortAggregate") + section(text, "HashAggregate"):
        assert "response" not in re.sub(r"Functions.*", "", s).split("Keys")[-1]


def test_settled_judgements_prefer_what_parses(spark, tmp_path):
    good = "".join(f"#### {i}\nRationale: r{i}\nRating: {i + 1}\n" for i in range(4))
    rows = [("p", "honesty", good), ("p", "honesty", "cut short"), ("p", "honesty", good[:20]), ("q", "honesty", "no"), ("q", "honesty", "none")]
    table = written(spark.createDataFrame(rows, "prompt_id string, aspect string, response string"), tmp_path, "judged")
    once = settled_judgements(table)
    assert sorted((r.prompt_id, r.response == good) for r in once.collect()) == [("p", True), ("q", False)]
    completions = spark.createDataFrame([("p",), ("q",)], "prompt_id string").withColumn(
        "completions", F.array(*[F.struct(F.lit(f"m{i}").alias("model")) for i in range(4)])
    )
    flat = lambda df: sorted((r.prompt_id, str(r.completions)) for r in df.collect())
    settled = attach_annotations(completions, parse_judgements(once), settled=True)
    assert flat(settled) == flat(attach_annotations(completions, parse_judgements(table)))


def test_settled_calls_move_texts_by_their_keys_only(spark, tmp_path, monkeypatch):
    """Texts are never dealt by the identity of their rows; hot keys, null keys and single calls come through."""
    from pairwright.operators import late

    monkeypatch.setattr(late, "LEAST_HOT", 3)
    rows = [("hot", t) for t in ("", "b", "a", "c", "a")] + [("two", ""), ("two", "x"), ("one", ""), (None, "n"), (None, "m")]
    spark.createDataFrame(rows, "request_id string, response string").write.parquet(str(tmp_path / "calls"))
    once = late.settled_calls(spark.read.parquet(str(tmp_path / "calls")), ["request_id"])
    digest = lambda t: __import__("hashlib").md5(t.encode()).hexdigest()
    best = min("abc", key=digest)
    got = sorted((str(r.request_id), r.response) for r in once.collect())
    assert got == sorted([("hot", best), ("two", "x"), ("one", ""), ("None", "m"), ("None", "n")])
    assert once.columns == ["request_id", "response"]
    assert "hashpartitioning(_file" not in once._jdf.queryExecution().executedPlan().toString()


def test_bucketed_completions_and_judge_texts_meet_without_a_shuffle(spark):
    good = "".join(f"#### {i}\nRationale: r{i}\nRating: {i + 1}\n" for i in range(4))
    rows = [(f"p{i}", a, good if i % 3 else "no") for i in range(40) for a in ("honesty", "instruction_following")]
    df = spark.createDataFrame(rows, "prompt_id string, aspect string, response string")
    completions = spark.createDataFrame([(f"p{i}",) for i in range(41)], "prompt_id string").withColumn(
        "completions", F.array(*[F.struct(F.lit(f"m{i}").alias("model")) for i in range(4)])
    )
    flat = lambda df: sorted((r.prompt_id, str(r.completions)) for r in df.collect())
    want = flat(attach_annotations(completions, parse_judgements(df)))
    left, right = (stage_bucketed(t.repartition(3, "prompt_id"), "t", "prompt_id", 3) for t in (completions, df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    attached = attach_annotations(left, parse_judgements(settled_judgements(right)), settled=True, dealt=True)
    assert flat(attached) == want
    assert "Exchange" not in plan(attached)
    # repeated calls are settled in a bucketed table too
    twice = stage_bucketed(df.unionByName(df.where("response <> 'no'").withColumn("response", F.lit("cut"))), "t", "prompt_id", 3)
    once = parse_judgements(settled_judgements(twice))
    assert flat(attach_annotations(left, once, settled=True, dealt=True)) == want
    assert flat(attach_annotations(left, once, settled=True, partitions=3)) == want
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_packed_responses_are_assembled_as_their_texts(spark):
    texts = ["", "a", "é語 " * 5000, None]  # the third packs so well that it stays as it is
    df = spark.createDataFrame([(f"p{i}", s, t) for i in range(3) for s, t in enumerate(texts)], "prompt_id string, slot int, response string")
    plan_of = F.array(*[F.struct(F.lit(f"m{i}").alias("model"), F.lit("p").alias("principle"), F.lit("s").alias("custom_system_prompt")) for i in range(4)])
    planned = spark.createDataFrame([(f"p{i}",) for i in range(4)], "prompt_id string").withColumn("plan", plan_of)
    flat = lambda df: sorted((r.prompt_id, tuple(c.response for c in r.completions)) for r in df.collect())
    small = df.withColumn("response", packed(F.col("response")))
    assert small.agg(F.max(F.octet_length("response"))).first()[0] == 30004
    words = " ".join(f"{i * 7919 % 1000003} word" for i in range(2000))
    assert spark.range(1).select(F.octet_length(packed(F.lit(words)))).first()[0] < len(words) / 2
    assert [r.t for r in small.where("prompt_id = 'p1'").sort("slot").select(unpacked(F.col("response")).alias("t")).collect()] == texts
    assert flat(assemble_completions(planned, small, settled=True, partitions=2)) == flat(assemble_completions(planned, df))


def test_completions_of_odd_documents(spark, tmp_path):
    """Texts dealt without the shuffle by block give the same completions."""
    docs = [(i, f"first {i}\nlast {i}", f"src{i % 5}") for i in range(-9, 60) if i not in (6, 13)]
    docs += [(None, "no id", "src1"), (20, None, "src0"), (21, None, "src3"), (21, "again", "src3"), (30, "zz", "src4"), (30, "zz", "src4")]
    spark.createDataFrame([d for d in docs if d[0] != 20 or d[1] is None], "doc_id long, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    sf = str(tmp_path)
    old = assemble_completions(plan_prompts(derive.prompts(spark, sf)), derive.block_responses(spark, sf), settled=True)
    new = derive.completions(spark, sf, 3)
    assert new.schema.simpleString() == old.schema.simpleString()
    assert sorted(map(str, new.collect())) == sorted(map(str, old.collect()))
    assert sorted(map(str, derive.completions_table(spark, sf).collect())) == sorted(map(str, old.collect()))
