import os

import pytest
from pyspark.sql import functions as F

from pairwright.operators.requests import (
    attach_responses,
    failed,
    infer,
    infer_into,
    messages,
    pending,
    with_request_parts,
)


def requests_df(spark, n=20):
    return spark.range(n, numPartitions=3).select(
        F.concat(F.lit("judge/p"), F.col("id"), F.lit("/honesty")).alias("request_id"),
        F.concat(F.lit("p"), F.col("id")).alias("prompt_id"),
        messages(F.when(F.col("id") % 2 == 0, "be brief"), F.concat(F.lit("say "), F.col("id"))),
        F.lit(0.0).alias("temperature"),
    )


@pytest.mark.parametrize("options", [{}, {"partitions": 5, "threads": 4}])
def test_infer_sees_whole_requests_and_survives_errors(spark, options):
    def answer(request):
        roles = [m["role"] for m in request["messages"]]
        text = request["messages"][-1]["content"]
        if text == "say 3":
            raise ValueError("boom")
        if text == "say 4":
            return None
        return f"{text} {'+'.join(roles)} {request['temperature']}"

    got = {r.prompt_id: r for r in infer(requests_df(spark), answer, **options).collect()}
    assert len(got) == 20
    assert got["p0"].response == "say 0 system+user 0.0" and got["p0"].error is None
    assert got["p1"].response == "say 1 user 0.0"
    assert got["p3"].response == "" and got["p3"].error == "ValueError: boom"
    assert got["p4"].response == ""


def test_finished_batches_survive_a_dying_worker(spark, tmp_path):
    path, log = str(tmp_path / "responses"), tmp_path / "asked"
    log.mkdir()
    df = requests_df(spark, 40)

    def deadly(request):
        (log / request["prompt_id"]).write_text("")
        if len(list(log.iterdir())) > 25:
            os._exit(1)
        return "first"

    with pytest.raises(Exception):
        infer_into(df, deadly, path, batches=8)
    kept = {r.request_id for r in spark.read.parquet(path).collect()}
    assert 0 < len(kept) < 40
    got = infer_into(df, lambda r: "second", path, batches=8).collect()
    assert len(got) == 40 and {r.request_id for r in got if r.response == "first"} == kept


def test_failed_calls_are_asked_again(spark, tmp_path):
    path = str(tmp_path / "responses")
    df = requests_df(spark, 12)

    def timeout(request):
        if request["prompt_id"] in ("p1", "p2"):
            raise TimeoutError("slow")
        return "first"

    assert infer_into(df, timeout, path, batches=2).count() == 10
    assert {r.request_id for r in failed(spark.read.parquet(path)).collect()} == {"judge/p1/honesty", "judge/p2/honesty"}
    assert infer_into(df, lambda r: "no", path, batches=2, failures_are_final=True).count() == 10
    again = infer_into(df, lambda r: "second", path, batches=2)
    assert {r["response"]: r["count"] for r in again.groupBy("response").count().collect()} == {"first": 10, "second": 2}
    assert failed(spark.read.parquet(path)).count() == 0


def test_ids_with_slashes(spark):
    ids = spark.createDataFrame([("judge/a/b/honesty",), ("judge/p/3",)], "request_id string")
    assert [(r.prompt_id, r.part) for r in with_request_parts(ids, "part").collect()] == [("a/b", "honesty"), ("p", "3")]


def test_attach_and_pending(spark):
    df = requests_df(spark, 4).select("request_id", "prompt_id")
    responses = spark.createDataFrame(
        [("judge/p0/honesty", "a"), ("judge/p1/honesty", ""), ("judge/p1/honesty", "b"),
         ("judge/p2/honesty", ""), ("judge/p9/honesty", "stranger")],
        "request_id string, response string",
    )
    got = {r.prompt_id: r.response for r in attach_responses(df, responses).collect()}
    assert got == {"p0": "a", "p1": "b", "p2": "", "p3": ""}
    assert [r.prompt_id for r in pending(df, responses).collect()] == ["p3"]
    parts = with_request_parts(responses, "aspect").first()
    assert (parts.prompt_id, parts.aspect) == ("p0", "honesty")
