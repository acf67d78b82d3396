"""Long texts stay where they lie: queries over judge texts move and stage them once."""

import glob
import re

import pytest
from pyspark.sql import functions as F

from pairwright.operators.late import settled_calls
from pairwright.operators.requests import attach_responses
from pairwright.plans import stage_bucketed
from pairwright.sources import stage_path
from workloads import queries


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Documents with a repeated id, of which one has no text."""
    root = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, f"Text {i}\nof some words, {'again ' * (i % 7)}", "en", f"src{i % 20}", 30) for i in range(60)]
    rows += [(7, "Another text of seven", "en", "src7", 21), (61, None, "en", "src1", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(f"{root}/documents.parquet")
    return root


@pytest.fixture
def no_broadcast(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.split("\n") if re.search(r"\bExchange\b", line)]


def calls(spark):
    rows = [(f"p{i % 9}", f"a{i % 3}", "" if i % 4 == 0 else f"text {i % 5}") for i in range(80)]
    rows += [("p1", None, "x"), ("p1", None, "y"), (None, "a1", "x"), (None, "a1", "y"), ("p100", "a1", "once")]
    return spark.createDataFrame(rows, "prompt_id string, aspect string, response string")


def test_repeated_calls_of_dealt_tables_are_settled_in_their_buckets(spark, no_broadcast):
    table = stage_bucketed(calls(spark).repartition(4, "prompt_id"), "dealt", "prompt_id", 4)
    keys = ["prompt_id", "aspect"]
    moved, kept = settled_calls(table, keys), settled_calls(table, keys, dealt=True)
    assert exchanges(moved) and not exchanges(kept)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(kept) == rows(moved) and kept.columns == table.columns


def test_responses_of_dealt_tables_meet_their_requests_in_their_buckets(spark, no_broadcast):
    rows = calls(spark).where("prompt_id is not null and aspect is not null").withColumn(
        "request_id", F.concat_ws("/", F.lit("judge"), "prompt_id", "aspect"))
    dealt = lambda df, name: stage_bucketed(df.repartition(4, "prompt_id"), name, "prompt_id", 4)
    requests = rows.select("request_id", "prompt_id").distinct()
    silent = spark.createDataFrame([("judge/p200/a1", "p200"), ("judge/p1/a9", "p1")], requests.schema)
    requests = dealt(requests.unionByName(silent).unionByName(silent), "requests")
    responses = dealt(rows.select("request_id", "prompt_id", "response"), "responses")
    once = settled_calls(responses, ["prompt_id", "request_id"], dealt=True)
    met = attach_responses(requests, once, settled=True, within="prompt_id")
    assert not exchanges(met)
    plain = attach_responses(requests, settled_calls(responses, ["request_id"]), settled=True)
    columns = ["request_id", "prompt_id", "response"]
    assert sorted(met.select(columns).collect()) == sorted(plain.select(columns).collect())
    with pytest.raises(ValueError):
        attach_responses(requests, responses, within="prompt_id")


@pytest.mark.parametrize("name", ["repeated_judgements", "attached_responses"])
def test_queries_over_judge_texts_move_none_of_them(spark, tables, no_broadcast, name):
    assert not exchanges(queries.QUERIES[name](spark, tables))


def test_annotated_texts_are_not_staged_before_they_are_published(spark, tables):
    stages = lambda name: set(glob.glob(stage_path(spark, "x").removeprefix("file:").rsplit("/", 1)[0] + f"/{name}-*"))
    before, published = stages("annotated"), stages("published")
    assert queries.published_preferences(spark, tables).count() > 0
    assert stages("annotated") == before and len(stages("published") - published) == 1


def test_both_annotation_shapes_are_written_in_one_pass(spark, tables):
    """Each bucket is read by one task, and so makes one file of lines at most."""
    from workloads import derive

    files = lambda: set(glob.glob(stage_path(spark, "x").removeprefix("file:").rsplit("/", 1)[0] + "/annotations-*/*.gz"))
    before = files()
    assert queries.annotation_file_shapes(spark, tables).count() == 62
    assert 0 < len(files() - before) <= derive.judge_buckets(spark, tables)
