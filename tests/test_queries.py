"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
CHECKED = [
    "read_parquet_directory", "csv_round_trip", "conversation_instructions", "quality_rejects",
    "sampled_exact", "gathered_instructions", "planned_prompts", "judge_requests", "annotations",
    "critiques_by_prompt", "weighted_scores", "preference_pairs", "deadline_responses", "routed_responses",
    "resumed_responses", "deduplicated", "annotated_completions", "token_length_bounds", "published_preferences",
    "shard_stages",
]

needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in os.listdir(SF):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return connection


def test_every_query_has_its_sql():
    # tokens cannot be counted in SQL; test_training_rows.py counts every row instead
    assert set(contract.QUERIES) - set(contract.ORACLE) == {"training_rows_token_length"}
    assert set(contract.ORACLE) <= set(contract.QUERIES)
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(CHECKED) <= set(contract.queries())


def normal(value):
    return repr(value) if isinstance(value, float) else str(value)


@needs_tables
@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    columns = sorted(df.columns)
    mine = sorted(tuple(normal(row[c]) for c in columns) for row in df.collect())
    result = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    theirs = sorted(tuple(normal(row[i]) for i in order) for row in result.fetchall())
    assert mine == theirs and mine


@needs_tables
def test_entry(spark):
    assert contract.entry(spark).count() > 0
