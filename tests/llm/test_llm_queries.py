"""The registered queries on the smallest tables, against SQL or plain Python."""

import os
import re

import pytest

import __spark_entry__ as contract
from pairwright.llm import queries, sql
from test_packing import PATH, check, Encoder
from test_simhash import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in os.listdir(SF):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return connection


def test_one_query_for_each_operator():
    numbers = sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(sql.ORACLE))
def test_query_equals_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    text = lambda v: repr(v) if isinstance(v, float) else str(v)
    mine = sorted(tuple(text(row[c]) for c in columns) for row in df.collect())
    result = duck.execute(sql.ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert mine == sorted(tuple(text(row[i]) for i in order) for row in result.fetchall()) and mine


def test_simhash_equals_all_pairs(spark, duck):
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    got = queries.op6_simhash(spark, SF).collect()
    assert sorted(map(tuple, got)) == sorted(brute(rows))


def test_packing_is_a_round_trip(spark, duck):
    rows = duck.execute("SELECT doc_id, text FROM documents").fetchall()
    assert check(rows, queries.op3_packing(spark, SF).collect(), 1024, Encoder(PATH)) <= 1


def test_held_out_languages_and_quality(spark, duck):
    langs = dict(duck.execute("SELECT doc_id, lang FROM documents").fetchall())
    found = queries.op8_langid(spark, SF).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == len(langs) and held
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    found = queries.op2_quality(spark, SF).collect()
    held = [(r.score, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert len(found) == len(langs) and sum(g > b for g in good for b in bad) >= 0.9 * len(good) * len(bad)


def test_main_text_is_the_article(spark, duck):
    import html

    pages = dict(duck.execute("SELECT page_id, html FROM pages").fetchall())
    for r in queries.op9_html_text(spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_chats_are_whole(spark, duck):
    turns = duck.execute("SELECT conv_id, turn FROM conversations").fetchall()
    got = queries.op7_chat(spark, SF).collect()
    assert sorted((r.conv_id, r.turn) for r in got) == sorted(turns)
