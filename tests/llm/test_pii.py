"""Personal data: fixed forms against plain patterns, the graph against plain loops."""

import hashlib
import os
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pairwright.llm import pii
from pairwright.llm.pii import KINDS, base_spans, personal_data, scan, score_graph, span_counts, spans_text

PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed([int(c) for c in digits])):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def plain_base(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            fits = [
                True, kind != 1 or all(int(p) <= 255 for p in m.group().split(".")),
                16 <= len(digits) <= 19 and luhn(digits), 8 <= len(digits) <= 15,
            ][kind]
            if fits:
                out.append((kind, *m.span()))
    return out


def random_text(rng):
    bits = ["@", ".", "+", "-", " ", "(", ")", "a", "b.c", "x@y.z", "1.2.3.4", "256", "0", "00", "4111 1111 1111 1111",
            "4111-1111-1111-1111", "4111111111111111", "+1 (555) 555-0000", "\n", "é", "@@", "9" * 8, ".5", "%", "_", "٣"]
    return "".join(rng.choice(bits) for _ in range(rng.randrange(1, 30)))


def test_fixed_forms_equal_plain_patterns():
    rng = random.Random(5)
    hits = 0
    for _ in range(20000):
        text = random_text(rng)
        assert base_spans(text) == plain_base(text), text
        hits += len(base_spans(text))
    assert hits > 5000


def test_long_runs_take_linear_time():
    for run in ("1" * 300_000, "a" * 300_000, "+1" + " " * 300_000, "1." * 150_000, "@" * 300_000, "a@" * 150_000, "(" * 300_000, "a:" * 150_000):
        pii.all_spans(run)


DOCS = (
    [f"please call me at +1 (555) 555-{1000 + i} today, thanks" for i in range(12)]
    + ["please call me at 555-0199 today", "my card 555-0199 was lost", "the year 5550000 is far"]
    + [f"server address: 10.0.0.{i} is up" for i in range(6)] + ["server address: 10.0.300.1 is up", "server address: fe80::1:2 is up"]
    + [f"mailto:user{i}@mail.example.com or write" for i in range(5)] + ["mailto:admin@localhost or write"]
    + [f"the {4000 + i} 555 1234 the of" for i in range(3)] + ["the of and the"] * 20
    + ["please call me at +1 (555) 555-1001 today, thanks"] * 30
    + ["", None, "no digits here", "+", "@", "x " * 3000 + "call me at 5550155 now"]
)


def plain_graph(texts, rounds):
    edges, seeds, degree = Counter(), set(), Counter()
    words_seen = Counter()
    for text in texts:
        base, loose = pii.all_spans(text or "")
        spans = sorted([((k,), s, e, True) for k, s, e in base] + [(*f, False) for f in loose], key=lambda f: f[1:])
        words, places = pii.words_around(text or "", [f[1:3] for f in spans])
        for n in (1, 2):
            words_seen.update(" ".join(words[i : i + n]) for i in range(len(words) - n + 1))
        for (kinds, s, e, seed), at in zip(spans, places):
            for side, near, n in [("before", words[max(0, at - n) : at], n) for n in (1, 2)] + [
                ("behind", words[at + 1 : at + 1 + n], n) for n in (1, 2)
            ]:
                if len(near) == n:
                    for k in kinds:
                        edges[(k, f"{side} {' '.join(near)}"), (k, text[s:e].lower())] += 1
                        if seed:
                            seeds.add((k, text[s:e].lower()))
    by_rule = defaultdict(dict)
    for (rule, value), n in edges.items():
        by_rule[rule][value] = n
    by_rule = {r: v for r, v in by_rule.items() if len(v) >= pii.LEAST_VALUES}
    score = {v: float(v in seeds) for values in by_rule.values() for v in values}
    for _ in range(rounds):
        good = {}
        for rule, values in by_rule.items():
            known = sum(n * score[v] for v, n in values.items())
            beside = sum(values.values())
            against = words_seen[rule[1].split(" ", 1)[1]] - beside + pii.UNDECIDED * (beside - known)
            confidence = known / (known + against + pii.PRIOR)
            if confidence >= pii.THRESHOLD and sum(score[v] >= pii.THRESHOLD for v in values) >= pii.LEAST_VALUES:
                good[rule] = confidence
        doubt = defaultdict(lambda: 1.0)
        for rule, confidence in good.items():
            for v in by_rule[rule]:
                doubt[v] *= 1 - confidence
        score = {v: 1.0 if v in seeds else 1 - doubt[v] for v in score}
    return good, score


def scanned(spark, docs):
    ddl = pii.SCANNED.format(kind="bigint")
    schema = spark.createDataFrame([], ddl).toArrow().schema
    return pii.stage(docs.select("doc_id", "text").mapInArrow(scan(schema), ddl), "test_scanned")


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i % 17 else None, t) for i, t in enumerate(DOCS)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit("taken"))


def test_graph_equals_plain_loops(spark, docs):
    rules, values = score_graph(scanned(spark, docs.repartition(3)), docs.select("text"))
    good, score = plain_graph(DOCS, pii.ROUNDS)
    got = {(r.kind, r.pattern): r.confidence for r in rules.collect()}
    assert got == pytest.approx(good) and good
    assert {(r.kind, r.value): r.score for r in values.collect()} == pytest.approx(score)


def test_finds_unseen_identifiers_beside_known_words(spark, docs):
    got = personal_data(docs.repartition(4)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i % 17 == 0, i if i % 17 else 0) for i in range(len(DOCS)))
    found = {}
    for r in got:
        if r.doc_id is not None:
            text = DOCS[r.doc_id] or ""
            assert [tuple(s) for s in r.base] == plain_base(text)
            assert set(r.base) <= set(r.spans) and list(r.spans) == sorted(r.spans)
            for s in set(r.spans) - set(r.base):
                found[text[s.start : s.end]] = KINDS[s.kind]
    assert found == {"555-0199": "phone", "10.0.300.1": "ip", "fe80::1:2": "ip", "admin@localhost": "email", "5550155": "phone"}


def test_digest_columns(spark, docs):
    out = personal_data(docs).select(
        "doc_id", *span_counts("base"), F.sha2(spans_text("base"), 256).alias("base_sha256"), spans_text("spans").alias("spans")
    )
    for r in out.where("doc_id is not null").collect():
        base = plain_base(DOCS[r.doc_id] or "")
        text = ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in base)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b[0] == k for b in base) for k in range(4)]
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert personal_data(empty).collect() == []
    nothing = spark.createDataFrame([(1, None), (1, ""), (None, "word")], "doc_id long, text string")
    assert [(r.base, r.spans) for r in personal_data(nothing).collect()] == [([], [])] * 3


SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="tables not present")
def test_query_on_whole_table(spark):
    from pairwright.llm.queries import op11_pii

    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good, score = plain_graph(list(rows.values()), pii.ROUNDS)
    got = op11_pii(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        text = rows[r.doc_id]
        base = [(KINDS[k], s, e) for k, s, e in plain_base(text)]
        more = [
            (KINDS[k], s, e) for kinds, s, e in pii.all_spans(text)[1]
            for k in [max(kinds, key=lambda k: (score.get((k, text[s:e].lower()), 0), -k))]
            if score.get((k, text[s:e].lower()), 0) >= pii.THRESHOLD
        ]
        order = sorted(base + more, key=lambda x: (KINDS.index(x[0]), x[1]))
        assert r.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in order)
