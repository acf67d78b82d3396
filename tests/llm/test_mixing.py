import math
import random

from pairwright.llm.mixing import mix_sources, source_targets

SCHEMA = "doc_id long, text string, source string"


def brute_targets(sizes):
    """Reshare by weight until no source is above twice its size."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        total = sum(weight[s] for s in free)
        above = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not above:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in above:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= above
    return target


def test_targets(spark):
    draw = random.Random(5)
    for n in (1, 2, 3, 7, 20):
        sizes = {f"s{i}": int(10 ** draw.uniform(0, 5)) for i in range(n)}
        sizes[None] = 17
        sizes["empty"] = 0
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in source_targets(df).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys() and all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in got)


def rows_of(seed, n):
    draw = random.Random(seed)
    rows = [(i, " ".join("w" * draw.randint(1, 3) for _ in range(draw.randint(0, 60))),
             draw.choice(["a", "a", "a", "a", "b", "é", None])) for i in range(n)]
    return rows + [(None, None, "a"), (3, "again\x0b here", "b"), (3, "again\x0b here", "b")]


def test_taken_words_come_near_the_targets(spark):
    rows = rows_of(1, 1500)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS key", "2 AS size", "3 AS epochs")
    got = mix_sources(df).collect()
    assert len(got) == len(rows)
    by_source = {}
    for r in got:
        assert r.taken in (r.size * t for t in (0, 1, 2)) and r.times * r.size == r.taken
        by_source.setdefault(r.source, []).append(r)
    for part in by_source.values():
        largest = max(r.size for r in part)
        assert sum(r.size for r in part) == part[0].source_size
        assert abs(sum(r.taken for r in part) - part[0].target) <= largest / 2 + 1e-9
        times = {r.times for r in part if r.size}
        assert max(times) - min(times) <= 1  # whole epochs first
    size = {(r.doc_id, r.source): r.size for r in got}
    assert size[(3, "b")] == 2 and size[(None, "a")] == 0


def test_reruns_agree_and_weights_count(spark):
    rows = [(i, "one two three", "a" if i % 10 else "b") for i in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    weights = spark.createDataFrame([(i, 8.0) for i in range(0, 3000, 2)] + [(2, 1.0)], "doc_id long, weight double")
    pick = lambda d: sorted((r.doc_id, r.taken) for r in mix_sources(d, weights).collect())
    first = pick(df)
    assert first == pick(df.repartition(7))
    taken = {i: t for i, t in first if i % 10}
    heavy = sum(taken[i] > 3 for i in taken if i % 2 == 0) / sum(i % 2 == 0 for i in taken)
    light = sum(taken[i] > 3 for i in taken if i % 2) / sum(i % 2 for i in taken)
    assert heavy > light


def test_empty_tables(spark):
    assert mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
    only = mix_sources(spark.createDataFrame([(1, None, None), (2, "", "a")], SCHEMA)).collect()
    assert [(r.size, r.taken, r.target) for r in only] == [(0, 0, 0.0)] * 2


def test_documents_without_words_are_not_taken_beyond_whole_epochs(spark):
    """At twice the source's size nothing is left over, also not for documents of size 0."""
    rows = [(i, "" if i % 2 else "a b c d", "small") for i in range(64)]
    rows += [(100 + i, "word " * 400, "large") for i in range(64)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = [r for r in mix_sources(df).collect() if r.target == 2 * r.source_size]
    assert got and {r.times for r in got} == {2}
