import hashlib
import re

from pyspark.sql import functions as F

from pairwright.config import fixed
from pairwright.operators.conversations import first_turn, split_conversations
from pairwright.operators.instructions import (
    count_by_source,
    dedup_first,
    invalid_answered_instructions,
    quality_filter,
    source_filter,
    stratified_sample,
    strip_and_dedup,
    union_sources,
    with_prompt_id,
)
from pairwright.plans import gather_instructions

HAN20 = "汉" * 20


def test_source_rules(spark):
    rows = [
        (0, "document-qa", 5.0), (1, "document-qa", 5.0), (2, "translate", 9.0), (3, None, 5.0),
        (4, "general", 4.9), (5, "general", None), (6, "general", float("nan")), (7, "general", 5.0),
    ]
    df = spark.createDataFrame(rows, "row_seq long, system_prompt_key string, score double")
    assert sorted(r.row_seq for r in source_filter(df).collect()) == [0, 3, 7]


def test_quality_reasons(spark):
    cases = {
        "short": ("汉" * 19, "wizard_zh", "too_short"),
        "twenty": (HAN20, "wizard_zh", None),
        "short but exempt": ("汉" * 3, "TrufulQA_zh", None),
        "padded to length": ("汉" * 15 + " " * 5, "wizard_zh", None),
        "replacement": (HAN20 + "�", "wizard_zh", "replacement_char"),
        "half": ("汉" * 10 + "a" * 10, "wizard_zh", "script_share"),
        "over half": ("汉" * 11 + "a" * 10, "wizard_zh", None),
        "late han": ("龰" * 20, "wizard_zh", "script_share"),
        "exempt but latin": ("hello", "TrufulQA_zh", "script_share"),
        "exempt but invalid": ("汉汉;", "TrufulQA_zh", "invalid_char"),
        "null": (None, "wizard_zh", "null_text"),
    }
    for bad in ";=~\\":
        cases[bad] = (HAN20 + bad, "wizard_zh", "invalid_char")
    rows = [(k, t, s) for k, (t, s, _) in cases.items()]
    df = spark.createDataFrame(rows, "id string, instruction string, source string")
    kept, rejects = quality_filter(df)
    found = {r.id: r.reject_reason for r in rejects.collect()} | {r.id: None for r in kept.collect()}
    assert found == {k: reason for k, (_, _, reason) in cases.items()}
    assert [r.id for r in invalid_answered_instructions(df).collect()] == ["exempt but invalid"]


def test_union_and_first_wins(spark):
    a = spark.createDataFrame([("　x　", 5), ("y", 6)], "instruction string, position long")
    b = spark.createDataFrame(
        [("x", "yes", 0), (" y\n", "no", 1), ("z", "so", 2), ("z ", "later", 3)],
        "instruction string, correct_answers string, position long",
    )
    united = union_sources([("first", a), ("second", b)])
    got = {r.instruction: (r.source, r.correct_answers) for r in strip_and_dedup(united).collect()}
    assert got == {"x": ("first", None), "y": ("first", None), "z": ("second", "so")}
    assert united.select("incorrect_answers").distinct().collect()[0][0] is None


def test_dedup_of_a_hot_key_reduces_before_the_shuffle(spark):
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        (6000 - F.col("id")).alias("at"),
    ).repartition(8)
    out = dedup_first(df, "k", ["at"])
    assert out.count() == 4001
    assert out.where("k = 'hot'").first()["at"] == 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan


def brute_sample(rows, rates, seed):
    """The n smallest digests per source, n by half-even rounding."""
    kept = set()
    for source, rate in rates.items():
        mine = [k for k, s in rows if s == source]
        mine.sort(key=lambda k: (int(hashlib.md5(f"{seed}|{k}".encode()).hexdigest()[:15], 16), k))
        kept |= set(mine[: round(rate * len(mine))])
    return kept


def test_exact_sample_matches_brute_force(spark):
    rows = [(f"k{i}", "big" if i % 3 else "small") for i in range(1503)]
    rows += [("lonely", "one"), ("out", "unrated"), ("a1", "all"), ("a2", "all")]
    df = spark.createDataFrame(rows, "k string, source string")
    rates = {"big": 0.2, "small": 0.25, "one": 0.5, "all": 1.0, "absent": 0.3}
    want = brute_sample(rows, rates, 42)
    for bits in (1, 4, 16):
        got = stratified_sample(df, rates, "k", bucket_bits=bits)
        assert {r.k for r in got.collect()} == want
    spread = stratified_sample(df.repartition(11), rates, "k")
    assert {r.k for r in spread.collect()} == want
    assert {r.k for r in stratified_sample(df, {"all": 1}, "k").collect()} == {"a1", "a2"}
    fast = stratified_sample(df, rates, "k", mode="fast").groupBy("source").count().collect()
    counts = {r["source"]: r["count"] for r in fast}
    assert counts["all"] == 2 and abs(counts["big"] - 200) < 60


def test_sampling_ranks_only_the_cut_bucket(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit("s").alias("source"))
    plan = stratified_sample(df, {"s": 0.2}, "k")._jdf.queryExecution().executedPlan().toString()
    window = plan.index("row_number")
    assert "BroadcastHashJoin" in plan[window:]


def test_counts(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",)], "source string")
    assert [tuple(r) for r in count_by_source(df).collect()] == [("b", 2), ("a", 1)]


def test_conversations(spark):
    rows = [
        ("human", [("human", "hi"), ("gpt", "yo")]), ("system", [("system", "be"), ("human", "hi")]),
        ("bad", [("gpt", "yo")]), ("empty", []), ("null", None),
    ]
    df = spark.createDataFrame(rows, "id string, c array<struct<from:string,value:string>>")
    kept, rejects = split_conversations(df, "c")
    assert {r.id: r.instruction for r in kept.collect()} == {"human": "hi", "system": "be\n\nhi"}
    assert {r.id for r in rejects.collect()} == {"bad", "empty", "null"}
    first = {r.id: r.f for r in df.select("id", first_turn(F.col("c"), "value").alias("f")).collect()}
    assert first == {"human": "hi", "system": "be", "bad": "yo", "empty": None, "null": None}


def test_gather_end_to_end(spark):
    texts = [f"{HAN20}{'一二三四五六七八九十'[i % 10]}{'甲乙丙丁戊己庚辛壬癸'[i // 10]}" for i in range(100)]
    a = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "instruction string, position long")
    b = spark.createDataFrame([(t + "　", i) for i, t in enumerate(texts[:50])] + [("bad;" * 9, 99)],
                              "instruction string, position long")
    rates = {"wizard_zh": 0.25, "sharegpt_zh": 1.0}
    kept, rejects = gather_instructions([("wizard_zh", a), ("sharegpt_zh", b)], rates)
    rows = kept.collect()
    assert {r.source for r in rows} == {"wizard_zh"} and len(rows) == 25
    assert {r.prompt_id for r in rows} == brute_sample(
        [(hashlib.md5(t.encode()).hexdigest(), "wizard_zh") for t in texts], {"wizard_zh": 0.25}, 42
    )
    assert [r.reject_reason for r in rejects.collect()] == ["invalid_char"]
    again = with_prompt_id(kept.drop("prompt_id"))
    assert {r.prompt_id for r in again.collect()} == {r.prompt_id for r in rows}
    assert fixed.SAMPLE_RATES["TrufulQA_zh"] == 1.0
    assert re.fullmatch("[0-9a-f]{32}", rows[0].prompt_id)


def test_buckets_follow_the_number_of_rows():
    from pairwright.operators.instructions import bucket_bits_for

    assert [bucket_bits_for(n) for n in (0, 10**6, 1 << 32, 10**13)] == [16, 16, 21, 30]
