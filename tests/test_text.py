import unicodedata

from pyspark.sql import functions as F

from pairwright.config import fixed
from pairwright.functions import (
    only_allowed,
    render,
    script_share_above,
    seeded_int,
    strip_text,
    to_ascii_digits,
    violation_pattern,
)

CODES = [c for c in range(1, 0x30000) if not 0xD800 <= c <= 0xDFFF]


def characters(spark):
    rows = [(c, chr(c)) for c in CODES]
    return spark.createDataFrame(rows, "code int, c string")


def test_every_character_agrees_with_python(spark):
    found = characters(spark).select(
        "code",
        strip_text(F.concat("c", F.lit("x"), "c")).alias("stripped"),
        only_allowed(F.col("c")).alias("allowed"),
        (~F.col("c").rlike(violation_pattern())).alias("no_violation"),
        script_share_above(F.col("c"), 0.5).alias("han"),
        to_ascii_digits(F.col("c")).alias("digit"),
    ).collect()
    listed = set(fixed.ALLOWED_ASCII_PUNCTUATION + fixed.ALLOWED_CJK_PUNCTUATION)
    younger = 0
    for row in found:
        c = chr(row.code)
        assert row.stripped == (c + "x" + c).strip(), hex(row.code)
        allowed = (
            c in listed or c.isspace() or unicodedata.category(c) == "Nd"
            or any(a <= row.code <= b for a, b in fixed.ALLOWED_RANGES)
        )
        assert row.allowed == row.no_violation
        if row.allowed != allowed:
            younger += 1  # digits of a younger Unicode than this JVM's
            assert unicodedata.category(c) == "Nd"
        assert row.han == (0x4E00 <= row.code <= 0x9FA5)
        if unicodedata.category(c) == "Nd":
            assert row.digit == str(int(c))
        else:
            assert row.digit == c
    assert younger <= 40


def test_printable_ascii_outside_the_list():
    listed = set(fixed.ALLOWED_ASCII_PUNCTUATION + fixed.ALLOWED_CJK_PUNCTUATION + " ")
    missing = [chr(c) for c in range(32, 127) if not chr(c).isalnum() and chr(c) not in listed]
    assert missing == [";", "=", "\\", "~"]


def test_long_texts_of_mixed_classes(spark):
    df = spark.range(1).select(F.repeat(F.lit("汉，~a。"), 200_000).alias("bad"), F.repeat(F.lit("汉，a。"), 200_000).alias("good"))
    row = df.select(only_allowed(F.col("good")).alias("good"), only_allowed(F.col("bad")).alias("bad")).first()
    assert (row.good, row.bad) == (True, False)


def test_half_han_is_not_more_than_half(spark):
    df = spark.createDataFrame([("汉汉ab",), ("汉汉汉ab",), ("龰龰龰汉",), ("",)], "t string")
    got = [r[0] for r in df.select(script_share_above(F.col("t"), 0.5)).collect()]
    assert got == [False, True, False, False]


def test_templates_are_filled_once(spark):
    df = spark.createDataFrame([("say {text_1} and {b}", "B", None)], "a string, b string, n string")
    out = df.select(render("<{a}|{b}|{n}>", {c: F.col(c) for c in "abn"})).first()[0]
    assert out == "<say {text_1} and {b}|B|>"


def test_draws_do_not_depend_on_partitions(spark):
    df = spark.range(1000)
    one = {r.id: r.d for r in df.coalesce(1).select("id", seeded_int(7, F.col("id")).alias("d")).collect()}
    many = {r.id: r.d for r in df.repartition(13).select("id", seeded_int(7, F.col("id")).alias("d")).collect()}
    assert one == many
    assert len(set(one.values())) == 1000
    assert all(0 <= d < 2**60 for d in one.values())
    assert abs(sum(d < 2**59 for d in one.values()) - 500) < 80
