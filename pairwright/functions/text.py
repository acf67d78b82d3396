"""Text expressions whose results agree with Python's Unicode rules.

Regex classes are written with ``\\x{..}`` escapes only, so one pattern means the
same thing in any engine that reads it.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import fixed


# How many of the widest ranges the first, cheap test of a class covers.
COMMON_RANGES = 6


def ranges_class(ranges) -> str:
    """Inside of a regex class for ``[(first, last), ...]`` code point ranges."""
    return "".join(
        f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges
    )


def merged_ranges(ranges, chars: str = "") -> list[tuple[int, int]]:
    """The same code points as few ranges, widest first.

    A regex class is tested range by range, so this is what its speed depends on.
    """
    merged: list[list[int]] = []
    for first, last in sorted([*ranges, *[(ord(c), ord(c)) for c in chars]]):
        if merged and first <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], last)
        else:
            merged.append([first, last])
    return sorted(((a, b) for a, b in merged), key=lambda r: r[0] - r[1])


ALLOWED_PUNCTUATION = fixed.ALLOWED_ASCII_PUNCTUATION + fixed.ALLOWED_CJK_PUNCTUATION


def _allowed_ranges(ranges, punctuation: str) -> list[tuple[int, int]]:
    digits = (ord("0"), ord("9"))
    return merged_ranges([*ranges, *fixed.WHITESPACE_RANGES, digits], punctuation)


def violation_pattern(
    ranges=fixed.ALLOWED_RANGES, punctuation: str = ALLOWED_PUNCTUATION
) -> str:
    """Pattern that finds one character outside the allow-list, for any engine."""
    return "[^" + ranges_class(_allowed_ranges(ranges, punctuation)) + "\\p{Nd}]"


def only_allowed(
    text: Column, ranges=fixed.ALLOWED_RANGES, punctuation: str = ALLOWED_PUNCTUATION
) -> Column:
    """True when every character is on the allow-list or is a decimal digit.

    Runs over the text once without giving anything back. The class is cut in two
    because Java tests its ranges nested: what texts consist of comes first.
    """
    known = _allowed_ranges(ranges, punctuation)
    common, rare = known[:COMMON_RANGES], known[COMMON_RANGES:]
    return text.rlike(
        f"\\A(?:[{ranges_class(common)}]++|[{ranges_class(rare)}\\p{{Nd}}])*+\\z"
    )


WHITESPACE = "".join(
    chr(c) for a, b in fixed.WHITESPACE_RANGES for c in range(a, b + 1)
)


def strip_text(text: Column) -> Column:
    """Strip Unicode whitespace from both ends, like ``str.strip()``.

    Spark's plain ``trim`` knows U+0020 only; the explicit set keeps this one
    linear pass without a regex.
    """
    return F.btrim(text, F.lit(WHITESPACE))


def script_share_above(text: Column, share: float, ranges=fixed.HAN_RANGES) -> Column:
    """True when more than ``share`` of the code points lie in ``ranges`` (strict)."""
    outside = F.length(F.regexp_replace(text, "[" + ranges_class(ranges) + "]++", ""))
    return F.length(text) - outside > F.length(text) * F.lit(float(share))


@cache
def _digit_table() -> tuple[str, str]:
    source = "".join(chr(zero + i) for zero in fixed.DIGIT_ZEROS for i in range(10))
    return source, "0123456789" * len(fixed.DIGIT_ZEROS)


def to_ascii_digits(text: Column) -> Column:
    """Map every Unicode decimal digit to 0-9, so that casts accept it."""
    source, target = _digit_table()
    return F.when(text.rlike("^[0-9]*$"), text).otherwise(F.translate(text, source, target))
