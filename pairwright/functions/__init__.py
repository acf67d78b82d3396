from .text import (
    merged_ranges,
    only_allowed,
    ranges_class,
    script_share_above,
    strip_text,
    to_ascii_digits,
    violation_pattern,
)
from .packed import packed, unpacked
from .settle import settle
from .draws import draw_k, draw_weighted, pick, seeded_int, seeded_share
from .templates import render

__all__ = [
    "merged_ranges", "only_allowed", "violation_pattern", "ranges_class", "script_share_above",
    "strip_text", "to_ascii_digits", "draw_k", "draw_weighted", "pick", "seeded_int",
    "seeded_share", "render", "settle", "packed", "unpacked",
]
