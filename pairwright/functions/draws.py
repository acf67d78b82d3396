"""Reproducible draws.

A draw is a function of (seed, keys) only. ``rand()`` and row ids depend on how
the rows happen to be partitioned, so a retried task could change the answer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 60
SPACE = 1 << BITS


def seeded_int(seed, *keys) -> Column:
    """Uniform BIGINT in [0, 2^60): leading 15 hex digits of md5(seed|key|...)."""
    parts = [F.lit(str(seed))]
    for key in keys:
        parts.append(key.cast("string") if isinstance(key, Column) else F.lit(str(key)))
    digest = F.md5(F.concat_ws("|", *parts))
    return F.conv(F.substring(digest, 1, BITS // 4), 16, 10).cast("bigint")


def seeded_share(draw: Column, share: float) -> Column:
    """True for a ``share`` of all draws."""
    return draw < F.lit(round(share * SPACE)).cast("bigint")


def pick(values: list[str], draw: Column) -> Column:
    """One of ``values``, by a draw."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (draw % len(values)).cast("int") + 1)


def draw_weighted(weights: dict[str, int], draw: Column) -> Column:
    """One key of ``weights`` with probability proportional to its integer weight."""
    return pick([name for name, n in weights.items() for _ in range(n)], draw)


def draw_k(pool: list[str], k: int, key: Column, seed) -> Column:
    """``k`` distinct members of ``pool`` in drawn order: the k smallest digests."""
    ranked = F.array_sort(
        F.array(*[
            F.struct(seeded_int(seed, key, name).alias("draw"), F.lit(name).alias("name"))
            for name in pool
        ])
    )
    return F.transform(F.slice(ranked, 1, k), lambda entry: entry["name"])
