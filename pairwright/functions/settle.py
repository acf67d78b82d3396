"""Keep costly columns from being computed twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame, keep: Sequence[str], **results: Column) -> DataFrame:
    """Select ``keep`` and ``results`` such that later filters stay above them.

    Spark pushes a filter on a computed column below the computation, which then
    runs once for the filter and once for the output. It pushes nothing through a
    generator, here one that makes one row of every row.
    """
    named = [column.alias(name) for name, column in results.items()]
    return df.select(*keep, F.inline(F.array(F.struct(*named))))
