"""Single-pass template filling as a column expression."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_FIELD = re.compile(r"\{([a-z_0-9]+)\}")


def render(template: str, fields: dict[str, Column]) -> Column:
    """Fill ``{name}`` placeholders of ``template`` from ``fields``.

    The template is cut at its placeholders once, on the driver, so text coming
    from data is never scanned: a value that itself contains ``{name}`` stays
    literal. Null values become empty strings.
    """
    pieces, at = [], 0
    for hit in _FIELD.finditer(template):
        name = hit.group(1)
        if name not in fields:
            raise KeyError(f"template field {{{name}}} has no value")
        if hit.start() > at:
            pieces.append(F.lit(template[at:hit.start()]))
        pieces.append(F.coalesce(fields[name].cast("string"), F.lit("")))
        at = hit.end()
    if at < len(template):
        pieces.append(F.lit(template[at:]))
    return F.concat(*pieces) if pieces else F.lit("")
