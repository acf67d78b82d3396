"""Sets of outputs that readers see whole or not at all.

Each set lies in a folder of its own below ``root``. When all its outputs are written,
one row is appended to the table of versions; that commit publishes the set. A run
that dies before leaves a folder nobody reads, with a log of what it had finished.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import write_jsonl, write_parquet

VERSIONS = "number long, version string, outputs array<string>"


FINISHED = "output string"


def _rows(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A table of rows that were appended one by one, if there is any."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _append(spark: SparkSession, path: str, schema: str, row: tuple) -> None:
    """One row in one file: it is there when its commit is, and not before."""
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(path)


def _newest(spark: SparkSession, root: str):
    rows = _rows(spark, f"{root}/versions", VERSIONS)
    return None if rows is None else rows.orderBy(F.desc("number"), F.desc("version")).first()


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version published last, or None."""
    newest = _newest(spark, root)
    return newest["version"] if newest else None


def publish(
    spark: SparkSession, root: str, outputs: dict[str, Callable[[], DataFrame]],
    version: str | None = None, after: Callable[[str], None] | None = None,
    compression: str = "none",
) -> str:
    """Write the outputs and publish them together; returns the version.

    Names end in ``.parquet`` or ``.jsonl``, which is their format. With a ``version``
    of its own a run can be repeated: outputs that an earlier try has committed stay as
    they are, and a version that is published already is not written again. One
    writer at a time is assumed. ``after`` is called when an output is written, and
    ``compression`` (``gzip``) packs the JSON lines.
    """
    newest = _newest(spark, root)
    published = _rows(spark, f"{root}/versions", VERSIONS)
    if version and newest and not published.where(F.col("version") == version).isEmpty():
        return version
    version = version or uuid.uuid4().hex
    log = f"{root}/{version}/finished"
    earlier = _rows(spark, log, FINISHED)
    # one row for each output
    finished = set() if earlier is None else {r["output"] for r in earlier.collect()}
    for name, make in outputs.items():
        if name not in finished:
            if name.endswith(".jsonl"):
                write_jsonl(make(), f"{root}/{version}/{name}", "overwrite", compression)
            else:
                write_parquet(make(), f"{root}/{version}/{name}", "overwrite")
            _append(spark, log, FINISHED, (name,))
        if after:
            after(name)
    _append(spark, f"{root}/versions", VERSIONS, (newest["number"] + 1 if newest else 1, version, list(outputs)))
    return version


def published_path(spark: SparkSession, root: str, name: str) -> str:
    newest = _newest(spark, root)
    if newest is None or name not in newest["outputs"]:
        raise FileNotFoundError(f"{root} has no published {name}")
    return f"{root}/{newest['version']}/{name}"


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """An output of the newest published set."""
    path = published_path(spark, root, name)
    return spark.read.json(path) if name.endswith(".jsonl") else spark.read.parquet(path)
