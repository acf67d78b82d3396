"""Request and response tables.

A request is one model call. Its id is ``stage/prompt_id/part``, so a response
table that holds only (request_id, response) can be regrouped by prompt without
joining the (long) requests back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import chain, islice

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import fixed
from ..sources.sinks import stage_path
from .calls import CallLimits, run_calls
from .late import join_dealt


def request_id(stage: str, prompt: str, part: str) -> Column:
    return F.concat_ws("/", F.lit(stage), F.col(prompt), F.col(part).cast("string")).alias(
        "request_id"
    )


def with_request_parts(responses: DataFrame, part: str, dtype: str = "string") -> DataFrame:
    """Recover ``prompt_id`` and ``part`` from ``request_id``.

    The stage ends at the first slash and the part begins behind the last one, so
    a prompt id may hold slashes itself.
    """
    whole = r"(?s)\A[^/]*/(.*)/([^/]*)\z"
    return responses.withColumn("prompt_id", F.regexp_extract("request_id", whole, 1)).withColumn(
        part, F.regexp_extract("request_id", whole, 2).cast(dtype)
    )


def messages(system: Column, user: Column) -> Column:
    """Chat messages: the system turn only where there is a system text."""

    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return (
        F.when(system.isNull(), F.array(turn("user", user)))
        .otherwise(F.array(turn("system", system), turn("user", user)))
        .alias("messages")
    )


def provider(model: Column) -> Column:
    """Where a model is served, by substring of its name; ``local`` otherwise."""
    route = F.lit("local")
    for part, name in reversed(fixed.PROVIDER_SUBSTRINGS):
        route = F.when(F.contains(model, F.lit(part)), name).otherwise(route)
    return route


def with_call_settings(
    requests: DataFrame, pool: dict, max_tokens: int, temperature: float | None = None
) -> DataFrame:
    """Add provider, base_url, temperature, max_tokens, top_p and timeout columns.

    ``pool`` maps models to their ``temperature`` and, where they are served
    locally, to the ``base_url``; null where the pool has none.
    """
    model = F.col("model")

    def setting(name: str, dtype: str) -> Column:
        value = F.lit(None).cast(dtype)
        for option, config in pool.items():
            if config.get(name) is not None:
                value = F.when(model == option, F.lit(config[name]).cast(dtype)).otherwise(value)
        return value

    route = provider(model)
    return requests.select(
        "*",
        route.alias("provider"),
        F.when(route == "local", setting("base_url", "string")).alias("base_url"),
        (F.lit(temperature).cast("double") if temperature is not None
         else setting("temperature", "double")).alias("temperature"),
        F.lit(max_tokens).alias("max_tokens"),
        F.lit(fixed.TOP_P).alias("top_p"),
        F.lit(fixed.TIMEOUT_SECONDS).alias("timeout_seconds"),
    )


def preferred(value: Column, text: Column, poor: Column) -> Column:
    """Aggregate: of repeated calls, ``value`` of the one that counts.

    A call that is not ``poor`` comes before one that is; among equals the
    smallest digest of its raw ``text`` decides, which favours no content. Every
    use of an answer goes by this rule, so all of them see the same one.
    """
    first = F.min(F.struct(poor.alias("poor"), F.md5(text).alias("digest"), value.alias("value")))
    return first["value"]


def by_slot(slot: str, value: Column, k: int, prefix: str, text: Column, poor: Column) -> list[Column]:
    """``k`` aggregates that spread ``value`` over slots; null where absent."""

    def one(i: int) -> Column:
        here = F.col(slot) == i
        kept = F.struct(poor.alias("poor"), F.md5(text).alias("digest"), value.alias("value"))
        return F.min(F.when(here, kept))["value"].alias(f"{prefix}_{i}")

    return [one(i) for i in range(k)]


def one_response_each(responses: DataFrame) -> DataFrame:
    """At most one response per request: a non-empty one if there is any."""
    text = F.coalesce("response", F.lit(""))
    return responses.groupBy("request_id").agg(preferred(text, text, text == "").alias("response"))


def attach_responses(
    requests: DataFrame, responses: DataFrame, settled: bool = False, within: str | None = None
) -> DataFrame:
    """Requests with their response; ``''`` where none came back.

    Select the request columns you need first: the join moves what it is given.
    ``settled`` responses (``settled_calls``) hold each call once and are not reduced
    again, so answers go through one join and no aggregate. ``within`` names a column of
    both that the request id decides, as ``prompt_id`` (``with_request_parts``): settled
    tables in as many buckets of it (``stage_bucketed``) meet without moving.
    """
    if within:
        if not settled:
            raise ValueError("within needs settled responses")
        keys = [within, "request_id"]
        met = join_dealt(requests, responses.select(*keys, "response"), keys, "left", hashed="rows")
    else:
        once = responses.select("request_id", "response") if settled else one_response_each(responses)
        met = requests.join(once, "request_id", "left")
    return met.withColumn("response", F.coalesce("response", F.lit("")))


def side_by_side(
    settled: DataFrame, key: str, part: str, values: dict, column: str,
    partitions: int | None = None, dealt: bool = False,
) -> DataFrame:
    """One row per ``key``: ``column`` of the settled calls, one column for each part.

    ``values`` maps names to values of ``part``. Each key has a few calls of its own and
    each of them once, so they are dealt by key first and sorted once; without the
    partial aggregate there is no sort of whole answers before the shuffle. ``partitions``
    sets how many they are dealt to. A ``dealt`` table lies in buckets of the key
    (``stage_bucketed``) and is not moved; one that does not is only slower.
    """
    rows = settled.select(key, part, column)
    if not dealt:
        rows = rows.repartition(*[n for n in (partitions, key) if n])
    return rows.groupBy(key).agg(*[
        F.max(F.when(F.col(part) == value, F.col(column))).alias(name) for name, value in values.items()
    ])


def answered(responses: DataFrame) -> DataFrame:
    """Rows of the calls that came back; one that raised has an ``error``."""
    return responses.where(F.col("error").isNull()) if "error" in responses.columns else responses


def failed(responses: DataFrame) -> DataFrame:
    """(request_id, error, attempts) of the requests that have only failed so far."""
    tries = responses.groupBy("request_id").agg(
        F.max("error").alias("error"), F.count(F.lit(1)).alias("attempts"),
        F.max(F.col("error").isNull()).alias("done"),
    )
    return tries.where("not done").drop("done")


def pending(requests: DataFrame, responses: DataFrame, failures_are_final: bool = False) -> DataFrame:
    """Requests without an answer yet: the work left after an interruption.

    A call that raised is asked again, unless failures are final. The join needs
    the ids only, so Spark puts it below the rendering of the requests.
    """
    done = responses if failures_are_final else answered(responses)
    return requests.join(done.select("request_id").distinct(), "request_id", "left_anti")


def infer(
    requests: DataFrame,
    answer: Callable[[dict], str],
    keep: Sequence[str] = ("request_id", "prompt_id"),
    partitions: int | None = None,
    threads: int = 1,
    render: Callable[[DataFrame], DataFrame] | None = None,
    **limits,
) -> DataFrame:
    """Call ``answer(request)`` for every request; a call that fails yields ``''``.

    ``answer`` gets one request as a dict and runs in the executors' Python workers,
    ``threads`` calls at a time per task, as calls mostly wait. Further ``limits``
    (``timeout``, ``attempts``, ``backoff``) go to ``CallLimits``: a call that is late or
    out of attempts has an ``error``, so a hanging model cannot hold a task. Only the
    ``keep`` columns travel on with ``response`` and ``error``, in the order in which
    calls end. Answers are costly and may differ on a second call, so write the result
    before using it. ``render`` makes requests of the given rows: pass the rows that
    requests are made of, and those are dealt to ``partitions`` by their prompt id, a long
    text once and not once a request.
    """
    if render:
        rows = requests.repartition(partitions, "prompt_id") if partitions else requests
        return infer(render(rows), answer, keep, None, threads, **limits)
    fields = [f for f in requests.schema.fields if f.name in keep]
    schema = T.StructType([
        *fields,
        T.StructField("response", T.StringType()),
        T.StructField("error", T.StringType()),
    ])
    names = [f.name for f in fields]
    settings = CallLimits(threads=threads, **limits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next(batches, None)
        if first is None:
            return
        kinds = [(n, first.schema.field(n).type) for n in names]
        layout = pa.schema([*kinds, ("response", pa.string()), ("error", pa.string())])
        asked = (row for batch in chain([first], batches) for row in batch.to_pylist())
        ended = run_calls(asked, answer, settings)
        while rows := [
            {n: r[n] for n in names} | {"response": text, "error": error}
            for r, text, error in islice(ended, ROWS_AT_ONCE)
        ]:
            yield pa.RecordBatch.from_pylist(rows, layout)

    if partitions:
        requests = requests.repartition(partitions, "request_id")
    return requests.mapInArrow(run, schema)


def infer_into(
    requests: DataFrame, answer: Callable[[dict], str], path: str, batches: int | None = None,
    failures_are_final: bool = False, render: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int | None = None, **options,
) -> DataFrame:
    """Answer the requests not yet answered in the table at ``path`` and append to it.

    The requests are written once, dealt to ``batches`` folders (16 unless the table
    at ``path`` has another number) by a digest of the prompt id, else the request id.
    Each batch is a job that reads its own folder of requests and of responses and
    commits its calls, so resuming a batch never reads another. Take so many that
    losing one share is cheap. A job that dies loses its own share only; call again
    to go on, and calls that raised are asked again too.

    ``render`` makes requests of the given rows batch by batch: pass the rows that
    requests are made of, and the long texts are not written once more. With
    ``files_per_batch`` they are dealt to so many files a batch in one shuffle; without
    it every task writes to each batch, which suits inputs of few partitions. Returns
    the answered calls; ``failed`` of the table lists those still failing.
    """
    batches = _batches(requests.sparkSession, path, batches)
    plan = _staged_plan(requests, batches, files_per_batch)
    _answer_batches(plan, answer, path, batches, failures_are_final, render, options)
    return answered(_table(requests.sparkSession, path).drop("batches", "batch"))


def infer_routed(
    requests: DataFrame, answer: Callable[[dict], str], path: str, quotas: dict[str, dict],
    batches: int | None = None, failures_are_final: bool = False, files_per_batch: int | None = None,
    **options,
) -> DataFrame:
    """``infer_into`` for each provider apart, all side by side.

    ``quotas`` maps a ``provider`` to its own options (partitions, threads, timeout,
    attempts, backoff) over the common ``options``. ``partitions`` bounds how many
    tasks a provider has at a time: a slow one holds those and no others. Providers
    without a quota share the lane ``other``. Each lane runs in the scheduler pool
    ``calls-<lane>``; with ``spark.scheduler.mode=FAIR`` the pools share the executors
    evenly. A lane that fails does not stop the others; its error is raised at the end.
    """
    spark = requests.sparkSession
    batches = _batches(spark, path, batches)
    lane = F.when(F.col("provider").isin(*quotas), F.col("provider")).otherwise("other")
    plan = _staged_plan(requests.withColumn("lane", lane), batches, files_per_batch, "lane")

    def work(name: str) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"calls-{name}")
        part = plan.where(F.col("lane") == name).drop("lane")
        own = {**options, **quotas.get(name, {})}
        _answer_batches(part, answer, f"{path}/lane={name}", batches, failures_are_final, None, own)

    lanes = [*quotas, "other"]
    with ThreadPoolExecutor(len(lanes)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(work), name) for name in lanes]
    for job in running:
        job.result()
    return answered(_table(spark, path).drop("lane", "batches", "batch"))


# Answers that leave a task at a time.
ROWS_AT_ONCE = 500
BATCHES = 16


def _batches(spark, path: str, wanted: int | None) -> int:
    """The number of batches of the table at ``path``, which cannot change."""
    known = _table(spark, path)
    written = known.agg(F.max("batches")).first()[0] if known is not None else None
    if written is not None and wanted not in (None, written):
        raise ValueError(f"{path} was written in {written} batches, not {wanted}")
    return written or wanted or BATCHES


def _staged_plan(requests: DataFrame, batches: int, files: int | None, *folders: str) -> DataFrame:
    """The requests, written once with a folder for each batch."""
    spark = requests.sparkSession
    key = "prompt_id" if "prompt_id" in requests.columns else "request_id"
    batch = F.pmod(F.xxhash64(key, F.lit("batch")), F.lit(batches)).cast("int")
    plan = requests.withColumn("batch", batch)
    if files:
        plan = plan.repartitionByRange(batches * files, "batch", F.pmod(F.xxhash64(key, F.lit("file")), F.lit(files)))
    target = stage_path(spark, "request_plan")
    plan.write.partitionBy(*folders, "batch").parquet(target)
    return spark.read.schema(plan.schema).parquet(target)


def _answer_batches(
    plan: DataFrame, answer, path: str, batches: int, failures_are_final: bool, render, options: dict
) -> None:
    spark = plan.sparkSession
    known = _table(spark, path)
    for batch in _open_batches(plan, known, batches, failures_are_final, render):
        part = plan.where(F.col("batch") == batch).drop("batch")
        todo = render(part) if render else part
        if known is not None:
            todo = pending(todo, known.where(F.col("batch") == batch), failures_are_final)
        infer(todo, answer, **options).write.mode("append").parquet(f"{path}/batches={batches}/batch={batch}")


def _open_batches(plan, known, batches: int, failures_are_final: bool, render) -> list[int]:
    """Batches with requests left to answer, by one join of ids."""
    if known is None:
        return list(range(batches))
    rows = plan
    if render:
        # rendering drops columns it does not know, so the batch goes with the prompt
        numbers = plan.select("prompt_id", "batch").distinct()
        rows = render(plan.drop("batch")).select("request_id", "prompt_id").join(numbers, "prompt_id")
    left = pending(rows.select("request_id", "batch"), known, failures_are_final)
    return sorted(r["batch"] for r in left.select("batch").distinct().collect())


def _table(spark, path: str) -> DataFrame | None:
    """The table at ``path``, if anything has been written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as failure:
        if failure.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
