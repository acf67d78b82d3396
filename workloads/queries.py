"""The registered queries: each runs one operator over whole tables.

Long texts are returned as md5 and length, nested values as joined strings, so
that results compare the same way in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairwright.config import fixed
from pairwright.functions import pick, seeded_int, seeded_share
from pairwright.operators import completions as comp
from pairwright.operators import conversations as conv
from pairwright.operators import critiques as crit
from pairwright.operators import instructions as ins
from pairwright.operators import judgements as judge
from pairwright.operators import late
from pairwright.operators import pairs as pairing
from pairwright.operators import requests as req
from pairwright.operators import scoring
from pairwright.operators import training_rows as train
from pairwright.plans import (
    PREFERENCE_OUTPUTS,
    build_preferences,
    carry_shards,
    current_version,
    export_training_rows,
    gather_instructions,
    read_published,
    stage_bucketed,
    stage_table,
    write_counted,
    write_preferences,
)
from pairwright.sources import (
    read_annotations,
    read_csv,
    read_instruction_sources,
    read_jsonl,
    read_parquet,
    read_parquet_dir,
    read_shards,
    split_corrupt,
    stage_path,
    write_jsonl,
    write_parquet,
    write_sharded,
)

from . import derive


def digest(*names: str) -> list[Column]:
    """md5 and length of long text columns."""
    out = []
    for name in names:
        short = name.split(".")[-1]
        out += [F.md5(name).alias(f"{short}_md5"), F.length(name).alias(f"{short}_len")]
    return out


def joined(column) -> Column:
    return F.array_join(column, ",")


# --- sources and sinks ------------------------------------------------------

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])
DOCUMENT_COLUMNS = ["doc_id", "lang", "source", "n_chars"]


def read_parquet_directory(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables that share a column, read as one sequence in descending name order."""
    schema = T.StructType([T.StructField("doc_id", T.LongType())])
    df = read_parquet_dir(spark, sf, schema, name_glob="{documents,labels}.parquet")
    return df.select("row_seq", "doc_id")


def parquet_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "parquet")
    write_parquet(derive.table(spark, sf, "documents"), path)
    return read_parquet(spark, path, DOCUMENT).select(*DOCUMENT_COLUMNS, *digest("text"))


def jsonl_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "jsonl")
    write_jsonl(derive.table(spark, sf, "documents"), path)
    good, _ = split_corrupt(read_jsonl(spark, path, DOCUMENT))
    return good.select(*DOCUMENT_COLUMNS, *digest("text"))


def stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of stages, counted while they are written."""
    sources = derive.instruction_sources(spark, sf)
    united = ins.union_sources(sources)
    tagged = stage_table(ins.quality_tagged(united, **derive.QUALITY), "tagged")
    kept, rejects = ins.split_tagged(tagged)
    stages = {"kept": kept, "rejects": rejects, "deduplicated": ins.strip_and_dedup(kept)}
    counts = [(name, write_counted(df, stage_path(spark, name))) for name, df in stages.items()]
    return spark.createDataFrame(counts, "stage string, n long")


def corrupt_line_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """JSON lines of which some were cut off: every line is a row or a reject."""
    path = stage_path(spark, "cut_lines")
    line = F.concat(F.lit('{"doc_id":'), F.col("doc_id").cast("string"), F.lit(',"n_chars":'),
                    F.col("n_chars").cast("string"), F.lit("}"))
    cut = seeded_share(seeded_int("cut", F.col("doc_id")), 0.1)
    lines = F.when(cut, F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    documents = derive.table(spark, sf, "documents").withColumn("value", line)
    documents.select(lines.alias("value")).write.text(path)
    rows, rejects = split_corrupt(read_jsonl(spark, path, T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("n_chars", T.LongType())])))
    nothing = F.lit(None).cast("string")
    return rows.select("doc_id", "n_chars", nothing.alias("raw"), nothing.alias("reject_reason")).unionByName(
        rejects.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_chars"),
                       "raw", "reject_reason")
    )


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "csv")
    (
        derive.table(spark, sf, "documents")
        .write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    )
    good, _ = split_corrupt(read_csv(spark, path, DOCUMENT))
    return good.select(*DOCUMENT_COLUMNS, *digest("text"))


def sharded_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = stage_path(spark, "shards")
    write_sharded(derive.table(spark, sf, "documents"), path, F.col("doc_id"), files_per_shard=2)
    back, _ = split_corrupt(read_shards(spark, path + "/shard={}", DOCUMENT))
    per_shard = F.when(F.col("shard").between(0, 9), 1).otherwise(0)
    return back.select(*DOCUMENT_COLUMNS, per_shard.alias("in_range"), *digest("text"))


def annotation_file_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Write annotated completions in all layouts, read them back, score them."""
    path = stage_path(spark, "annotations")
    completed, judged = derive.completed_and_judged(spark, sf)
    parsed = judge.parse_judgements(judge.settled_judgements(judged, dealt=True))
    annotated = scoring.attach_annotations(completed, parsed, settled=True, dealt=True)
    annotated = annotated.drop("doc_id")
    # by draw: one object or a list of one per aspect; "" for none; a lone None as a scalar
    listed = F.transform("completions", lambda c: c.withField(
        "annotations", F.struct(*[F.when(c["annotations"][a].isNotNull(), F.array(c["annotations"][a])).alias(a)
                                  for a in fixed.ASPECTS])))
    as_list = seeded_share(seeded_int("shape", F.col("prompt_id")), 0.5)

    def line(completions: Column) -> Column:
        fields = [completions.alias(c) if c == "completions" else F.col(c) for c in annotated.columns]
        return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})

    def lacks(aspect: str) -> Column:
        return F.exists("completions", lambda c: c["annotations"][aspect].isNull())

    # both shapes in one pass, so every answer is parsed once
    raw = F.when(as_list, line(listed)).otherwise(line(F.col("completions")))
    for aspect in fixed.ASPECTS:  # only lines that have a null are looked through: "" is not sought
        sought = F.when(lacks(aspect), f'"{aspect}":null').otherwise("")
        raw = F.replace(raw, sought, F.lit(f'"{aspect}":""'))
    value = F.replace(raw, F.lit('"Type":["None"]'), F.lit('"Type":"None"'))
    annotated.select(value.alias("value")).write.text(path, compression="gzip")
    back, _ = read_annotations(spark, path)
    back = back.withColumn("instruction_md5", F.md5("instruction"))
    gathered = scoring.gathered_from_annotated(back)
    scored = scoring.weighted_score(gathered)

    def first_type(completion: Column) -> Column:
        return F.get(completion["annotations"]["helpfulness"]["Type"], F.lit(0))

    return scored.select(
        "instruction_md5",
        "source",
        "score_status",
        joined("tenths").alias("tenths"),
        joined(F.transform("completions", first_type)).alias("first_types"),
    )


def five_source_files(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and benchmark written as the five source files, read and united."""
    root = stage_path(spark, "five_sources")
    docs = derive.table(spark, sf, "documents").withColumn("tag", derive.tag_of(F.col("source")))
    key = pick(["general", "coding", "translate"], seeded_int("key", F.col("doc_id")))

    def of(tag: str) -> DataFrame:
        return docs.where(F.col("tag") == tag)

    of("wizard_zh").select(F.col("text").alias("instruction_zh"), "lang").write.json(f"{root}/w")
    of("chinese-dpo").select(F.col("text").alias("prompt"), "lang").write.parquet(f"{root}/d")
    nothing = F.lit(None).cast("string")
    asked = of("TrufulQA_zh").select(F.col("text").alias("Question"), nothing.alias("Correct Answers"), "lang",
                                     nothing.alias("Incorrect Answers"))
    known = derive.table(spark, sf, "benchmark").select(
        F.col("text").alias("Question"), F.col("text").alias("Correct Answers"), nothing.alias("lang"),
        F.col("item_id").cast("string").alias("Incorrect Answers"))
    asked.unionByName(known).write.option("header", True).option("escape", '"').option("quoteAll", True).csv(f"{root}/t")
    of("sharegpt_zh").select(
        F.array(F.struct(F.col("text").alias("human"), F.col("lang").alias("assistant"))).alias("conversation")
    ).write.json(f"{root}/s")
    scored = of("smoltalk_zh").join(derive.table(spark, sf, "labels"), "doc_id", "left")
    scored.select(
        F.array(F.struct(F.col("text").alias("content"), F.lit("user").alias("role"))).alias("conversations"),
        key.alias("system_prompt_key"), (F.col("quality") + 4).cast("double").alias("score"),
    ).write.parquet(f"{root}/m")
    sources, _ = read_instruction_sources(spark, {
        "wizard_zh": f"{root}/w", "chinese-dpo": f"{root}/d", "TrufulQA_zh": f"{root}/t",
        "sharegpt_zh": f"{root}/s", "smoltalk_zh": f"{root}/m",
    })
    return ins.union_sources(sources).select(
        "source", *digest("instruction"), F.md5("correct_answers").alias("correct_md5"), "incorrect_answers"
    )


# --- conversations ----------------------------------------------------------

def conversation_first_turn(spark: SparkSession, sf: str) -> DataFrame:
    turns = derive.opening_turns(spark, sf)
    return turns.select(
        "conv_id",
        conv.first_turn(F.col("turns"), "role").alias("first_role"),
        F.md5(conv.first_turn(F.col("turns"), "text")).alias("first_md5"),
    )


def conversation_instructions(spark: SparkSession, sf: str) -> DataFrame:
    kept, _ = conv.split_conversations(
        derive.opening_turns(spark, sf), "turns", role="role", text="text", human="user"
    )
    return kept.select("conv_id", *digest("instruction"))


def conversation_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations that do not open with the assumed roles (here: assistant first)."""
    turns = derive.opening_turns(spark, sf)
    _, rejects = conv.split_conversations(
        turns, "turns", role="role", text="text", human="user", system="assistant"
    )
    return rejects.select("conv_id", "reject_reason")


# --- instructions -----------------------------------------------------------

def source_rules(spark: SparkSession, sf: str) -> DataFrame:
    return ins.source_filter(derive.tagged_documents(spark, sf)).select(
        "doc_id", "source", "score", "system_prompt_key", "row_seq"
    )


def united_sources(spark: SparkSession, sf: str) -> DataFrame:
    return ins.union_sources(derive.instruction_sources(spark, sf)).select(
        "source", "source_rank", "position",
        F.md5("instruction").alias("instruction_md5"),
        F.md5("correct_answers").alias("correct_md5"),
        F.md5("incorrect_answers").alias("incorrect_md5"),
    )


def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    return derive.tagged_documents(spark, sf)


def quality_kept(spark: SparkSession, sf: str) -> DataFrame:
    kept, _ = ins.quality_filter(_tagged(spark, sf), **derive.QUALITY)
    return kept.select("doc_id", "source", F.md5("instruction").alias("instruction_md5"))


def quality_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, rejects = ins.quality_filter(_tagged(spark, sf), **derive.QUALITY)
    return rejects.select("doc_id", "source", "reject_reason")


def quality_rejects_han(spark: SparkSession, sf: str) -> DataFrame:
    """The default rules, whose script is Han, on documents with letters mapped to Han.

    Every document has its reason or null; some letters become code points at the
    end of the Han block, which are allowed but no Han by the share rule.
    """
    letters, han = derive.HAN_LETTERS
    mapped = _tagged(spark, sf).withColumn("instruction", F.translate("instruction", letters, han))
    return ins.quality_tagged(mapped).select("doc_id", "source", "reject_reason", F.md5("instruction").alias("text_md5"))


def invalid_answered_instructions(spark: SparkSession, sf: str) -> DataFrame:
    return ins.invalid_answered_instructions(_tagged(spark, sf)).select("doc_id", "source")


def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    united = stage_table(ins.union_sources(derive.instruction_sources(spark, sf)), "united")
    return ins.strip_and_dedup_written(united).select(
        "source", "source_rank", "position",
        F.md5("instruction").alias("instruction_md5"),
        F.md5("correct_answers").alias("correct_md5"),
    )


def _unique(spark: SparkSession, sf: str) -> DataFrame:
    return ins.with_prompt_id(
        ins.strip_and_dedup(ins.union_sources(derive.instruction_sources(spark, sf)))
    )


def sampled_exact(spark: SparkSession, sf: str) -> DataFrame:
    prompts = stage_table(_unique(spark, sf), "unique")
    return ins.stratified_sample(prompts, derive.RATES, "prompt_id").select(
        "prompt_id", "source"
    )


def sampled_fast(spark: SparkSession, sf: str) -> DataFrame:
    return ins.stratified_sample(_unique(spark, sf), derive.RATES, "prompt_id", mode="fast").select(
        "prompt_id", "source"
    )


def trial_fraction(spark: SparkSession, sf: str) -> DataFrame:
    return ins.sample_fraction(derive.prompts(spark, sf), 0.1, "prompt_id").select(
        "prompt_id", "source"
    )


def source_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ins.count_by_source(_unique(spark, sf))


def gathered_instructions(spark: SparkSession, sf: str) -> DataFrame:
    kept, _ = gather_instructions(
        derive.instruction_sources(spark, sf), derive.RATES, quality=derive.QUALITY
    )
    return kept.select(
        "prompt_id", "source", F.length("instruction").alias("instruction_len"),
        F.md5("correct_answers").alias("correct_md5"),
    )


# --- completions ------------------------------------------------------------

def drawn_models(spark: SparkSession, sf: str) -> DataFrame:
    planned = comp.plan_prompts(derive.prompts(spark, sf))
    return planned.select("prompt_id", joined("models").alias("models"))


def planned_prompts(spark: SparkSession, sf: str) -> DataFrame:
    planned = comp.plan_prompts(derive.prompts(spark, sf))
    return planned.select("prompt_id", "source", F.posexplode("plan").alias("slot", "p")).select(
        "prompt_id", "source", "slot", "p.model", "p.principle",
        F.md5("p.custom_system_prompt").alias("system_md5"),
    )


def _by_language(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts whose tag is the document language: no weights known for it."""
    docs = derive.table(spark, sf, "documents")
    return docs.select(
        derive.prompt_id(F.col("doc_id")).alias("prompt_id"),
        F.when(F.col("lang") == "en", "wizard_zh").otherwise(F.col("lang")).alias("source"),
        F.col("text").alias("instruction"),
    )


def unknown_source_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return comp.plan_rejects(comp.plan_prompts(_by_language(spark, sf)))


def completion_requests(spark: SparkSession, sf: str) -> DataFrame:
    requests = comp.plan_completions(comp.plan_prompts(derive.prompts(spark, sf)))
    return requests.select(
        "request_id", "prompt_id", "slot", "model", "provider", "base_url", "temperature",
        "max_tokens", "top_p", "timeout_seconds",
        F.md5(F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")).alias(
            "messages_md5"
        ),
    )


def assembled_completions(spark: SparkSession, sf: str) -> DataFrame:
    """Responses are a written table, in which repeated calls are settled by key first."""
    responses = derive.as_table("completion responses", sf, derive.completion_responses(spark, sf))
    once = late.settled_calls(responses, ("prompt_id", "slot"))
    completed = comp.assemble_completions(comp.plan_prompts(derive.prompts(spark, sf)), once, settled=True)
    return completed.select(
        "prompt_id", "source",
        joined(F.transform("completions", lambda c: c["model"])).alias("models"),
        joined(F.transform("completions", lambda c: c["principle"])).alias("principles"),
        joined(F.transform("completions", lambda c: F.md5(c["response"]))).alias("responses_md5"),
    )


def _judge_requests(spark: SparkSession, sf: str) -> DataFrame:
    return judge.plan_judgements(derive.completions(spark, sf))


def _response_table(spark: SparkSession, sf: str, completed: DataFrame | None = None) -> DataFrame:
    """Judge responses keyed by request; failed calls have an error, some rows are repeated."""
    rows = derive.judged(spark, sf, completed)
    raised = F.when(F.col("response") == "", "TimeoutError")
    keyed = rows.select(
        req.request_id("judge", "prompt_id", "aspect"), "response", raised.alias("error")
    )
    repeated = seeded_share(seeded_int("repeat", F.col("request_id")), 0.25)
    rows = F.explode(F.array_repeat(F.lit(0), F.when(repeated, 2).otherwise(1)))  # beside each other
    return keyed.withColumn("row", rows).drop("row")


def attached_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Responses lie in the buckets of the prompts that their ids name, so no answer moves."""
    buckets = derive.judge_buckets(spark, sf)
    completed = derive.completions_table(spark, sf, buckets)
    requests = judge.plan_judgements(completed).select("request_id", "prompt_id", "aspect")
    responses = req.with_request_parts(_response_table(spark, sf, completed), "aspect").drop("aspect")
    responses = stage_bucketed(responses, "responses", "prompt_id", buckets)
    once = late.settled_calls(responses, ["prompt_id", "request_id"], dealt=True)
    return req.attach_responses(requests, once, settled=True, within="prompt_id").select(
        "request_id", "prompt_id", "aspect", *digest("response")
    )


def pending_requests(spark: SparkSession, sf: str) -> DataFrame:
    requests = _judge_requests(spark, sf).select("request_id", "prompt_id", "aspect")
    return req.pending(requests, _response_table(spark, sf))


def regrouped_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt and aspect recovered from request ids alone."""
    parts = req.with_request_parts(req.answered(_response_table(spark, sf)), "aspect")
    return parts.groupBy("prompt_id", "aspect").agg(F.count(F.lit(1)).alias("n"))


def inferred_responses(spark: SparkSession, sf: str) -> DataFrame:
    """A stand-in model that fails for one model family, else echoes a digest."""

    def echo(request: dict) -> str:
        import hashlib

        if request["model"].startswith("glm"):
            raise RuntimeError("no such model")
        return hashlib.md5(request["messages"][-1]["content"].encode()).hexdigest()

    planned = comp.plan_prompts(derive.prompts(spark, sf))
    return req.infer(
        planned, echo, keep=("request_id", "prompt_id", "slot"), partitions=8, threads=2, render=comp.plan_completions
    )


def resumed_responses(spark: SparkSession, sf: str) -> DataFrame:
    """A run whose calls fail by draw, then a second run over the same table."""
    planned = comp.plan_prompts(derive.prompts(spark, sf))
    path = stage_path(spark, "resumed")

    def echo(prefix: str, fails: bool):
        def answer(request: dict) -> str:
            import hashlib

            if fails and hashlib.md5(request["request_id"].encode()).hexdigest()[0] < "4":
                raise TimeoutError
            return prefix + hashlib.md5(request["messages"][-1]["content"].encode()).hexdigest()

        return answer

    options = {"batches": 4, "keep": ("request_id", "prompt_id", "slot"), "render": comp.plan_completions}
    req.infer_into(planned, echo("a", True), path, **options)
    return req.infer_into(planned, echo("b", False), path, **options).drop("error")


def deadline_responses(spark: SparkSession, sf: str) -> DataFrame:
    """A stand-in model of which some calls hang and some fail twice before they answer."""

    def model(request: dict) -> str:
        import hashlib
        import time

        draw = hashlib.md5(request["request_id"].encode()).hexdigest()
        if draw.startswith("00"):
            time.sleep(20)
        tries[draw] = tries.get(draw, 0) + 1
        if draw.startswith("1") and tries[draw] < 3:
            raise ConnectionError("try again")
        return f"{tries[draw]} {hashlib.md5(request['messages'][-1]['content'].encode()).hexdigest()}"

    tries: dict[str, int] = {}  # each task has its own
    requests = comp.plan_completions(comp.plan_prompts(derive.prompts(spark, sf)))
    return req.infer(
        requests, model, keep=("request_id", "prompt_id", "slot"), partitions=8, threads=16,
        timeout=0.5, attempts=3, backoff=0.02,
    )


def routed_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Three providers with quotas of their own, one of them slow, and the rest."""

    def model(request: dict) -> str:
        import hashlib
        import time

        if request["provider"] == "deepseek":
            time.sleep(0.02)
        return request["provider"] + " " + hashlib.md5(request["messages"][-1]["content"].encode()).hexdigest()

    requests = comp.plan_completions(comp.plan_prompts(derive.prompts(spark, sf)))
    quotas = {
        "deepseek": {"partitions": 1, "threads": 16}, "gpt-4o": {"partitions": 2, "threads": 4},
        "local": {"partitions": 4, "threads": 2},
    }
    keep = ("request_id", "prompt_id", "slot", "provider")
    return req.infer_routed(requests, model, stage_path(spark, "routed"), quotas, batches=2, keep=keep).drop("error")


# --- judging ----------------------------------------------------------------

def judge_requests(spark: SparkSession, sf: str) -> DataFrame:
    requests = _judge_requests(spark, sf)
    user = F.element_at("messages", -1)["content"]
    return requests.select(
        "request_id", "prompt_id", "aspect", "model", "provider", "temperature", "max_tokens",
        F.md5(user).alias("prompt_md5"), F.length(user).alias("prompt_len"),
        F.size("messages").alias("n_messages"),
    )


def _judged(spark: SparkSession, sf: str) -> DataFrame:
    return derive.judged(spark, sf)


def annotations(spark: SparkSession, sf: str) -> DataFrame:
    rows = judge.explode_annotations(judge.parse_judgements(_judged(spark, sf)))
    return rows.select(
        "prompt_id", "aspect", "slot", "rating", joined("types").alias("types"),
        F.md5("rationale").alias("rationale_md5"),
        F.md5("rationale_for_type").alias("type_rationale_md5"),
        F.md5("rationale_for_rating").alias("rating_rationale_md5"),
    )


def judgement_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return judge.judgement_rejects(judge.parse_judgements(_judged(spark, sf))).select(
        "prompt_id", "aspect", "reject_reason", *digest("raw")
    )


def judge_ratings(spark: SparkSession, sf: str) -> DataFrame:
    return judge.judge_ratings(_judged(spark, sf)).select(
        "prompt_id", "aspect", "parse_status", joined("ratings").alias("ratings")
    )


def not_applicable_counts(spark: SparkSession, sf: str) -> DataFrame:
    return scoring.not_applicable_counts(judge.judge_ratings(_judged(spark, sf)))


def critique_requests(spark: SparkSession, sf: str) -> DataFrame:
    requests = crit.plan_critiques(derive.completions(spark, sf))
    user = F.element_at("messages", -1)["content"]
    return requests.select(
        "request_id", "prompt_id", "slot", "model", "temperature", "max_tokens",
        F.md5(user).alias("prompt_md5"), F.length(user).alias("prompt_len"),
    )


def _critiqued(spark: SparkSession, sf: str, completed: DataFrame | None = None, **options) -> DataFrame:
    responses = derive.critiqued(spark, sf, completed)
    return crit.parse_critiques(responses, **options)


def critique_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _critiqued(spark, sf).select(
        "prompt_id", "slot", "parse_status", "score", *digest("critique")
    )


def critique_scores_strict(spark: SparkSession, sf: str) -> DataFrame:
    parsed = _critiqued(spark, sf, markers=fixed.STRICT_CRITIQUE_MARKERS)
    return parsed.select("prompt_id", "slot", "parse_status", "score")


def critique_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return crit.critique_rejects(_critiqued(spark, sf)).select(
        "prompt_id", "slot", "reject_reason", *digest("raw")
    )


def critiques_by_prompt(spark: SparkSession, sf: str) -> DataFrame:
    collected = crit.collect_critiques(_critiqued(spark, sf))
    return collected.select(
        "prompt_id",
        joined(F.transform("critiques", lambda c: F.coalesce(c["score"].cast("string"), F.lit("-")))).alias("scores"),
        joined(F.transform("critiques", lambda c: F.coalesce(F.md5(c["critique"]), F.lit("-")))).alias("critiques_md5"),
    )


def critiqued_completions(spark: SparkSession, sf: str) -> DataFrame:
    """Prompt rows with their completions and, beside them, the critiques."""
    completed = derive.completions_table(spark, sf)
    attached = crit.attach_critiques(completed, crit.collect_critiques(_critiqued(spark, sf, completed)))
    return attached.select(
        "prompt_id",
        joined(F.transform("completions", lambda c: F.md5(c["response"]))).alias("responses_md5"),
        joined(F.transform("critiques", lambda c: F.coalesce(c["score"].cast("string"), F.lit("-")))).alias("scores"),
    )


# --- scores and pairs -------------------------------------------------------

def _scored(judged: DataFrame, mode: str = "exact") -> DataFrame:
    return scoring.weighted_score(scoring.gather_ratings(judge.judge_ratings(judged)), mode=mode)


def repeated_judgements(spark: SparkSession, sf: str) -> DataFrame:
    """Some calls were repeated and their repeat cut short: ratings and annotations agree."""
    buckets = derive.judge_buckets(spark, sf)
    completed = derive.completions_table(spark, sf, buckets)
    judged = derive.judged(spark, sf, completed)
    again = seeded_share(seeded_int("again", F.col("prompt_id"), F.col("aspect")), 0.4)
    calls = F.when(again, F.array("response", F.substring("response", 1, 30))).otherwise(F.array("response"))
    judged = stage_bucketed(judged.withColumn("response", F.explode(calls)), "judged_twice", "prompt_id", buckets)
    once = judge.parse_judgements(judge.settled_judgements(judged, dealt=True))
    annotated = scoring.attach_annotations(completed, once, settled=True, dealt=True)
    beside = scoring.weighted_score(scoring.gathered_from_annotated(annotated))
    beside = beside.select("prompt_id", joined(F.col("tenths").cast("array<string>")).alias("annotated_tenths"))
    return _scored(judged).select(
        "prompt_id", "score_status", joined(F.col("tenths").cast("array<string>")).alias("tenths")
    ).join(beside, "prompt_id")


def incomplete_prompts(spark: SparkSession, sf: str) -> DataFrame:
    completed = derive.completions_table(spark, sf)
    return scoring.incomplete_reasons(completed, _scored(derive.judged(spark, sf, completed)))


def weighted_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(_judged(spark, sf))
    return scored.select(
        "prompt_id", "score_status", "optional_dropped",
        joined("tenths").alias("tenths"),
        F.get("scores", F.lit(0)).alias("score_0"),
        F.get("scores", F.lit(3)).alias("score_3"),
    )


def weighted_scores_float(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scored(_judged(spark, sf), "float_compat")
    return scored.where(F.col("score_status") == "ok").select(
        "prompt_id", *[F.get("scores", F.lit(i)).alias(f"score_{i}") for i in range(4)]
    )


def annotated_completions(spark: SparkSession, sf: str) -> DataFrame:
    """The weighted output: full annotations and scores nested per completion."""
    completed, judged = derive.completed_and_judged(spark, sf)
    parsed = judge.parse_judgements(judge.settled_judgements(judged, dealt=True))
    annotated = scoring.attach_annotations(completed, parsed, settled=True, dealt=True)
    scored = scoring.weighted_score(scoring.gathered_from_annotated(annotated))
    rows = scoring.scored_completions(scored).select(
        "prompt_id", "source", F.posexplode("completions").alias("slot", "c")
    )
    return rows.select(
        "prompt_id", "source", "slot", "c.model", "c.overall_score",
        F.md5("c.response").alias("response_md5"),
        F.col("c.annotations.honesty.Rating").alias("honesty"),
        F.col("c.annotations.helpfulness.Rating").alias("helpfulness"),
        joined("c.annotations.truthfulness.Type").alias("truth_types"),
        F.md5("c.annotations.honesty.Rationale").alias("rationale_md5"),
    )


def _pair_columns(df: DataFrame) -> DataFrame:
    ratings = [
        F.col(f"{side}_rating.{name}").alias(f"{side}_{name}")
        for side in ("chosen", "rejected")
        for name in ("overall_score", *fixed.RATING_RECORD_ORDER)
    ]
    return df.select(
        "prompt_id", "source", F.md5("instruction").alias("instruction_md5"),
        *digest("chosen_response", "rejected_response"), *ratings,
    )


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    completed = derive.completions_table(spark, sf)
    return build_preferences(completed, derive.judged(spark, sf, completed))


def preference_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _pair_columns(_pairs(spark, sf))


def preference_pairs_float(spark: SparkSession, sf: str) -> DataFrame:
    completed = derive.completions_table(spark, sf)
    pairs = build_preferences(completed, derive.judged(spark, sf, completed), mode="float_compat")
    return _pair_columns(pairs)


def binarized_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ins.count_by_source(pairing.binarized(_pairs(spark, sf)))


def chat_pairs(spark: SparkSession, sf: str) -> DataFrame:
    completed = derive.completions_table(spark, sf)
    pairs = pairing.make_chat_pairs(_scored(derive.judged(spark, sf, completed)), completed)

    def flat(side: str) -> Column:
        turns = F.transform(side, lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
        return F.md5(F.array_join(turns, "\n")).alias(f"{side}_md5")

    return pairs.select("prompt_id", flat("chosen_response"), flat("rejected_response"))


def _training(spark: SparkSession, sf: str, family: str) -> DataFrame:
    return train.format_training_rows(_pairs(spark, sf), family).select(
        *digest("prompt", "chosen", "rejected")
    )


def training_rows_qwen(spark: SparkSession, sf: str) -> DataFrame:
    return _training(spark, sf, "qwen")


def training_rows_llama3(spark: SparkSession, sf: str) -> DataFrame:
    return _training(spark, sf, "llama3")


def training_rows_within_length(spark: SparkSession, sf: str) -> DataFrame:
    rows = export_training_rows(_pairs(spark, sf), max_len=4096)
    return rows.select(*digest("prompt", "chosen", "rejected"))


def _token_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents beside their neighbours as rows of a prompt and two answers."""
    docs = derive.table(spark, sf, "documents")
    answer = lambda n: derive.table(spark, sf, "documents").select(
        (F.col("doc_id") - n).alias("doc_id"), F.col("text").alias(f"a{n}")
    )
    rows = docs.join(answer(1), "doc_id").join(answer(2), "doc_id")
    rows = rows.withColumnsRenamed({"text": "prompt", "a1": "chosen", "a2": "rejected"})
    return train.format_training_rows(rows, "qwen")


def _vocabulary() -> "train.Vocabulary":
    import public_tokenizers

    return train.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def training_rows_token_length(spark: SparkSession, sf: str) -> DataFrame:
    """The length budget by a real vocabulary; most rows are decided by their bytes."""
    rows = train.within_token_length(_token_rows(spark, sf), _vocabulary(), 2048)
    return rows.select(*digest("prompt", "chosen", "rejected"))


def token_length_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """How many rows each bound decides, and how many the tokenizer must see."""
    bound = train.length_bound(_vocabulary(), 2048)
    return _token_rows(spark, sf).groupBy(bound.alias("decision")).agg(F.count(F.lit(1)).alias("n"))


def published_preferences(spark: SparkSession, sf: str) -> DataFrame:
    """A publication that dies between its outputs, its rerun, and what a reader then finds."""
    completed, judged = derive.completed_and_judged(spark, sf)
    parsed = judge.parse_judgements(judge.settled_judgements(judged, dealt=True))
    annotated = scoring.attach_annotations(completed, parsed, settled=True, dealt=True)
    root = stage_path(spark, "published")

    class Died(Exception):
        pass

    def dies(name: str) -> None:
        if name == "annotations_binarized.parquet":
            raise Died

    try:
        write_preferences(annotated, root, version="first", after=dies, compression="gzip")
    except Died:
        pass
    if current_version(spark, root) is not None:
        raise AssertionError("half a set was published")
    write_preferences(annotated, root, version="first", compression="gzip")
    rows = [
        read_published(spark, root, name).groupBy("source").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("output"), "source", "n")
        for name in PREFERENCE_OUTPUTS
    ]
    result = rows[0]
    for part in rows[1:]:
        result = result.unionByName(part)
    return result


def shard_stages(spark: SparkSession, sf: str) -> DataFrame:
    """Completions in numbered shards, carried over to critiqued shards of the same numbers."""
    folder = stage_path(spark, "stages")
    table = derive.completions_table(spark, sf)
    completed = table.select("prompt_id", "source", "completions")
    write_sharded(completed, folder + "/completions", F.col("prompt_id"), files_per_shard=2, compression="gzip")
    critiques = crit.collect_critiques(_critiqued(spark, sf, table))
    done = carry_shards(
        spark, folder + "/completions/shard={}", "completions", "critiqued", completed.schema,
        lambda rows: crit.attach_critiques(rows, critiques), files_per_shard=2, compression="gzip",
    )
    back, _ = split_corrupt(read_shards(spark, folder + "/critiqued/shard={}", done))
    before, _ = split_corrupt(read_shards(spark, folder + "/completions/shard={}", completed.schema))
    shards = before.select("prompt_id", F.col("shard").alias("shard_before"))
    carried = back.select(  # digests before the join, which then moves no text
        "prompt_id", "shard",
        joined(F.transform("completions", lambda c: F.md5(c["response"]))).alias("responses_md5"),
        joined(F.transform("critiques", lambda c: F.coalesce(c["score"].cast("string"), F.lit("-")))).alias("scores"),
    )
    return carried.join(shards, "prompt_id").select(
        "prompt_id", (F.col("shard") == F.col("shard_before")).alias("same_shard"), "responses_md5", "scores"
    )


def training_rows_double_wrapped(spark: SparkSession, sf: str) -> DataFrame:
    rows = export_training_rows(
        _pairs(spark, sf), "llama3", max_len=2048, count_tokens=train.word_tokens, double_wrap=True
    )
    return rows.select(*digest("prompt", "chosen", "rejected"))


QUERIES = {
    f.__name__: f
    for f in [
        read_parquet_directory, parquet_round_trip, jsonl_round_trip, csv_round_trip,
        sharded_round_trip, annotation_file_shapes, corrupt_line_rejects, five_source_files, stage_counts,
        conversation_first_turn, conversation_instructions, conversation_rejects,
        source_rules, united_sources, quality_kept, quality_rejects, quality_rejects_han,
        invalid_answered_instructions, deduplicated, sampled_exact, sampled_fast, trial_fraction, source_counts,
        gathered_instructions,
        drawn_models, planned_prompts, unknown_source_rejects, completion_requests,
        assembled_completions, attached_responses, pending_requests, regrouped_responses,
        inferred_responses, resumed_responses, deadline_responses, routed_responses, critiqued_completions, repeated_judgements,
        judge_requests, annotations, judgement_rejects, judge_ratings, not_applicable_counts,
        critique_requests, critique_scores, critique_scores_strict, critique_rejects,
        critiques_by_prompt,
        incomplete_prompts, weighted_scores, weighted_scores_float, annotated_completions,
        preference_pairs, preference_pairs_float, binarized_counts, chat_pairs,
        training_rows_qwen, training_rows_llama3, training_rows_within_length,
        training_rows_double_wrapped, training_rows_token_length, token_length_bounds,
        published_preferences, shard_stages,
    ]
}
