"""Personal data: fixed forms, and identifiers found by what stands around the known ones.

The fixed forms of emails, IP addresses, card and phone numbers are the seeds. The
words beside a seed, one or two on either side, are its lexical patterns. Whatever has
the loose shape of a kind but not its fixed form is a candidate. Patterns and the
values beside them make a graph. Spark scores it in rounds:

- a pattern by how often its words stand beside a value of the kind rather than
  beside anything else in the whole corpus; it needs several different values,
- a value by the patterns it has, so that accepted values support further patterns.

Candidates whose value comes out above the threshold are added to the seeds.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import join_by_size, stage
from .filters import Filter, mixed

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# Different values a pattern needs, the confidence from which patterns and values
# count, the weight of candidates that are not accepted, and what is added against.
LEAST_VALUES = 3
THRESHOLD = 0.75
UNDECIDED, PRIOR = 0.25, 0.5
ROUNDS = 3

# Fixed forms. Each is written so that no character is looked at twice.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
FOUR_NUMBERS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
CALL = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
# Loose shapes.
HOST = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*")
CHAIN = re.compile(r"(?<![0-9])\(?[0-9]++(?:[ ().-]{1,2}[0-9]++)*")
COLONS = re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])")
ANY = re.compile(r"[0-9@]")
DIGIT = re.compile(r"[0-9]")
MARK = "\0"


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def before_at(text: str, at: int, low: int) -> int:
    """Where the local part in front of the ``@`` begins, not before ``low``."""
    return low + len(text[low:at].rstrip(LOCAL))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed forms, by kind, then start."""
    found, low = [], 0
    for m in DOMAIN.finditer(text) if "@" in text else ():
        start = before_at(text, m.start(), low)
        if start < m.start():
            found.append((EMAIL, start, m.end()))
            low = m.end()
    if not DIGIT.search(text):
        return found
    for m in FOUR_NUMBERS.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            found.append((IP, *m.span()))
    for m in DIGITS.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((CARD, *m.span()))
    for m in CALL.finditer(text) if "+" in text else ():
        if 8 <= len(DIGIT.findall(m.group())) <= 15:
            found.append((PHONE, *m.span()))
    return found


def loose_spans(text: str) -> list[tuple[tuple[int, ...], int, int]]:
    """(possible kinds, start, end) of the loose shapes by start, longer ones first."""
    found, low = [], 0
    for m in HOST.finditer(text) if "@" in text else ():
        start = before_at(text, m.start(), low)
        if start < m.start():
            found.append(((EMAIL,), start, m.end()))
            low = m.end()
    for m in COLONS.finditer(text) if ":" in text else ():
        found.append(((IP,), *m.span()))
    for m in CHAIN.finditer(text):
        n = len(DIGIT.findall(m.group()))
        kinds = (
            ((IP,) if FOUR_NUMBERS.fullmatch(m.group()) else ())
            + ((CARD,) if 12 <= n <= 19 else ()) + ((PHONE,) if 7 <= n <= 15 else ())
        )
        if kinds:
            found.append((kinds, *m.span()))
    return sorted(found, key=lambda f: (f[1], -f[2]))


def apart(taken: list[tuple[int, int]], found: list[tuple]) -> list[tuple]:
    """Those of ``found`` that overlap neither ``taken`` nor one before them.

    ``found`` is sorted by start, longer ones first.
    """
    free, held, low = [], sorted(taken), 0
    at = 0
    for item in found:
        start, end = item[1:3]
        while at < len(held) and held[at][0] < end:
            low = max(low, held[at][1])
            at += 1
        if start >= low:
            free.append(item)
            low = end
    return free


def words_around(text: str, spans: list[tuple[int, int]]) -> tuple[list[str], list[int]]:
    """Lower-cased words with a mark for each span, overlapping ones as one; the marks' places."""
    words: list[str] = []
    places, at = [], 0
    for start, end in spans:  # sorted by start
        if start >= at:
            words += text[at:start].lower().split()
            words.append(MARK)
        places.append(len(words) - 1)
        at = max(at, end)
    words += text[at:].lower().split()
    return words, places


def word_hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))


def context_hash(words: list[str]) -> int:
    hashes = np.array([word_hash(w) for w in words], np.uint64)
    found = hashes if len(words) == 1 else mixed(hashes[:1], hashes[1:])
    return int(found.view(np.int64)[0])


def patterns_at(words: list[str], place: int) -> list[dict]:
    """One or two words before and behind a mark, as far as the text has them."""
    sides = [("before", words[max(0, place - n) : place], n) for n in (1, 2)]
    sides += [("behind", words[place + 1 : place + 1 + n], n) for n in (1, 2)]
    return [
        {"pattern": f"{side} {' '.join(near)}", "context": context_hash(near)}
        for side, near, n in sides if len(near) == n
    ]


def all_spans(text: str) -> tuple[list, list]:
    """Fixed forms, and candidates that overlap none of them."""
    if not ANY.search(text):
        return [], []
    base = base_spans(text)
    return base, apart([b[1:] for b in base], loose_spans(text))


SCANNED = (
    "doc_id {kind}, row long, base array<struct<kind:int,start:long,end:long>>,"
    " found array<struct<seed:boolean,kinds:array<int>,start:long,end:long,value:string,"
    "patterns:array<struct<pattern:string,context:long>>>>"
)


def scan(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                base, loose = all_spans(text)
                spans = sorted([((k,), s, e, True) for k, s, e in base] + [(*f, False) for f in loose], key=lambda f: f[1:])
                words, places = words_around(text, [f[1:3] for f in spans]) if spans else ([], [])
                rows.append({
                    "doc_id": doc_id, "row": row, "base": [dict(kind=k, start=s, end=e) for k, s, e in base],
                    "found": [
                        dict(seed=seed, kinds=list(kinds), start=s, end=e, value=text[s:e].lower(),
                             patterns=patterns_at(words, place))
                        for (kinds, s, e, seed), place in zip(spans, places)
                    ],
                })
                row += 1
            yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def count_contexts(wanted: Filter, parts: Filter):
    """How often each wanted context stands in the texts, for each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = defaultdict(count(1).__next__)
            codes, zero = [], np.zeros(1, np.int64)
            for text in batch.column(0):
                text = text.as_py() or ""
                base, loose = all_spans(text)
                spans = sorted([b[1:] for b in base] + [f[1:] for f in loose])
                words, _ = words_around(text, spans)
                codes += [np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)), zero]
            if not codes:
                continue
            code = np.concatenate(codes)
            hashes = np.array([0, *map(word_hash, numbers)], np.uint64)
            n = np.bincount(code, minlength=len(hashes))
            usual = parts.has(hashes)
            usual[0] = False
            single = wanted.has(hashes) & (n > 0)
            single[0] = False
            at = np.flatnonzero(usual[code[:-1]] & usual[code[1:]])
            pairs, times = np.unique(code[at] << 32 | code[at + 1], return_counts=True)
            double = mixed(hashes[pairs >> 32], hashes[pairs & 0xFFFFFFFF])
            kept = wanted.has(double)
            found = np.concatenate([hashes[single], double[kept]]).view(np.int64)
            yield pa.record_batch(
                [pa.array(found), pa.array(np.concatenate([n[single], times[kept]]))], names=["context", "n"]
            )

    return run


def score_graph(scanned: DataFrame, texts: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """Scores of patterns (kind, pattern, confidence, n_values) and values (kind, value, score).

    ``scanned`` is a written table. Edges are distinct, with their number of
    occurrences, and meet both sides by ``join_by_size``.
    """
    seen = scanned.select(F.explode("found").alias("f")).select("f.*")
    edges = seen.select("seed", F.explode("kinds").alias("kind"), "value", F.explode("patterns").alias("p"))
    edges = edges.groupBy("kind", "value", "p.pattern", "p.context").agg(
        F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed")
    )
    node = lambda c: F.concat_ws(" ", F.col("kind").cast("string"), c)
    edges = edges.withColumns({"node": node("value"), "rule": node("pattern")})
    rules = edges.groupBy("rule").agg(
        F.count(F.lit(1)).alias("size"), F.max("seed").alias("seeded"), F.max("context").alias("context")
    ).where(F.col("size") >= LEAST_VALUES)
    rules = stage(rules, "pii_rules")
    wanted = rules.select("context").distinct()
    edges = stage(edges, "pii_edges")

    used = edges.join(wanted, "context", "left_semi")
    parts = used.select(F.explode(F.slice(F.split("pattern", " "), 2, 2)).alias("word")).distinct()
    hashed = stage(parts.mapInArrow(hash_words, "context long"), "pii_words")
    counted = texts.mapInArrow(count_contexts(Filter(wanted, "context"), Filter(hashed, "context")), "context long, n long")
    totals = counted.groupBy("context").agg(F.sum("n").alias("total"))
    rules = stage(rules.join(totals, "context", "left"), "pii_totals")
    edges = stage(
        join_by_size(edges, rules.select("rule", "size", "total"), "rule", "size", edges.count()), "pii_graph"
    )
    n_edges = edges.count()

    seeds = edges.where("seed").groupBy("node").agg(F.lit(1.0).alias("score"))
    sizes = stage(edges.groupBy("node").agg(F.count(F.lit(1)).alias("degree")), "pii_degrees")
    values = stage(sizes.join(seeds, "node", "left").na.fill({"score": 0.0}), "pii_values")
    for _ in range(rounds):
        met = join_by_size(edges, values, "node", "degree", n_edges)
        beside = F.sum("n")
        known = F.sum(F.col("n") * F.col("score"))
        against = F.greatest(F.max("total") - beside, F.lit(0)) + UNDECIDED * (beside - known)
        scores = met.groupBy("rule").agg(
            (known / (known + against + PRIOR)).alias("confidence"),
            F.count_if(F.col("score") >= THRESHOLD).alias("n_values"), F.count(F.lit(1)).alias("size"),
        )
        scores = stage(
            scores.where((F.col("confidence") >= THRESHOLD) & (F.col("n_values") >= LEAST_VALUES)), "pii_scores"
        )
        doubt = join_by_size(edges.drop("size"), scores, "rule", "size", n_edges).groupBy("node").agg(
            F.sum(F.log(1 - F.col("confidence"))).alias("doubt"), F.max("seed").alias("seed")
        )
        new = F.when(F.col("seed"), 1.0).otherwise(1 - F.exp("doubt"))
        found = doubt.select("node", new.alias("new"))
        values = values.join(found, "node", "left")
        keep = F.when(F.col("score") == 1.0, 1.0).otherwise(F.coalesce("new", F.lit(0.0)))
        values = stage(values.select("node", "degree", keep.alias("score")), "pii_values")
    split = lambda c, name: [
        F.substring_index(c, " ", 1).cast("int").alias("kind"), F.regexp_replace(c, r"\A\d+ ", "").alias(name)
    ]
    return (
        scores.select(*split("rule", "pattern"), "confidence", "n_values"),
        values.select(*split("node", "value"), "score"),
    )


def hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hashes = np.array([word_hash(w) for w in batch.column(0).to_pylist()], np.uint64)
        yield pa.record_batch([pa.array(hashes.view(np.int64))], names=["context"])


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per document: doc_id, base and spans.

    ``base`` has (kind, start, end) of the fixed forms, ``spans`` these and the found
    identifiers, both by kind, then start; kinds are numbers into KINDS, places are
    code points and ends exclusive. Found identifiers overlap no fixed form and
    have one kind, that with the higher score, then the smaller number.

    Null and empty texts have no spans. Every row is a document of its own, repeated
    ones and null ids too; copies count as often as they occur, but a pattern needs
    ``LEAST_VALUES`` different values. Texts of any length are scanned whole; other
    columns are not looked at. An empty table gives an empty result.
    """
    kind = dict(docs.dtypes)[doc_id]
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    ddl = SCANNED.format(kind=kind)
    schema = docs.sparkSession.createDataFrame([], ddl).toArrow().schema
    scanned = stage(source.mapInArrow(scan(schema), ddl), "pii_scanned")
    _, values = score_graph(scanned, source.select("text"), rounds)

    loose = scanned.select("row", F.explode("found").alias("f")).where("not f.seed").select(
        "row", "f.start", "f.end", "f.value", F.explode("f.kinds").alias("kind")
    )
    node = F.concat_ws(" ", F.col("kind").cast("string"), "value").alias("node")
    loose = stage(loose.select("row", "start", "end", "kind", node), "pii_loose")
    accepted = values.where(F.col("score") >= THRESHOLD).select(node, "score")
    sizes = loose.groupBy("node").agg(F.count(F.lit(1)).alias("size"))
    accepted = stage(accepted.join(sizes, "node"), "pii_accepted")
    met = join_by_size(loose, accepted, "node", "size", loose.count())
    best = F.min(F.struct((-F.col("score")).alias("score"), "kind"))["kind"]
    found = met.groupBy("row", "start", "end").agg(best.alias("kind"))
    # a document's own identifiers, as many as its text has
    found = found.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.expr("array()").cast(dict(scanned.dtypes)["base"]))))
    return scanned.select("doc_id", "row", "base").join(found, "row", "left").select("doc_id", "base", spans.alias("spans"))


def spans_text(spans: str):
    """``kind:start:end`` of each span, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    one = lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def span_counts(spans: str) -> list:
    """Spans of each kind, as n_<kind>."""

    def of(kind: int):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return [of(i).alias(f"n_{name}") for i, name in enumerate(KINDS)]
