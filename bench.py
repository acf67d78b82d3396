"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion into the no-op sink, so every column is computed
and nothing is collected. ``preference_pairs_from_documents`` also makes its inputs;
the others find theirs (sources, completions, judge and critique texts) written, as
in a real run. ``--all`` times every registered query.
"""

from __future__ import annotations

import json
import os
import sys
import time

from workloads import derive
from workloads.queries import QUERIES

HEADLINE = [
    "gathered_instructions", "deduplicated", "sampled_exact", "quality_rejects",
    "completion_requests", "assembled_completions", "judge_requests", "judge_ratings",
    "annotations", "critique_scores", "weighted_scores", "annotated_completions",
    "preference_pairs", "training_rows_within_length",
]


def main() -> None:
    from pairwright.plans import open_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = open_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # start-up and code generation are no query's: the same plans run once on the smallest tables
    smallest = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    warm = smallest if os.path.isdir(smallest) else sf_dir
    QUERIES["preference_pairs"](spark, warm).write.format("noop").mode("overwrite").save()
    names = [a for a in sys.argv[1:] if a in QUERIES] or HEADLINE
    if "--all" in sys.argv:
        names = list(QUERIES)
    seconds = {}

    def timed(label: str, name: str) -> None:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[label] = round(time.perf_counter() - start, 3)
        print(label, seconds[label], file=sys.stderr, flush=True)

    timed("preference_pairs_from_documents", "preference_pairs")
    derive.write_inputs(spark, sf_dir)
    for name in names:
        timed(name, name)
    print(json.dumps({
        "metric": "headline_total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
