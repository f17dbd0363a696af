"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the local cores. Each query is built and
run to completion once, in a session warmed with one word count that is not among them.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.plans.queries import REGISTRY  # noqa: E402
from tidemark.session import build_session  # noqa: E402

HEADLINE = [
    "daily_summary",
    "lexicon_scores",
    "token_hit_counts",
    "prefix_join_hits",
    "valence_scores",
    "normalized_posts",
    "enriched_posts",
    "scorer_agreement",
    "window_replay",
    "run_extract_counts",
    "duplication_factor",
    "deduplicated_generations",
    "order_lines_coverage",
    "live_objects",
    "cumulative_lake",
    "partition_skew",
    "cost_report",
    "event_date_write",
    "merge_write",
    "stream_daily_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "tidemark-bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")
    REGISTRY["turn_word_counts"].build(spark, sf_dir).collect()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name:28s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
