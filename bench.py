"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder and ``BENCH_CPUS`` the local cores. Every query is
run in full (its result is written to the no-op sink) after one short warm-up query.
"""

from __future__ import annotations

import json
import os
import time

from colloquy.plans.queries import QUERIES
from colloquy.session import local_session

HEADLINE = [
    "profile_record", "value_counts_topk", "length_histogram", "clean_audit", "clean_pipeline", "dedup_first",
    "with_position", "pairs_from_turns", "assemble_history", "render_chat", "stratified_split",
    "sample_per_group", "rouge_rows", "bleu", "bleu_documents", "length_stats", "latency_stats",
    "latency_summary", "greedy_match", "metrics_for", "metrics_documents", "compare_full", "parse_rating",
    "judge_report", "tool_call_validity", "order_lookup", "plan_change", "adjudication_summary",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    QUERIES["flag_chars"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
