"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from faultline.plans import streams  # noqa: E402,F401
from faultline.plans.queries import QUERIES  # noqa: E402
from faultline.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
SLOW = 8.0  # seconds of timed runs after which a query is not repeated

HEADLINE = [
    "detection_metrics", "detect_ingest", "ingest_batch", "lexical_index", "keywords", "mask_tokens",
    "template_table", "mine_templates", "search_keyword", "search_substring", "mttr", "mttd",
    "apply_resolutions", "action_status_counts", "action_usefulness", "metrics_summary", "error_patterns",
    "windowed_alerts", "govern_actions", "audit_events", "semantic_topk", "hybrid_merge", "keyword_fallback",
    "hybrid_retrieve", "incident_context", "answer_questions", "stream_ingest",
    "window_summary", "embed_logs", "template_jaccard", "template_correlation", "evaluation_report",
    "semantic_topk_many", "search_indexed", "stream_triage", "stream_alerts", "stream_templates",
]


def main() -> None:
    spark = local_session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for attempt in range(RUNS + 1):  # the first run warms up
            start = time.perf_counter()
            QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            if attempt:
                runs.append(time.perf_counter() - start)
            if sum(runs) > SLOW:
                break
        seconds[name] = round(sorted(runs)[len(runs) // 2], 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries, median of warm runs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
