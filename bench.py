"""Time the headline queries and print one JSON line.

Every query runs BENCH_RUNS times in a row (default 2) and the mean counts. The
first and the best times are in the output as ``first_run`` and ``best_run``.

Settings: BENCH_SF_DIR (input folder), BENCH_CPUS (local cores), BENCH_RUNS,
BENCH_QUERIES (comma list or "all", default: the headline queries).
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from talkmart.plans.queries import QUERIES  # noqa: E402
from talkmart.session import build_session  # noqa: E402

HEADLINE = (
    "clean_sentences",
    "clean_prototype",
    "split_comment",
    "split_sentences",
    "nest_records",
    "quarantine_bad",
    "ingest_raw_json",
    "json_violations",
    "backfill_days",
    "parse_counts",
    "top_viewed_per_keyword",
    "stride_shards",
    "dedupe_posts",
    "comment_dedupe",
    "upsert_posts",
    "upsert_comments",
    "append_comment_metric",
    "append_keywords",
    "social_attention",
    "facelift_sentiment",
    "attention_daily",
    "prompt_batches",
    "score_sentences",
    "reply_failures",
    "profile_pages",
    "view_pages",
    "page_text",
    "constraint_report",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    if chosen == ["all"]:
        chosen = list(QUERIES)
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    seconds: dict[str, float] = {}
    first_run: dict[str, float] = {}
    best_run: dict[str, float] = {}
    for name in chosen:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(round(time.perf_counter() - start, 3))
        first_run[name], best_run[name], seconds[name] = times[0], min(times), round(sum(times) / runs, 3)
        print(f"{name}: {times}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "runs": runs,
                "first_run": first_run,
                "best_run": best_run,
            }
        )
    )


if __name__ == "__main__":
    main()
