"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from newsmill.session import build_session  # noqa: E402
from workload import registry  # noqa: E402

HEADLINES = (
    "relevance_report", "score_articles", "keyword_matches", "category_breakdown", "word_lexicon_scores",
    "report_text", "top_articles", "new_articles", "run_counters", "session_stats",
    "page_links", "source_crawl", "archive_first_fallback", "url_validate_strict", "page_articles", "page_scores",
    "url_list_counters", "archive_outcomes", "daily_captures", "sampled_captures", "first_capture",
    "new_urls_per_capture", "priority_search", "search_capped", "incremental_stream",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", **{
        "spark__master": f"local[{cpus}]", "spark__sql__shuffle__partitions": cpus,
        "spark__ui__enabled": "false", "spark__driver__memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    runs, seconds = registry.queries(), {}
    runs["score_articles"](spark, folder).write.format("noop").mode("overwrite").save()  # untimed: starts and compiles
    for name in HEADLINES:
        begin = time.perf_counter()
        runs[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
