"""Time the headline queries. Prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores (default 8).
Every query is built and fully evaluated; a first untimed round warms the JVM up.
"""

from __future__ import annotations

import json
import os
import sys
import time

from catalog.queries import QUERIES
from tidemark.session import build_session

HEADLINE = [
    "clean_strip_non_ascii", "dedup_latest", "refine_offers", "surrogate_key", "landing_offers", "landing_html_items",
    "calendar_expand", "changes_only_values", "scd2_tiers", "interval_join_rates", "tariff_pivot", "offers_enriched",
    "fact_offers", "close_absent", "close_absent_replay", "merge_upsert", "mart_opportunities",
    "mart_opportunities_ranged", "mart_best_offers", "mart_model_summary", "mart_trends", "dash_heatmap",
    "dq_report", "dq_duplicates", "stream_poll_merge",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "8g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
            # As many shuffle partitions as cores: merging small ones would only idle cores.
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(query: str) -> float:
        start = time.perf_counter()
        QUERIES[query](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    for query in names:
        run(query)
    timed = {query: run(query) for query in names}
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": timed, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
