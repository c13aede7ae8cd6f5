"""Time the registered queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose tables and cores; BENCH_RUNS the timed runs per query
(the median counts, after one warm-up). Results are computed in full and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from letbook.plans.registry import QUERIES  # noqa: E402
from letbook.session import build_session  # noqa: E402

# Headline queries: the flagship, then one or two per group of operators.
HEADLINE = """
    sale_from_pages room_run sale_links_run sale_by_postcode room_by_postcode sql_surface location_lookup
    load_sale load_room scan_promote filter_combined facets latest_sale
    money_extract room_cards card_fields links_anchor distinct_urls detail_rows page_model_regex
    page_truncate status_tag dedup_listing dedup_url remaining_work ledger_update retry_set
    resolve_attempts run_summary rolling_latency error_rate progress_eta load_signal
    shard_sink snapshot_sink stream_shards stream_dedup stream_resume
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        began = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - began

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        once(name)
        seconds[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{seconds[name]:8.3f} {name}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "cpus": int(cpus),
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
