"""Benchmark: run the headline queries and print one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8). Each query
is run to completion with a no-op sink; the value is the sum of the seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidemark.queries import REGISTRY  # noqa: E402
from tidemark.session import local_session  # noqa: E402

HEADLINE = [
    "current_state_two_batches",
    "dimension_two_runs",
    "domain_two_runs",
    "stream_upsert",
    "changed_or_new_sentinels",
    "surrogate_key_stability",
    "unknown_member",
    "latest_per_key",
    "latest_per_key_by_rank",
    "source_equipment_view",
    "source_farm_view",
    "source_front_view",
    "lookup_enrichment",
    "run_status_report",
    "batch_row_totals",
    "batch_state_fold",
    "run_result_totals",
    "failed_attribution",
    "sync_log_stats",
    "retention_delete_current_state",
    "union_unlike",
    "unpivot_measures",
    "pivot_zero_fill",
    "top_values",
    "hash_keys",
    "nearest_supplier_per_order",
    "url_rollup",
    "row_checks_one_scan",
    "q_equality",
    "q_cardinality_equality",
    "q_mutually_exclusive_ranges",
    "q_exclusive_ranges_whole_table",
    "q_sequential_values",
    "q_relationships_where",
    "q_unique_combination",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, "tidemark-bench")
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    seconds: dict[str, float] = {}
    for name in wanted:
        start = time.perf_counter()
        REGISTRY[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
