"""Time the registered queries. Prints one JSON line.

Each query is planned, run and fully consumed once after a short session warm-up.
``BENCH_ONLY`` takes a comma-separated list of names.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from roadcast.session import build_session  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

# One query per family of operators; the others differ from these in the last step only.
HEADLINE = (
    "rows_per_report_90d",
    "recent_window",
    "grain_check_children",
    "null_profile",
    "null_profile_subset",
    "top_beats",
    "hour_histogram",
    "rows_per_report_describe",
    "normalize_rows",
    "integer_violations",
    "first_violation",
    "staging_counts",
    "header_check",
    "row_numbers",
    "requested_stations",
    "response_split",
    "capture_metrics",
    "batch_envelope",
    "observation_rows",
    "stream_observation_batches",
    "observation_flatten",
    "observation_cloud_layers",
    "feature_rules",
    "beat_consolidation",
    "beat_conflicts",
    "polygon_area",
    "geodesic_distance",
    "nearest_of_listed",
    "nearest_of_many",
    "beat_union",
    "beat_point",
    "area_mapping",
    "area_mapping_summary",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINE
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
