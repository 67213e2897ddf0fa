"""Headline queries at one scale; prints one JSON line.

    BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from firnline.registry import load  # noqa: E402
from firnline.session import local_session  # noqa: E402

HEADLINE = (
    "last_status",
    "bad_transitions",
    "attach_parent",
    "job_view",
    "monthly_report",
    "best_per_tile_day",
    "match_tile_day",
    "nearest_satellite",
    "inputs_in_window",
    "new_jobs",
    "search_intervals",
    "product_span",
    "daily_fill",
    "temporal_fill",
    "upscale",
    "upscale_bits",
    "snow_counts",
    "persistent_snow",
    "value_histogram",
    "zonal_shares",
    "slope_aspect",
    "wet_dry_snow",
    "snow_quality",
    "gap_filled_day",
    "asof_previous",
    "previous_usable",
    "chain_quality",
    "acquisition_tiles",
    "overlap_area",
    "burn",
    "catalogue_from_paths",
    "lineage_edges",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("OFF")
    queries, _ = load()
    # start the workers and the JIT outside the timed part
    for name in ("last_status", "assemble_slices"):
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for name in HEADLINE:
        begin = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
