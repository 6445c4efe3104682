"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from floatlake.gallery.queries import QUERIES
from floatlake.session import local_session

HEADLINES = [
    "profile_metrics", "n_levels", "surface_temp", "mixed_layer_depth_bgc", "depth_stats_core",
    "summary_core", "summary_bgc", "region_closed", "region_grid", "region_share", "index_parse",
    "platform_first", "flatten_levels", "flatten_first_last", "clean_table", "readings_unpivot",
    "float_metadata", "metadata_upsert", "readings_by_float", "orphan_readings", "cascade_delete",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = local_session(cpus, shuffle_partitions=int(cpus))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in sys.argv[1:] or HEADLINES:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
    }))


if __name__ == "__main__":
    main()
