"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores.
Each query runs once to warm up and then three times; the middle time counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from gridlark.plans import derived  # noqa: E402
from gridlark.plans.queries import QUERIES  # noqa: E402
from gridlark.session import released  # noqa: E402

HEADLINE = [
    "s2_cell_id",
    "s2_area_m2",
    "s2_distance_meters",
    "s2_to_geo",
    "s2_children",
    "s2_cell_neighbors",
    "s2_covering",
    "s2_interior_covering",
    "s2_cell_density",
    "s2_point_in_cells_join",
    "s2_point_in_fences_join",
    "s2_neighbor_join",
    "s2_union_overlap_join",
    "s2_cell_union_area",
    "cell_union_agg",
    "rs_metadata",
    "rs_value",
    "rs_stats",
    "rs_histogram",
    "rs_pixels",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    derived.rasters(spark, sf_dir)  # written once, before any time is taken

    def run(name: str) -> float:
        with released(spark):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - start

    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(3)), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline queries, total of medians", "value": total, "unit": "sec",
                      "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("/", 1)[-1]}))


if __name__ == "__main__":
    main()
