"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Every query runs
to a sink that computes all rows and keeps none, once to warm up and then
``BENCH_RUNS`` times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from scenetext.plans.registry import QUERIES

HEADLINE = (
    "rgb_composite",
    "percentile_stretch",
    "stretch_stack",
    "merge_overlaps",
    "tile_layout",
    "stitch_lines",
    "quantile_colours",
    "tile_clamp_normalize",
    "clamp_normalize",
    "tile_composite",
    "scan_rasters",
    "render_tiles",
    "word_count",
    "word_sum",
    "top_words",
    "char_counts",
    "strip_punctuation",
    "tweet_fields",
    "tweet_tokens",
    "tokens_by_freq_top15",
    "tokens_by_length_top10",
    "scene_catalog",
    "scene_index",
    "place_points",
    "event_props",
    "user_map_plural",
    "user_reduce_sum",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
            spark.catalog.clearCache()
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
