"""Time the headline queries and print one JSON line: of each the median of three runs.

BENCH_SF_DIR names the table folder, BENCH_CPUS the number of local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from pyspark.sql import SparkSession

from workload.queries import QUERIES

RUNS = 3
HEADLINE = (
    "wiki_pages",
    "wiki_link_pairs",
    "wiki_edges",
    "wiki_red_links",
    "wiki_outlinks",
    "wiki_inlinks",
    "page_count",
    "rank_iter1",
    "rank_iter8",
    "rank_snapshots",
    "top_ranked",
    "parts_edges",
    "parts_rank8",
    "xml_file_pages",
    "ranked_from_files",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("linkrank-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    run(names[0])  # starts the workers and compiles; not measured
    seconds = {name: round(median(run(name) for _ in range(RUNS)), 3) for name in names}
    spark.stop()
    result = {
        "metric": "total query time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
