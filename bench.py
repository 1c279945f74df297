"""Headline timings: every registered query over $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. ``load_tables`` is the time to derive and write the nine star tables, which the
views then scan; it counts towards the total. Each query runs BENCH_RUNS times (default 1) and the
median is reported. A run builds the plan and executes it into the noop sink, which computes every
row and column. Names given as arguments restrict the run.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from exportlens.registry import QUERIES, loaded_tables  # noqa: E402
from exportlens.session import configure  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = (
        configure(SparkSession.builder)
        .master(f"local[{cpus}]")
        .appName("exportlens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("id % 7 AS k").groupBy("k").count().collect()

    seconds: dict[str, float] = {}
    start = time.perf_counter()
    tables = loaded_tables(spark, folder)
    for name in tables:
        tables[name]
    seconds["load_tables"] = round(time.perf_counter() - start, 3)
    for name in sys.argv[1:] or QUERIES:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
