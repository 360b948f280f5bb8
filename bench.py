"""Benchmark the headline jobs.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query once on a warm session (a short warm-up pass over
sf0.001 first) and executes the whole plan into the no-op sink, so no result is
collected to the driver.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["catalog_movie", "interactions_rating", "recall", "user_history", "stream_latest",
            "als_scores", "recommend"]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    from cinegraph.queries import QUERIES
    from cinegraph.session import local_session
    spark = local_session(cores=cpus, shuffle_partitions=cpus)
    warm = "/root/testdata/sf0.001"
    if os.path.isdir(warm) and os.environ.get("BENCH_WARMUP", "1") == "1":
        for n in names:
            run(QUERIES[n](spark, warm))
    times = {}
    for n in names:
        t0 = time.perf_counter()
        run(QUERIES[n](spark, sf_dir))
        times[n] = round(time.perf_counter() - t0, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_jobs_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
