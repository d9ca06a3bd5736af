"""Seconds per registered query; prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated keys (default: all)
BENCH_RUNS     runs per query, the fastest counts (default 1, after a warm-up of the session)
"""

import json
import os
import sys
import time

from kinomill import catalog
from kinomill.session import local_session


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    registered = catalog.queries()
    keys = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k] or list(registered)
    spark = local_session(cores, shuffle_partitions=int(cores))
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().write.format("noop").mode(
        "overwrite"
    ).save()
    seconds = {}
    for key in keys:
        best = None
        for _ in range(runs):
            start = time.perf_counter()
            try:
                registered[key](spark, folder).write.format("noop").mode("overwrite").save()
            except Exception as error:  # a failing key must not hide the others
                print(f"{key}: {str(error)[:500]}", file=sys.stderr)
                break
            spent = time.perf_counter() - start
            best = spent if best is None else min(best, spent)
        if best is not None:
            seconds[key] = round(best, 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(folder.rstrip("/"))
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
