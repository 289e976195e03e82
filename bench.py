"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is timed end to end (plan + run, result fully materialised by a
row count on the driver side of a ``noop`` write), median of
$BENCH_REPEAT runs after one warm-up run of the whole set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clausework.plans.queries import QUERIES  # noqa: E402
from clausework.session import local_session  # noqa: E402

HEADLINE = ["tag_documents", "tag_batch_udf", "stance_lists", "stance_tagged", "windows_overlap",
            "windows_fixed", "macro_metrics", "label_vocab", "multi_hot", "sample_exact", "split_exact",
            "parse_actors", "roundtrip"]


def run(spark, name: str, sf: str) -> float:
    t0 = time.perf_counter()
    df = QUERIES[name](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="clausework-bench")
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:          # warm-up: JIT, Python workers, file listing
        run(spark, name, sf)
    times = {}
    for name in names:
        times[name] = round(statistics.median(run(spark, name, sf) for _ in range(repeat)), 3)
    total = round(sum(times.values()), 3)
    sf_name = os.path.basename(sf.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf_name, "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
