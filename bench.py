"""Seconds per registered query, whole results, on a local session.

Prints one JSON line. Every query runs twice in one session, cold and then
warm; ``queries`` and ``value`` (their sum) are the warm runs. ``BENCH_ONLY``
may name a comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import time

import pyspark

from martloom.catalogue import QUERIES
from martloom.session import local_session


def timed(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [name for name in os.environ.get("BENCH_ONLY", "").split(",") if name]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="martloom-bench")
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    cold, warm = {}, {}
    for name in only or QUERIES:
        cold[name] = timed(QUERIES[name], spark, sf_dir)
        warm[name] = timed(QUERIES[name], spark, sf_dir)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "warm seconds over all registered queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "spark": pyspark.__version__,
            }
        )
    )


if __name__ == "__main__":
    main()
