"""Wall time of every registered query; prints one JSON line.

``BENCH_SF_DIR`` picks the tables, ``BENCH_CPUS`` the local cores and
``BENCH_RUNS`` how often a query runs, of which the fastest counts.  Results
are computed in full and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
import uuid

from touchline.plans import registry
from touchline.session import build_session

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
RUNS = int(os.environ.get("BENCH_RUNS", "2"))


def run(spark, name: str) -> float:
    start = time.perf_counter()
    registry.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    shared = os.path.join(tempfile.gettempdir(), f"touchline-bench-{uuid.uuid4().hex}")
    spark = build_session(
        "touchline-bench",
        **{
            "spark.master": f"local[{CPUS}]",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.checkpoint.dir": shared,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "dedup_first")
    seconds = {
        name: round(min(run(spark, name) for _ in range(RUNS)), 3)
        for name in names or sorted(registry.QUERIES)
    }
    spark.stop()
    report = {
        "metric": "total wall time of all queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main(sys.argv[1:])
