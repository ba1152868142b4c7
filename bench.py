"""Time every driver query at one scale factor; print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional comma-separated subset), BENCH_REPEATS (default 2: each
query runs that many times and the fastest run is reported, which damps the
run-to-run noise of a shared machine).  Each query runs to completion
through the ``noop`` sink, so the whole plan executes without shipping rows to
the driver.  Time includes the query's own setup jobs (key histogram, scratch
writes).  A warm-up pass runs first so JVM and Python-worker start-up are not
charged to a query.

Every time goes to standard error at once.  A query that runs over
BENCH_QUERY_LIMIT seconds (default 120) is cancelled and listed under ``stopped``;
after BENCH_LIMIT seconds (default 1500) no further repeat or query is begun, and
what wasn't reached is listed under ``skipped``; the JSON line is printed in any
case, also when the process is asked to end.
"""

from __future__ import annotations

import json
import os
import re
import signal
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sftforge.session import local_session  # noqa: E402
from sftforge.queries import QUERIES  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    wanted = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    repeats = max(1, int(os.environ.get("BENCH_REPEATS", "2")))
    spark = local_session(cpus, max(8, 2 * cpus), app_name="sftforge-bench")

    # Warm-up on the smallest text table: JIT and codegen for the regex path.
    from pyspark.sql import functions as F
    from sftforge.functions.text import normalize_text
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").repartition(cpus)
    bench.select(normalize_text(F.col("text")).alias("t")).write.format("noop").mode("overwrite").save()

    limit, query_limit = float(os.environ.get("BENCH_LIMIT", "1500")), float(os.environ.get("BENCH_QUERY_LIMIT", "120"))
    begun = time.perf_counter()
    names = [n for n in QUERIES if not wanted or n in wanted]
    times: dict[str, float] = {}
    stopped: list[str] = []
    m = re.search(r"sf([0-9.]+)$", sf_dir)

    def report() -> None:
        print(json.dumps({
            "metric": "total_query_seconds",
            "value": round(sum(times.values()), 3),
            "unit": "sec",
            "queries": times,
            "sf": float(m.group(1)) if m else sf_dir,
            "cpus": cpus,
            "repeats": repeats,
            "stat": "min",
            "stopped": stopped,
            "skipped": [n for n in names if n not in times and n not in stopped],
        }), flush=True)

    def ended(*_) -> None:
        report()
        os._exit(1)

    signal.signal(signal.SIGTERM, ended)
    for name in names:
        for _ in range(repeats):
            if time.perf_counter() - begun > limit or name in stopped:
                break
            spark.sparkContext.setJobGroup(name, name, interruptOnCancel=True)
            watch = threading.Timer(query_limit, spark.sparkContext.cancelJobGroup, [name])
            watch.start()
            t0 = time.perf_counter()
            try:
                QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            except Exception as failed:  # noqa: BLE001 -- one query's end isn't the bench's
                if time.perf_counter() - t0 < query_limit:
                    raise
                stopped.append(name)
                times.pop(name, None)
                print(f"{name}: stopped after {query_limit} s ({type(failed).__name__})", file=sys.stderr, flush=True)
                break
            finally:
                watch.cancel()
            took = round(time.perf_counter() - t0, 3)
            times[name] = min(took, times.get(name, took))
            print(f"{name}: {took} s", file=sys.stderr, flush=True)
    report()
    spark.stop()


if __name__ == "__main__":
    main()
