"""Benchmark the headline queries; prints ONE JSON line on stdout.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (timed runs per query after one warm-up, default 1),
     BENCH_QUERIES (comma list to run a subset),
     BENCH_LIMIT (seconds a query may take in all its runs, default 200).
Each run executes the whole plan into the no-op sink (nothing is collected
to the driver); the reported time per query is the median of the timed runs.
A query whose warm-up took over a third of its limit is not run again: its
warm-up is the figure, and it is named under "cold".  A query that reaches its
limit is stopped and named under "stopped".  Every result goes to stderr as it
ends, and the line on stdout comes also when the process is told to end.
B3 (read cost per layout) is the pair feed_topn_norm / feed_topn_denorm.
"""

from __future__ import annotations

import json
import os
import re
import signal
import statistics
import sys
import threading
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["fanout_norm", "fanout_denorm", "sink_inboxes", "home_timeline",
            "feed_topn_norm", "feed_topn_denorm", "stream_fanout"]


def stop_running(spark) -> None:
    for q in spark.streams.active:
        q.stop()
    spark.sparkContext.cancelAllJobs()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    limit = float(os.environ.get("BENCH_LIMIT", "200"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out, cold, stopped = {}, [], []

    def report() -> None:
        print(json.dumps({
            "metric": "headline_total_median_sec", "value": round(sum(out.values()), 3), "unit": "sec",
            "queries": out, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus, "runs": runs,
            "cold": cold, "stopped": stopped}), flush=True)

    def ended(*_) -> None:
        stopped.extend(n for n in names if n not in out and n not in stopped)
        report()
        os._exit(1)

    signal.signal(signal.SIGTERM, ended)

    from feedloom.plans.registry import QUERIES
    from feedloom.session import get_session
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus * 2,
                        extra={"spark.driver.memory": "16g"})

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    for name in names:
        timer = threading.Timer(limit, stop_running, [spark])
        timer.start()
        began, times = time.perf_counter(), []
        try:
            first = run(name)                           # warm-up
            if first > limit / 3:
                cold.append(name)
                times.append(first)
            else:
                times += [run(name) for _ in range(runs)]
        except Exception as e:
            if time.perf_counter() - began < limit:
                raise
            print(f"{name}: {type(e).__name__} after {time.perf_counter() - began:.0f} s", file=sys.stderr, flush=True)
        finally:
            timer.cancel()
        if times:
            out[name] = round(statistics.median(times), 3)
        else:
            stopped.append(name)
        print(f"{name}: {out.get(name, 'stopped')}", file=sys.stderr, flush=True)
    report()


if __name__ == "__main__":
    main()
