"""Benchmark the headline queries on the stand-in tables.

Runs each headline query once to warm up, then ``BENCH_RUNS`` times, and
prints ONE JSON line: total of the per-query medians (sec), per-query
medians, the Exchange count of each plan, and the scale factor. Each run
builds the query and drains it into Spark's ``noop`` sink, so every row is
computed and nothing is collected to the driver.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5), BENCH_ALL=1 to time every registered query.
"""

from __future__ import annotations

import contextlib
import io
import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from watchpath.plans.registry import queries, tables  # noqa: E402
from watchpath.session import get_session  # noqa: E402

HEADLINE = [
    "attributed_timeline_display",
    "attributed_timeline_feeder",
    "top_feeders_daily",
    "device_feed_list",
    "promo_reach_hours",
]


def _exchanges(df) -> int:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    plan = buf.getvalue().split("\n\n")[0]
    return len(re.findall(r"\bExchange\b", plan))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = get_session(cpus, app="watchpath-bench")
    registry = queries()
    names = list(registry) if os.environ.get("BENCH_ALL") else HEADLINE

    t0 = time.perf_counter()
    tables(spark, sf_dir)                     # stand-in tables, written once
    standin = time.perf_counter() - t0

    medians, exchanges, rows = {}, {}, {}
    for name in names:
        q = registry[name]
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()     # warm-up
        times = []
        for _ in range(runs):
            t = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - t)
        medians[name] = round(statistics.median(times), 4)
        df = q(spark, sf_dir)
        exchanges[name] = _exchanges(df)
        rows[name] = df.count()                   # untimed: shows the result is not empty

    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "sum_of_median_query_sec",
        "value": round(sum(medians.values()), 4),
        "unit": "sec",
        "queries": medians,
        "exchanges": exchanges,
        "rows": rows,
        "standin_materialize_sec": round(standin, 3),
        "runs": runs,
        "cpus": cpus,
        "sf": float(sf.group(1)) if sf else sf_dir,
    }))


if __name__ == "__main__":
    main()
