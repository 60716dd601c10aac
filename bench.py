"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS
(default 2) set the data, the threads and the runs per query.  ``queries`` has the best
run of each query, ``first_run`` the first, which includes code generation.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from basketflow.session import build_session  # noqa: E402
from checks import registry  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "2"))

HEADLINE = [
    *[name for name in registry.QUERIES if name.startswith("m") and not name.endswith("_safe")],
    "pub_m6_session_analytics", "pub_m8_geo_analysis",
    "d3_upsert_users", "d6_upsert_orders", "d11_sessions", "d16_apply_status",
    "v5_batch_not_null", "v11_fk_orphans", "e1_currency_as_of", "e2_geo", "e3_weather",
    "b10_weather_influence",
]


def main() -> None:
    only = sys.argv[1:]
    spark = build_session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS,
                          spark__driver__memory="16g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    best, first = {}, {}
    for name in HEADLINE:
        if only and not any(name.startswith(o) for o in only):
            continue
        for run in range(RUNS):
            start = time.perf_counter()
            registry.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            seconds = round(time.perf_counter() - start, 3)
            first.setdefault(name, seconds)
            best[name] = min(seconds, best.get(name, seconds))
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(best.values()), 3), "unit": "sec",
        "queries": best, "first_run": first, "sf": os.path.basename(SF_DIR).removeprefix("sf"),
        "cpus": int(CPUS), "runs": RUNS}))
    spark.stop()


if __name__ == "__main__":
    main()
