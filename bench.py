"""Benchmark the headline queries; prints ONE JSON line on stdout.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is executed in full through the ``noop`` sink (no collect to the
driver); one warm-up, then the median of ``BENCH_REPEAT`` timed runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerlake.catalog.queries import QUERIES  # noqa: E402
from ledgerlake.session import build_session  # noqa: E402

HEADLINE = [
    "account_summary",
    "account_summary_exact",
    "customer_master",
    "customer_master_exact",
    "customer_summary",
    "customer_summary_exact",
    "publish_refresh_period",
    "export_customer_summary_upsert",
    "stage_transaction",
    "stream_ingest_landing",
]


def run(spark, fn, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": "16g"})
    fns = dict(QUERIES)
    times = {}
    for name in only or HEADLINE:
        fn = fns[name]
        run(spark, fn, sf_dir)  # warm-up
        samples = [run(spark, fn, sf_dir) for _ in range(repeat)]
        times[name] = round(statistics.median(samples), 3)
        print(f"{name}: {times[name]}s {samples}", file=sys.stderr)
    sf_text = os.path.basename(sf_dir).replace("sf", "")
    try:
        sf: float | str = float(sf_text)
    except ValueError:
        sf = sf_text
    print(json.dumps({"metric": "headline_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "repeat": repeat, "spark": spark.version}))
    spark.stop()


if __name__ == "__main__":
    main()
