"""Benchmark: full refresh (bronze -> silver -> gold) plus every analytic query,
the data-quality suite and the lineitem dedup, on $BENCH_SF_DIR with local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is executed completely with the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tierwise.session import build_session
    # spark.checkpoint.dir comes from the environment's defaults when it names one;
    # tierwise.session.shared_root() creates a private folder only when it is unset.
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    spark = build_session(f"local[{cpus}]", max(8, cpus * 2), "tierwise-bench", extra)

    from tierwise.plans import checks as C
    from tierwise.plans import queries as Q
    from tierwise.plans import reports as R
    from tierwise.plans.warehouse import DEFAULT_AS_OF, warehouse_for
    from tierwise.sources.testdata import load_tables

    timings: dict[str, float] = {}
    t0 = time.time()
    wh = warehouse_for(spark, sf_dir)
    timings["refresh"] = time.time() - t0

    jobs = {name: (lambda fn=getattr(Q, name): fn(wh.gold)) for name in sorted(dir(Q))
            if re.match(r"q\d\d_", name)}
    jobs["q20_customer_report"] = lambda: R.customer_report(wh.gold, DEFAULT_AS_OF)
    jobs["q21_product_report"] = lambda: R.product_report(wh.gold, DEFAULT_AS_OF)
    jobs["dq_suite"] = lambda: C.suite(wh)
    jobs["e01_latest_lineitem"] = lambda: C.latest_lineitem(load_tables(spark, sf_dir, ("lineitem",))["lineitem"])

    for name, build in jobs.items():
        t = time.time()
        build().write.format("noop").mode("overwrite").save()
        timings[name] = time.time() - t

    total = sum(timings.values())
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "refresh_plus_queries_total", "value": round(total, 3), "unit": "sec",
        "queries": {k: round(v, 3) for k, v in timings.items()},
        "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
