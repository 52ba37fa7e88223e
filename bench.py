"""Benchmark: full refresh plus the KPI/report queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line.  Timings:

* ``refresh``: the whole batch pipeline from the given tables — raw layer,
  staging, rules, star schema and marts, each layer written as Parquet and
  read back (what a scheduled run does);
* ``kpi_*`` and report queries over the *published* tables (what the BI
  layer runs after a refresh);
* ``e2e_*``: selected queries straight from the given tables, the way the
  registry runs them (pipeline + query in one plan);
* ``intake_batch``: validate, dedupe and insert the web-order candidates.

Each query is executed fully with the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyspark.plans import catalog as C  # noqa: E402
from tallyspark.plans import kpis, refresh as R  # noqa: E402
from tallyspark.operators import measures as M, quality  # noqa: E402
from tallyspark.session import get_spark, scratch_path  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(results: dict, name: str, fn) -> None:
    t0 = time.perf_counter()
    fn()
    results[name] = round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_spark(f"local[{cpus}]", app="tallyspark-bench", shuffle_partitions=cpus * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    spark.sparkContext.setLogLevel("ERROR")
    results: dict[str, float] = {}

    # Warm-up (JVM, class loading, codegen) on the smallest input: one full
    # refresh and one query; not timed.
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        pw = C._p(spark, warm_dir)
        R.refresh(spark, {"orders": pw.raw_orders, "customers": pw.raw_customers, "products": pw.raw_products},
                  scratch_path(spark, "bench-warmup"), "w")
        run(C.QUERIES["kpi_scorecard"](spark, warm_dir))

    root = scratch_path(spark, "bench")
    p0 = C._p(spark, sf_dir)
    raw = {"orders": p0.raw_orders, "customers": p0.raw_customers, "products": p0.raw_products}
    timed(results, "refresh", lambda: R.refresh(spark, raw, root, "v1"))

    p = R.published_pipeline(spark, root)
    f, dc, dp, dd = p.fact_sales, p.dim_customer, p.dim_product, p.dim_date
    published = {
        "kpi_scorecard": lambda: kpis.kpi_scorecard(f),
        "kpi_monthly_trend": lambda: kpis.kpi_monthly_trend(f, dd),
        "kpi_channel": lambda: kpis.kpi_channel(f),
        "kpi_category": lambda: kpis.kpi_category(f, dp),
        "kpi_top_customers": lambda: kpis.kpi_top_customers(f, dc),
        "kpi_top_products": lambda: kpis.kpi_top_products(f, dp),
        "kpi_country": lambda: kpis.kpi_country(f, dc),
        "kpi_segment": lambda: kpis.kpi_segment(f, dc),
        "kpi_quarterly": lambda: kpis.kpi_quarterly(f, dd),
        "kpi_active_status": lambda: kpis.kpi_active_status(f, dp),
        "kpi_returns_audit": lambda: kpis.kpi_returns_audit(p.stg_orders),
        "measure_calendar_mom": lambda: M.calendar_mom(f),
        "highlights": lambda: M.highlights(f, dc, dp),
        "ref_integrity": lambda: quality.ref_integrity(f, dc, dp, dd),
    }
    for name, build in published.items():
        timed(results, name, lambda b=build: run(b()))

    for name in ("kpi_monthly_trend", "fact_sales", "dq_waterfall", "intake_insert"):
        timed(results, f"e2e_{name}", lambda n=name: run(C.QUERIES[n](spark, sf_dir)))

    total = round(sum(results.values()), 3)
    print(json.dumps({"metric": "total_sec", "value": total, "unit": "sec", "queries": results,
                      "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
