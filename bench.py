"""Benchmark: the ETL stage and headline analytic queries.

Runs at $BENCH_SF_DIR (default /root/testdata/sf0.1) on local[$BENCH_CPUS]
and prints one JSON line.  Every query is forced in full with a no-op write
(all partitions computed, nothing collected to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwise.plans import catalog  # noqa: E402
from tillwise.plans.warehouse import Warehouse  # noqa: E402
from tillwise.session import local_session  # noqa: E402

HEADLINE = (
    "kpi_category_sales", "sales_monthly", "kpi_daily_summary", "top_products_revenue", "transaction_records",
    "bundle_rules", "frequent_itemsets", "elasticity", "price_recommendation", "series_product",
    "bundle_forecast", "revenue_impact",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    os.environ.setdefault("TILLWISE_SCRATCH", tempfile.mkdtemp(prefix="bench-", dir="/tmp"))
    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="tillwise-bench")
    spark.range(1000).selectExpr("sum(id)").collect()  # JVM / codegen warm-up, not timed
    times: dict[str, float] = {}
    t0 = time.time()
    Warehouse.open(spark, sf_dir)
    times["etl"] = round(time.time() - t0, 3)
    for name in HEADLINE:
        t = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)
    total = round(sum(times.values()), 3)
    fact_rows = Warehouse.open(spark, sf_dir).fact.count()
    print(json.dumps({
        "metric": "pipeline_total_sec", "value": total, "unit": "sec", "queries": times, "sf": sf,
        "fact_rows": fact_rows, "etl_rows_per_sec": round(fact_rows / times["etl"], 1) if times["etl"] else None,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
