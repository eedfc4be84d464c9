"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]
and print one JSON line with per-query seconds (full result materialised with
a no-op write, so every stage runs)."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from marketlens.plans import catalog  # noqa: E402
from marketlens.session import get_session  # noqa: E402

HEADLINE = [
    "q07_monthly_orders_revenue", "q09_price_revenue_by_state", "q16_top_categories_by_revenue",
    "c01_label_churn", "c11_rfm", "c17_clv_rfm", "m01_campaign_sales", "b03_stock_ledger",
    "i07_eoq_rop", "i10_holding_cost_actual", "p03_elasticity", "p07_merge_market",
    "o04_priority_score", "r02_clean_reviews", "r08_top_ngrams",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", int(cpus) * 2,
                        extra={"spark.driver.memory": "20g", "spark.sql.files.maxPartitionBytes": "128m"})
    qs = catalog.queries()
    times = {}
    for name in HEADLINE:
        t0 = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
