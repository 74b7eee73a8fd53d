"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` is the scale folder, ``BENCH_CPUS`` the number of local cores.
"""

from __future__ import annotations

import json
import os
import time

from brightledger.plans import load
from brightledger.session import build_session
from brightledger.sources.targets import local_shared_folder

HEADLINE = ["click_to_order", "subscription_report", "banner_impressions", "minipage_daily", "message_funnel_delivery", "conversion_path",
            "cart_segments", "cart_funnel", "reset_cohort", "customer_segment_asof", "monthly_active_status", "budget_with_actions",
            "partner_sales", "converted_leads", "spend_union", "ads_cohort_snapshot", "search_query_report", "organic_paid", "review_feed",
            "product_feed"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=str(2 * int(cpus)), spark__driver__memory="16g",
                          spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    local_shared_folder(spark)
    queries = load()[0]
    queries["hourly_activity"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up, not counted
    times = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
