"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the local cores, BENCH_RUNS the runs per query (the
median counts). Every query runs to its last row into a sink that discards it.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bazaarspark.checks.registry import checks  # noqa: E402
from bazaarspark.session import session  # noqa: E402

HEADLINE = (
    *("m1_daily_performance", "m2_shop_performance", "m3_ads_channel_performance", "m4_campaign_performance"),
    *("m5_product_performance", "m6_simple_alerts", "v1_daily_performance_total", "v6_campaign_trend"),
    *("v8_product_cross_platform", "v10_product_trend", "x1_sales_daily", "x3_customer_segments"),
    *("x5_channel_attribution", "x6b_product_sales_ranked", "l2_rule_evaluation", "q4_growth_rates"),
    *("w5_rank_of_hot_values", "r7_sku_lookup", "k6_keyed_upsert", "n8_facebook_ads", "n16_web_traffic"),
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = session("bench", cpus, int(cpus) if cpus.isdigit() else 8)
    known = checks()
    # The first query of a session pays for class loading; this one is not measured.
    known["q4_growth_rates"].run(spark, folder).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            known[name].run(spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
