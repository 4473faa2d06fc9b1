"""Items and orders in buckets of the order meet without a shuffle."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from bazaarspark.checks.staging import AS_OF, Staging
from bazaarspark.plans.product import enriched_items
from bazaarspark.sources import store

SMALL = "/root/testdata/sf0.001"


def test_the_large_join_of_the_product_mart_needs_no_exchange(spark, tmp_path):
    s, name = Staging(spark, SMALL), f"b_{uuid.uuid4().hex[:8]}"
    store.save_bucketed(s.items, f"{name}_items", f"{tmp_path}/items", "order_id", 4)
    store.save_bucketed(s.orders, f"{name}_orders", f"{tmp_path}/orders", "order_id", 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        no_map = s.sku_map.limit(0)
        plan = lambda i, o: enriched_items(i, o, no_map, AS_OF)._jdf.queryExecution().executedPlan().toString()
        stored = plan(spark.table(f"{name}_items"), spark.table(f"{name}_orders"))
        given = plan(s.items, s.orders)
        by_order = [line for line in stored.splitlines() if "Exchange hashpartitioning(order_id" in line]
        assert not by_order and "Bucketed: true" in stored and "SelectedBucketsCount: 4 out of 4" in stored
        assert [line for line in given.splitlines() if "Exchange hashpartitioning(order_id" in line]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    rows = enriched_items(spark.table(f"{name}_items"), spark.table(f"{name}_orders"), s.sku_map, AS_OF)
    want = enriched_items(s.items, s.orders, s.sku_map, AS_OF)
    totals = lambda df: df.groupBy("order_status").agg(F.count(F.lit(1)), F.round(F.sum("total_price"), 2)).collect()
    assert sorted(totals(rows), key=str) == sorted(totals(want), key=str)
