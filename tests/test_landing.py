"""Landed files: platform and day range, CSV exports, orphan details."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from bazaarspark.plans.order_payloads import normalize_orders
from bazaarspark.sources import landing


def test_landed_files_by_platform_and_day(spark, tmp_path):
    for day in (1, 2, 3):
        with open(tmp_path / f"orders-{day}.jsonl", "w") as f:
            for n, platform in enumerate(("shopee", "lazada")):
                data = {"order_sn": f"{day}-{n}", "create_time": 86_400 * day, "total_amount": day}
                f.write(json.dumps({"platform": platform, "extracted_at": f"2021-05-0{day}T08:00:00Z", "data": data}) + "\n")
            f.write("{broken\n")
    path = f"{tmp_path}/*.jsonl"
    assert landing.landed(spark, path).count() == 9
    assert landing.landed(spark, path).where("malformed").count() == 3
    some = landing.landed(spark, path, "shopee", "2021-05-02", "2021-05-03")
    assert {r.order_id for r in normalize_orders(some).good.collect()} == {"shopee_2-0", "shopee_3-0"}
    assert landing.landed(spark, path, first_day="2021-05-03").count() == 2
    assert landing.landed(spark, path, last_day="2021-05-01").count() == 2


def test_csv_report(spark, tmp_path):
    (tmp_path / "report.csv").write_text('campaign,spend,day\n"a, b",1.5,2021-05-03\nc,,2021-05-04\n')
    rows = landing.csv_report(spark, str(tmp_path / "report.csv"), "campaign string, spend double, day date").orderBy("campaign").collect()
    assert [(r.campaign, r.spend, str(r.day)) for r in rows] == [("a, b", 1.5, "2021-05-03"), ("c", None, "2021-05-04")]


def test_details_without_an_order_are_left_out(spark):
    orders = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    details = spark.createDataFrame([(1, "b"), (1, "a"), (None, "x"), (None, "y")], "order int, item string")
    found = landing.stitch_details(orders, details, "id", "order", "item")
    assert {(r.id, tuple(r["items"])) for r in found.collect()} == {(1, ("a", "b")), (2, ()), (None, ())}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(order" in plan


def test_breakdowns_and_status(spark):
    df = spark.createDataFrame([("a", 1, "active"), ("b", 2, "paused")], "device string, n int, status string")
    assert landing.breakdowns(df, ["device", "age"]).columns == ["device"]
    assert landing.with_status(df, ["paused"]).select(F.sum("n")).first()[0] == 2
