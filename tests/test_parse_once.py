"""Records are parsed once, however the parsed columns are filtered."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from bazaarspark.checks.registry import checks
from bazaarspark.plans.order_payloads import normalize_orders
from bazaarspark.sources.landing import landed

SMALL = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["n8_facebook_ads", "n12_google_ads", "n13_tiktok_ads", "n14_flat_ads"])
def test_ads_of_one_platform(spark, name):
    known = checks()
    name = next(n for n in known if n.startswith(name.split("_")[0] + "_"))
    # Two for the envelope, one for each of four shapes of payload.
    assert plan_of(known[name].run(spark, SMALL)).count("from_json") <= 6


def test_orders_of_one_platform(spark, land):
    good = normalize_orders(land({"platform": "shopee", "data": {}})).good.where(F.col("platform") == "shopee")
    assert plan_of(good).count("from_json") <= 8


def test_filtered_landing(spark, tmp_path):
    rows = [{"platform": p, "extracted_at": f"2024-01-0{d}T00:00:00Z", "data": {"id": d}} for p in "ab" for d in (1, 2, 3)]
    (tmp_path / "x.jsonl").write_text("\n".join(map(json.dumps, rows)))
    found = landed(spark, str(tmp_path), "a", "2024-01-02", "2024-01-02")
    assert [r["payload"] for r in found.collect()] == ['{"id":2}']
    plan = plan_of(found)
    assert plan.count("from_json") <= 2
    assert not any("from_json" in line for line in plan.splitlines() if "Filter" in line)
