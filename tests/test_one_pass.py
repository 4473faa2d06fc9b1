"""Records are built and parsed once; rows that become many are dealt out."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bazaarspark.checks import detection, payloads
from bazaarspark.checks.staging import AS_OF, Staging
from bazaarspark.plans import product


@pytest.fixture
def lines(spark, tmp_path):
    i = F.col("id")
    spark.range(120).select(
        *[i.alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (i % 11).alias("l_partkey"), (i % 48).alias("l_suppkey")],
        *[F.lit(dt.datetime(2000, 5, 1)).alias("l_shipdate"), F.lit(20.0).alias("l_quantity"), F.lit(0.05).alias("l_tax")],
        F.lit(900.5).alias("l_extendedprice"),
    ).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return Staging(spark, str(tmp_path))


def scans(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_levels_of_google_reports_take_one_pass(lines):
    found = payloads.google_levels(lines)
    assert scans(found) == 1
    got = {(r.level, r.campaign_id): (r.rows, r.parts) for r in found.collect()}
    assert got[("campaign", "1")] == (3, "campaign") and got[("keyword", "19")] == (3, "campaign,adGroup,adGroupCriterion")
    assert sum(rows for rows, _ in got.values()) == 20


def test_good_and_dead_unnamed_ads_take_one_pass(lines):
    found = detection.unnamed_ads(lines)
    assert scans(found) == 1
    got = {(r.platform, r.outcome): (r.records, r.clicks) for r in found.collect()}
    assert got[("unknown", "UnknownPlatform")] == (30, 0) and got[("google_ads", "good")] == (30, 30)


def test_a_fanned_out_mart_is_dealt_over_tasks(spark):
    s = Staging(spark, "/root/testdata/sf0.001")
    mart = product.product_performance(s.items, s.orders, s.products, s.sku_map, AS_OF, fan_out=True)
    assert mart.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
