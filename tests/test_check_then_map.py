"""Records are checked before they are mapped, without functions that no code is generated for."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bazaarspark.operators.quality import problem
from bazaarspark.plans.ads_payloads import mapped_ads, normalize_ads

ADS = [
    {"platform": "facebook_ads", "type": "insight", "data": {"campaign_id": "1", "date_start": "2024-01-02", "spend": "2"}},
    {"platform": "tiktok_ads", "data": {"dimensions": {"stat_time_day": "soon"}, "metrics": {"spend": "NaN", "clicks": "1,000"}}},
    {"platform": "google_ads", "date": "2024-01-03", "data": {"metrics": {"clicks": "1e19", "conversions": "1e300"}}},
    {"platform": "line_ads", "date": "2024-01-04", "data": {"date": "", "clicks": 3}},
    {"platform": "other", "data": {"clicks": 3}},
]

@pytest.fixture
def long_plans(spark):
    name = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(name)
    spark.conf.set(name, "1000")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(name, before)


def test_dead_ads_are_not_mapped(land, long_plans):
    parts = normalize_ads(land(*ADS))
    assert "spend_raw" in long_plans(parts.good)
    assert "spend_raw" not in long_plans(parts.dead)


def test_checked_and_mapped_ads_add_up(land):
    raw = land(*ADS)
    parts, every = normalize_ads(raw), mapped_ads(raw).collect()
    dead = sorted((r.record, r.error_type, r.error) for r in parts.dead.collect())
    assert len(every) == len(ADS)
    assert dead == sorted((r.record, r._problem.error_type, r._problem.error) for r in every if r._problem is not None)
    assert parts.good.count() == len(ADS) - len(dead)


def test_problems_of_ads(land):
    ads = {r.source_platform: (r.error_type, r.error) for r in normalize_ads(land(*ADS)).dead.collect()}
    assert ads == {
        "tiktok_ads": ("ValidationError", "date is missing or unreadable; a metric is not a number"),
        "google_ads": ("ValueError", "a metric is not a number"),
        "other": ("UnknownPlatform", "platform is unknown"),
    }


def test_problems_need_no_higher_order_function(spark, long_plans):
    df = spark.createDataFrame([(1, True, None), (2, True, True), (3, False, None)], "id int, a boolean, b boolean")
    found = df.select("id", problem((F.col("a"), "A", "first"), (F.col("b"), "B", "second")).alias("p"))
    assert "lambda" not in long_plans(found)
    assert [r.p and tuple(r.p) for r in found.orderBy("id").collect()] == [("A", "first"), ("A", "first; second"), None]
