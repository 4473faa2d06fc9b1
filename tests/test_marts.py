"""Mart semantics on small hand-made inputs: fan-out, zero denominators, empty inputs, boundaries."""

from __future__ import annotations

import datetime as dt

import pytest

from bazaarspark.checks.staging import AS_OF, Staging
from bazaarspark.plans import alerts, campaign, channel, daily, dashboards, product, shop

SMALL = "/root/testdata/sf0.001"
TODAY = dt.date(2024, 3, 31)
ORDERS = "order_id string, platform string, customer_id string, status string, order_date timestamp, total double, discount double, shipping_fee double, item_count bigint"
ADS = (
    "record_id string, platform string, account_id string, campaign_id string, campaign_name string, adgroup_id string, ad_id string,"
    " campaign_type string, objective string, status string, level string, date date, spend double, impressions bigint, clicks bigint,"
    " reach bigint, conversions bigint, conversion_value double, video_views bigint, likes bigint, comments bigint, shares bigint,"
    " ctr double, cpc double, cpm double"
)


def at(back, hour=0):
    return dt.datetime.combine(TODAY, dt.time()) - dt.timedelta(days=back) + dt.timedelta(hours=hour)


def orders(spark, *rows):
    data = [(f"o{i}", p, c, s, at(b, 1), t, 1.0, 0.0, 1) for i, (p, c, s, b, t) in enumerate(rows)]
    return spark.createDataFrame(data, ORDERS)


def ads(spark, *rows):
    data = [
        (f"r{i}", p, "a", c, c, "g", f"ad{i}", "t", "o", "active", level, TODAY - dt.timedelta(days=b), spend, n, k, None, cv, v, None, None, 1, 1, None, None, None)
        for i, (p, c, level, b, spend, n, k, cv, v) in enumerate(rows)
    ]
    return spark.createDataFrame(data, ADS)


def test_daily_fan_out_and_additive(spark):
    o = orders(spark, ("shopee", "c", "completed", 1, 101.0), ("lazada", "c", "cancelled", 1, 51.0))
    a = ads(spark, ("facebook_ads", "c", "ad", 1, 10.0, 5, 0, 0, 0.0), ("shopee_ads", "c", "ad", 1, 4.0, 5, 1, 1, 2.0), ("line_ads", "c", "ad", 2, 3.0, 0, 0, 0, 0.0))
    rows = daily.daily_performance(o, a, TODAY).collect()
    got = sorted((str(r.date), r.platform, r.total_orders, r.total_ad_spend) for r in rows)
    assert got == [
        ("2024-03-29", "all", 0, 3.0),
        ("2024-03-30", "lazada", 1, 10.0),
        ("2024-03-30", "shopee", 1, 4.0),
        ("2024-03-30", "shopee", 1, 10.0),
    ]
    lazada = next(r for r in rows if r.platform == "lazada")
    assert (lazada.cpa, lazada.avg_order_value, lazada.conversion_rate, lazada.roas) == (None, None, None, 5.0)
    plain = daily.daily_performance(o, a, TODAY, additive=True)
    total = {str(r.date): (r.total_orders, r.total_ad_spend) for r in daily.daily_performance_total(plain).collect()}
    assert total == {"2024-03-29": (0, 3.0), "2024-03-30": (2, 14.0)}


def test_windows_are_instants_for_orders_and_days_for_ads(spark):
    moment = dt.datetime.combine(TODAY, dt.time(12))
    o = spark.createDataFrame(
        [("a", "shopee", "c", "completed", moment - dt.timedelta(days=90), 1.0, 0.0, 0.0, 1),
         ("b", "shopee", "c", "completed", moment - dt.timedelta(days=90, seconds=1), 1.0, 0.0, 0.0, 1)], ORDERS)
    a = ads(spark, ("shopee_ads", "c", "ad", 90, 1.0, 1, 1, 1, 1.0), ("shopee_ads", "c", "ad", 91, 1.0, 1, 1, 1, 1.0))
    row = daily.daily_performance(o, a, moment).collect()
    assert len(row) == 1 and row[0].total_orders == 1 and row[0].total_impressions == 1


def test_bangkok_days(spark):
    o = spark.createDataFrame([("a", "shopee", "c", "completed", at(1, 20), 1.0, 0.0, 0.0, 1)], ORDERS)
    utc, bkk = [daily.orders_by_day(o, TODAY, tz).collect()[0].date for tz in (None, "Asia/Bangkok")]
    assert (bkk - utc).days == 1


def test_shop_growth_and_distinct_customers(spark):
    o = orders(
        spark, ("shopee", "c1", "completed", 3, 221.0), ("shopee", "c1", "cancelled", 5, 1.0), ("shopee", "c2", "pending", 45, 101.0),
        ("shopee", "c1", "completed", 50, 101.0), ("shopee", None, "completed", 200, 1.0), ("lazada", "c1", "completed", 2, 11.0),
        ("lazada", "c1", "completed", 400, 11.0))
    rows = {r.platform: r for r in shop.shop_performance(o, ads(spark, ("tiktok_ads", "c", "ad", 1, 1.0, 1, 1, 1, 1.0)), TODAY).collect()}
    s = rows["shopee"]
    assert (s.orders_30d, s.customers_30d, s.total_customers_all_time, s.total_orders_all_time) == (2, 1, 2, 5)
    assert s.revenue_growth_rate_mom == pytest.approx((222 - 202) / 202) and s.performance_status == "stable"
    assert s.customer_growth_rate_mom == -0.5 and s.ad_spend_30d == 0 and s.roas_30d is None
    # No earlier revenue: growth is unknown, the shop counts as stable; orders of more than a year ago do not count.
    assert rows["lazada"].performance_status == "stable" and rows["lazada"].total_orders_all_time == 1


def test_campaign_classes_levels_and_nulls(spark):
    a = ads(
        spark, ("google_ads", "hi", "ad", 1, 10.0, 100, 10, 1, 90.0), ("google_ads", "lo", "adset", 1, 10.0, 100, 10, 0, 1.0),
        ("google_ads", "mid", "campaign", 1, 10.0, 100, 0, 1, 40.0), ("google_ads", "skip", "keyword", 1, 10.0, 1, 1, 1, 1.0),
        ("google_ads", "free", "ad", 1, 0.0, 0, 0, 0, 0.0))
    rows = {r.campaign_id: r for r in campaign.campaign_performance(a, TODAY).collect()}
    assert set(rows) == {"hi", "lo", "mid", "free"}
    assert {k: r.performance_status for k, r in rows.items()} == {
        "hi": "top_performer", "lo": "underperforming", "mid": "learning", "free": "learning"}
    # likes are missing, so engagement is unknown rather than a partial sum.
    assert rows["hi"].total_engagement is None and rows["mid"].cpc is None and rows["free"].roas is None


def test_empty_inputs_give_empty_marts(spark):
    o, a = orders(spark), ads(spark)
    web = Staging(spark, SMALL).sessions.limit(0)
    m1, m4 = daily.daily_performance(o, a, TODAY), campaign.campaign_performance(a, TODAY)
    assert m1.count() == 0 and m4.count() == 0
    assert shop.shop_performance(o, a, TODAY).count() == 0
    assert channel.ads_channel_performance(a, web, web, TODAY).count() == 0
    assert alerts.simple_alerts(m1, m4, TODAY).count() == 0


def test_totals_are_sums_of_parts(spark):
    s = Staging(spark, SMALL)
    mart = daily.daily_performance(s.orders, s.ads, AS_OF, additive=True)
    total = mart.groupBy().sum("total_orders", "total_ad_spend").collect()[0]
    recent_orders = s.orders.where(f"order_date >= timestamp'{AS_OF - dt.timedelta(days=90)}'").count()
    spend = s.ads.where(f"date between date'{AS_OF - dt.timedelta(days=90)}' and date'{AS_OF}'").groupBy().sum("spend").collect()[0][0]
    assert total[0] == recent_orders and total[1] == pytest.approx(spend)


def test_product_fan_out_multiplies_only_when_asked(spark):
    s = Staging(spark, SMALL)
    build = lambda fan: product.product_performance(s.items, s.orders, s.products, s.sku_map, AS_OF, fan_out=fan)
    units = lambda df: df.groupBy().sum("units_sold").collect()[0][0]
    sold = s.items.where(f"order_date >= timestamp'{AS_OF - dt.timedelta(days=90)}'").groupBy().sum("quantity").collect()[0][0]
    assert units(build(False)) == sold


def test_filters_reach_the_scan(spark, tmp_path):
    s = Staging(spark, SMALL)
    path = str(tmp_path / "ads")
    s.ads.write.partitionBy("date").parquet(path)
    plan = campaign.campaign_days(spark.read.parquet(path), AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and ">= 2001-05-03" in plan
    assert "video_views" in plan and "record_id" not in plan
    with pytest.raises(ValueError):
        dashboards.apply_filters(s.ads, nothing="x")


def test_alert_ids_repeat_and_limits(spark):
    s = Staging(spark, SMALL)
    build = lambda: alerts.simple_alerts(daily.daily_performance(s.orders, s.ads, AS_OF), campaign.campaign_performance(s.ads, AS_OF), AS_OF)
    assert {r.alert_id for r in build().collect()} == {r.alert_id for r in build().collect()}
    assert alerts.active_alerts(build(), limit=1).count() <= 1
