"""Registered marts, views and alerts."""

from __future__ import annotations

import datetime as dt

from bazaarspark.checks.framework import Check, fields_of, shaped
from bazaarspark.checks.sql_staging import AS_OF as SQL_AS_OF
from bazaarspark.checks.sql_staging import using
from bazaarspark.checks.staging import AS_OF, Staging
from bazaarspark.plans import alerts, campaign, channel, daily, product, shop
from pyspark.sql import functions as F

DAILY_MEASURES = (
    "l total_orders completed_orders cancelled_orders pending_orders; m gross_revenue net_revenue total_discount"
    " total_shipping_fee; l total_items_sold unique_customers; m total_ad_spend; l total_impressions total_clicks"
    " total_conversions; m total_conversion_value; r avg_ctr; m avg_cpc avg_cpm; r roas; m cpa avg_order_value;"
    " r order_completion_rate conversion_rate"
)
SHOP_COLUMNS = (
    "d snapshot_date; s platform; l orders_30d; m revenue_30d net_revenue_30d; l customers_30d items_sold_30d orders_7d;"
    " m revenue_7d; l orders_prev_7d; m revenue_prev_7d; l completed_orders_30d cancelled_orders_30d pending_orders_30d"
    " total_orders_all_time; m total_revenue_all_time; l total_customers_all_time; d first_order_date last_order_date;"
    " m ad_spend_30d ad_spend_prev_30d; l impressions_30d clicks_30d conversions_30d; r order_growth_rate_mom"
    " revenue_growth_rate_mom net_revenue_growth_rate_mom customer_growth_rate_mom order_growth_rate_wow"
    " revenue_growth_rate_wow ad_spend_growth_rate_mom roas_30d; m cpa_30d aov_30d; r completion_rate_30d"
    " cancellation_rate_30d; s performance_status"
)
CHANNEL_COLUMNS = (
    "d date; s platform; m spend; l impressions reach clicks; r ctr; m cpc cpm; l platform_conversions;"
    " m platform_conversion_value cost_per_conversion; r platform_roas; l video_views likes comments shares"
    " total_engagement; r engagement_rate; l active_campaigns active_ads ga4_sessions ga4_users ga4_new_users;"
    " r ga4_bounce_rate; m ga4_avg_session_duration; l ga4_transactions; m ga4_revenue; r ga4_conversion_rate ga4_roas;"
    " m cost_per_session cost_per_acquisition cost_per_user revenue_per_user"
)
CAMPAIGN_COLUMNS = (
    "d date; s platform account_id campaign_id campaign_name campaign_type objective status; m spend;"
    " l impressions reach clicks; r ctr; m cpc cpm; l conversions; m conversion_value cost_per_conversion;"
    " r conversion_rate roas; l video_views; r video_view_rate; l likes comments shares total_engagement;"
    " r engagement_rate; l active_adgroups active_ads; r ctr_vs_benchmark; m cpc_vs_benchmark; r roas_vs_benchmark;"
    " d first_active_date last_active_date; l days_active; m spend_7d spend_prev_7d; r spend_change_wow;"
    " m conv_value_7d conv_value_prev_7d; r conv_value_change_wow; s performance_status optimization_flag"
)
PRODUCT_COLUMNS = (
    "d date; s master_sku platform product_name variation canonical_name category brand; m current_price; b is_active;"
    " l units_sold; m gross_revenue net_revenue total_discount; l order_count units_completed; m revenue_completed;"
    " l units_cancelled; m avg_unit_price avg_quantity_per_order avg_order_value; r discount_rate; l units_7d"
    " units_prev_7d; r units_growth_wow; l units_30d units_prev_30d; r units_growth_mom; m revenue_30d revenue_prev_30d;"
    " r revenue_growth_mom cancellation_rate completion_rate"
)
ALERT_COLUMNS = (
    "s alert_type severity title message metric_name; r metric_value; r threshold; s platform entity_type entity_id"
    " entity_name; d alert_date"
)


def m5b(s: Staging):
    """Sales and products are shaped before they meet: rounding the same sale again for each product is most of the work."""
    fields = fields_of(PRODUCT_COLUMNS)
    some = lambda df: shaped(df, [f for f in fields if f[0] in df.columns])
    return product.product_performance(s.items, s.orders, s.products, s.sku_map, AS_OF, fan_out=True, formed=some)


def m1(s: Staging):
    return daily.daily_performance(s.orders, s.ads, AS_OF)


def m2(s: Staging):
    return shop.shop_performance(s.orders, s.ads, AS_OF)


def m3(s: Staging):
    return channel.ads_channel_performance(s.ads, s.sessions, s.traffic, AS_OF)


def m4(s: Staging):
    return campaign.campaign_performance(s.ads, AS_OF, materialize=True)


def m5(s: Staging):
    return product.product_performance(s.items, s.orders, s.products, s.sku_map, AS_OF, materialize=True)


def m6(s: Staging):
    return alerts.simple_alerts(m1(s), m4(s), AS_OF, materialize=True)


# The marts as of a day in the middle of the data: later rows are there and must not count.
PAST, SQL_PAST = dt.date(2000, 6, 30), "DATE '2000-06-30'"


def as_of_past(name: str, columns: str, build, mart: str) -> Check:
    sql = (using(mart) + f"SELECT * FROM {mart}").replace(SQL_AS_OF, SQL_PAST)
    return Check(name, columns, build, sql)


RECENT = f"date >= {SQL_AS_OF} - 30 AND date <= {SQL_AS_OF}"

CHECKS = [
    Check("m1_daily_performance", f"d date; s platform; {DAILY_MEASURES}", m1, using("daily_mart") + "SELECT * FROM daily_mart"),
    Check(
        "m1b_daily_performance_additive",
        f"d date; s platform; {DAILY_MEASURES}",
        lambda s: daily.daily_performance(s.orders, s.ads, AS_OF, additive=True),
        using("daily_additive") + "SELECT * FROM daily_additive",
    ),
    Check("m2_shop_performance", SHOP_COLUMNS, m2, using("shop_mart") + "SELECT * FROM shop_mart"),
    Check("m3_ads_channel_performance", CHANNEL_COLUMNS, m3, using("channel_mart") + "SELECT * FROM channel_mart"),
    Check(
        "m3b_ads_channel_web_conversions",
        CHANNEL_COLUMNS,
        lambda s: channel.ads_channel_performance(s.ads, s.sessions, s.traffic, AS_OF, web_only_conversions=True),
        using("channel_filled") + "SELECT * FROM channel_filled",
    ),
    Check("m4_campaign_performance", CAMPAIGN_COLUMNS, m4, using("campaign_mart") + "SELECT * FROM campaign_mart"),
    Check("m5_product_performance", PRODUCT_COLUMNS, m5, using("product_mart") + "SELECT * FROM product_mart"),
    Check(
        "m5b_product_performance_fan_out",
        PRODUCT_COLUMNS,
        m5b,
        using("product_fanned") + "SELECT * FROM product_fanned",
        formed=True,
    ),
    as_of_past(
        "m1c_daily_performance_past", f"d date; s platform; {DAILY_MEASURES}",
        lambda s: daily.daily_performance(s.orders, s.ads, PAST), "daily_mart",
    ),
    as_of_past("m2c_shop_performance_past", SHOP_COLUMNS, lambda s: shop.shop_performance(s.orders, s.ads, PAST), "shop_mart"),
    as_of_past(
        "m3c_ads_channel_past", CHANNEL_COLUMNS,
        lambda s: channel.ads_channel_performance(s.ads, s.sessions, s.traffic, PAST), "channel_mart",
    ),
    as_of_past("m4c_campaign_past", CAMPAIGN_COLUMNS, lambda s: campaign.campaign_performance(s.ads, PAST), "campaign_mart"),
    as_of_past(
        "m5c_product_past", PRODUCT_COLUMNS,
        lambda s: product.product_performance(s.items, s.orders, s.products, s.sku_map, PAST), "product_mart",
    ),
    Check(
        "m6_simple_alerts",
        ALERT_COLUMNS + "; s status alert_id created_at; m net_revenue total_ad_spend cpa",
        lambda s: m6(s).withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss")).select("*", "context.*"),
        using("alerts")
        + """SELECT *, 'active' AS status, '2001-08-01 00:00:00' AS created_at,
  sha256(concat_ws('|', alert_type, platform, entity_type, entity_id, CAST(alert_date AS DATE))) AS alert_id FROM alerts""",
    ),
    Check(
        "v1_daily_performance_total",
        f"d date; s platform; {DAILY_MEASURES}",
        lambda s: daily.daily_performance_total(m1(s)),
        using("daily_mart")
        + """
SELECT *, 'all' AS platform, total_clicks / nullif(total_impressions, 0) AS avg_ctr,
  total_ad_spend / nullif(total_clicks, 0) AS avg_cpc, 1000 * total_ad_spend / nullif(total_impressions, 0) AS avg_cpm,
  net_revenue / nullif(total_ad_spend, 0) AS roas, total_ad_spend / nullif(completed_orders, 0) AS cpa,
  net_revenue / nullif(completed_orders, 0) AS avg_order_value,
  completed_orders / nullif(total_orders, 0) AS order_completion_rate,
  total_conversions / nullif(total_clicks, 0) AS conversion_rate
FROM (SELECT date, sum(total_orders) AS total_orders, sum(completed_orders) AS completed_orders,
  sum(cancelled_orders) AS cancelled_orders, sum(pending_orders) AS pending_orders, sum(gross_revenue) AS gross_revenue,
  sum(net_revenue) AS net_revenue, sum(total_discount) AS total_discount, sum(total_shipping_fee) AS total_shipping_fee,
  sum(total_items_sold) AS total_items_sold, sum(unique_customers) AS unique_customers,
  sum(total_ad_spend) AS total_ad_spend, sum(total_impressions) AS total_impressions, sum(total_clicks) AS total_clicks,
  sum(total_conversions) AS total_conversions, sum(total_conversion_value) AS total_conversion_value
  FROM daily_mart GROUP BY date)""",
    ),
    Check(
        "v2_shop_performance_total",
        "d snapshot_date; s platform; l orders_30d; m revenue_30d net_revenue_30d; l customers_30d items_sold_30d"
        " orders_7d; m revenue_7d; l total_orders_all_time; m total_revenue_all_time ad_spend_30d; r roas_30d;"
        " m cpa_30d aov_30d",
        lambda s: shop.shop_performance_total(m2(s)),
        using("shop_mart")
        + """
SELECT snapshot_date, 'all' AS platform, sum(orders_30d) AS orders_30d, sum(revenue_30d) AS revenue_30d,
  sum(net_revenue_30d) AS net_revenue_30d, sum(customers_30d) AS customers_30d, sum(items_sold_30d) AS items_sold_30d,
  sum(orders_7d) AS orders_7d, sum(revenue_7d) AS revenue_7d, sum(total_orders_all_time) AS total_orders_all_time,
  sum(total_revenue_all_time) AS total_revenue_all_time, sum(ad_spend_30d) AS ad_spend_30d,
  sum(net_revenue_30d) / nullif(sum(ad_spend_30d), 0) AS roas_30d,
  sum(ad_spend_30d) / nullif(sum(completed_orders_30d), 0) AS cpa_30d,
  sum(net_revenue_30d) / nullif(sum(orders_30d), 0) AS aov_30d
FROM shop_mart GROUP BY snapshot_date""",
    ),
    Check(
        "v3_ads_channel_summary",
        "s platform; m total_spend; l total_impressions total_clicks total_conversions; m total_conversion_value;"
        " r avg_ctr; m avg_cpc avg_cpm; r avg_roas; m avg_cost_per_conversion; l total_ga4_sessions"
        " total_ga4_transactions; m total_ga4_revenue; r avg_ga4_roas",
        lambda s: channel.ads_channel_summary(m3(s), AS_OF),
        using("channel_mart")
        + f"""
SELECT platform, sum(spend) AS total_spend, sum(impressions) AS total_impressions, sum(clicks) AS total_clicks,
  sum(platform_conversions) AS total_conversions, sum(platform_conversion_value) AS total_conversion_value,
  sum(clicks) / nullif(sum(impressions), 0) AS avg_ctr, sum(spend) / nullif(sum(clicks), 0) AS avg_cpc,
  1000 * sum(spend) / nullif(sum(impressions), 0) AS avg_cpm,
  sum(platform_conversion_value) / nullif(sum(spend), 0) AS avg_roas,
  sum(spend) / nullif(sum(platform_conversions), 0) AS avg_cost_per_conversion,
  sum(ga4_sessions) AS total_ga4_sessions, sum(ga4_transactions) AS total_ga4_transactions,
  sum(ga4_revenue) AS total_ga4_revenue, sum(ga4_revenue) / nullif(sum(spend), 0) AS avg_ga4_roas
FROM channel_mart WHERE {RECENT} GROUP BY platform""",
    ),
    Check(
        "v4_ads_channel_trend",
        "d date; s platform; m spend; l impressions clicks platform_conversions; m platform_conversion_value; r ctr;"
        " m cpc cpm; r platform_roas; l ga4_sessions ga4_transactions; m ga4_revenue; r ga4_roas;"
        " m mtd_spend mtd_conversion_value",
        lambda s: channel.ads_channel_trend(m3(s), AS_OF),
        using("channel_mart")
        + f"""
SELECT *, sum(spend) OVER month AS mtd_spend, sum(platform_conversion_value) OVER month AS mtd_conversion_value
FROM channel_mart WHERE date >= {SQL_AS_OF} - 90 AND date <= {SQL_AS_OF}
WINDOW month AS (PARTITION BY platform, date_trunc('month', date) ORDER BY date)""",
    ),
    Check(
        "v5_campaign_summary",
        CAMPAIGN_COLUMNS,
        lambda s: campaign.campaign_summary(m4(s)),
        using("campaign_mart")
        + "SELECT * FROM campaign_mart QUALIFY rank() OVER (PARTITION BY platform, campaign_id ORDER BY date DESC) = 1",
    ),
    Check(
        "v6_campaign_trend",
        "d date; s platform campaign_id campaign_name; m spend; l conversions; m conversion_value; r roas;"
        " s performance_status; m spend_7d_rolling conv_value_7d_rolling; r roas_7d_rolling",
        lambda s: campaign.campaign_trend(m4(s), AS_OF),
        using("campaign_mart")
        + f"""
SELECT *, sum(spend) OVER w AS spend_7d_rolling, sum(conversion_value) OVER w AS conv_value_7d_rolling,
  avg(roas) OVER w AS roas_7d_rolling FROM campaign_mart WHERE {RECENT}
WINDOW w AS (PARTITION BY platform, campaign_id
  ORDER BY date, account_id NULLS FIRST, campaign_name NULLS FIRST, campaign_type NULLS FIRST, objective NULLS FIRST,
    status NULLS FIRST ROWS 6 PRECEDING)""",
    ),
    Check(
        "v6b_campaign_trend_calendar",
        "d date; s platform campaign_id; m spend spend_7d_rolling conv_value_7d_rolling; r roas_7d_rolling",
        lambda s: campaign.campaign_trend(m4(s), AS_OF, calendar_days=True),
        using("campaign_mart")
        + f"""
SELECT *, sum(spend) OVER w AS spend_7d_rolling, sum(conversion_value) OVER w AS conv_value_7d_rolling,
  avg(roas) OVER w AS roas_7d_rolling FROM campaign_mart WHERE {RECENT}
WINDOW w AS (PARTITION BY platform, campaign_id ORDER BY date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW)""",
    ),
    Check(
        "v7_top_campaigns",
        "s platform campaign_id campaign_name; m total_spend total_conversion_value; r avg_roas; l total_conversions;"
        " m avg_cpa; s latest_status",
        lambda s: campaign.top_campaigns(m4(s), AS_OF),
        using("campaign_mart")
        + f"""
SELECT platform, campaign_id, campaign_name, sum(spend) AS total_spend, sum(conversion_value) AS total_conversion_value,
  sum(conversion_value) / nullif(sum(spend), 0) AS avg_roas, sum(conversions) AS total_conversions,
  sum(spend) / nullif(sum(conversions), 0) AS avg_cpa,
  last(performance_status ORDER BY date, performance_status) AS latest_status
FROM campaign_mart WHERE {RECENT} GROUP BY ALL HAVING sum(spend) > 0
ORDER BY round(total_conversion_value, 4) DESC, platform, campaign_id, campaign_name LIMIT 50""",
    ),
    Check(
        "v7b_top_campaigns_alphabetical_status",
        "s platform campaign_id; m total_conversion_value; s latest_status",
        lambda s: campaign.top_campaigns(m4(s), AS_OF, alphabetical_status=True),
        using("campaign_mart")
        + f"""
SELECT platform, campaign_id, sum(conversion_value) AS total_conversion_value, max(performance_status) AS latest_status
FROM campaign_mart WHERE {RECENT} GROUP BY platform, campaign_id, campaign_name HAVING sum(spend) > 0
ORDER BY round(total_conversion_value, 4) DESC, platform, campaign_id, campaign_name LIMIT 50""",
    ),
    Check(
        "v8_product_cross_platform",
        "s master_sku product_name category brand platforms; l platform_count total_units_30d; m total_revenue_30d;"
        " l shopee_units_30d lazada_units_30d tiktok_units_30d; m shopee_revenue_30d lazada_revenue_30d"
        " tiktok_revenue_30d; r avg_units_growth_mom avg_revenue_growth_mom",
        lambda s: product.product_cross_platform(m5(s)).withColumn("platforms", F.array_join("platforms", ",")),
        using("product_mart")
        + """
SELECT master_sku, min(canonical_name) AS product_name, min(category) AS category, min(brand) AS brand,
  string_agg(DISTINCT platform, ',' ORDER BY platform) AS platforms, count(DISTINCT platform) AS platform_count,
  sum(units_30d) AS total_units_30d, sum(revenue_30d) AS total_revenue_30d,
  coalesce(sum(units_30d) FILTER (platform = 'shopee'), 0) AS shopee_units_30d,
  coalesce(sum(units_30d) FILTER (platform = 'lazada'), 0) AS lazada_units_30d,
  coalesce(sum(units_30d) FILTER (platform = 'tiktok_shop'), 0) AS tiktok_units_30d,
  coalesce(sum(revenue_30d) FILTER (platform = 'shopee'), 0) AS shopee_revenue_30d,
  coalesce(sum(revenue_30d) FILTER (platform = 'lazada'), 0) AS lazada_revenue_30d,
  coalesce(sum(revenue_30d) FILTER (platform = 'tiktok_shop'), 0) AS tiktok_revenue_30d,
  avg(units_growth_mom) AS avg_units_growth_mom, avg(revenue_growth_mom) AS avg_revenue_growth_mom
FROM product_mart WHERE date = (SELECT max(date) FROM product_mart) GROUP BY master_sku""",
    ),
    Check(
        "v9_top_products",
        "s master_sku platform product_name category brand; l total_units; m total_revenue avg_price;"
        " r avg_discount_rate avg_completion_rate latest_growth_wow latest_growth_mom",
        lambda s: product.top_products(m5(s), AS_OF),
        using("product_mart")
        + f"""
SELECT master_sku, platform, product_name, category, brand, sum(units_sold) AS total_units,
  sum(net_revenue) AS total_revenue, avg(avg_unit_price) AS avg_price, avg(discount_rate) AS avg_discount_rate,
  avg(completion_rate) AS avg_completion_rate, max(units_growth_wow) AS latest_growth_wow,
  max(units_growth_mom) AS latest_growth_mom
FROM product_mart WHERE {RECENT} GROUP BY ALL
ORDER BY round(total_revenue, 4) DESC, master_sku, platform, product_name, category, brand LIMIT 100""",
    ),
    Check(
        "v10_product_trend",
        "d date; s master_sku platform product_name; l units_sold; m net_revenue; l units_7d_rolling;"
        " m revenue_7d_rolling",
        lambda s: product.product_trend(m5(s), AS_OF),
        using("product_mart")
        + f"""
SELECT *, sum(units_sold) OVER w AS units_7d_rolling, sum(net_revenue) OVER w AS revenue_7d_rolling
FROM product_mart WHERE date >= {SQL_AS_OF} - 60 AND date <= {SQL_AS_OF}
WINDOW w AS (PARTITION BY master_sku, platform
  ORDER BY date, product_name NULLS FIRST, variation NULLS FIRST ROWS 6 PRECEDING)""",
    ),
    Check(
        "v11_category_performance",
        "s category platform; l product_count total_units_30d; m total_revenue_30d avg_price; r avg_discount_rate"
        " avg_completion_rate avg_growth_mom",
        lambda s: product.category_performance(m5(s)),
        using("product_mart")
        + """
SELECT category, platform, count(DISTINCT master_sku) AS product_count, sum(units_30d) AS total_units_30d,
  sum(revenue_30d) AS total_revenue_30d, avg(avg_unit_price) AS avg_price, avg(discount_rate) AS avg_discount_rate,
  avg(completion_rate) AS avg_completion_rate, avg(units_growth_mom) AS avg_growth_mom
FROM product_mart WHERE category IS NOT NULL AND date = (SELECT max(date) FROM product_mart) GROUP BY ALL""",
    ),
    Check(
        "v12_active_alerts",
        "s alert_type severity title message metric_name; m metric_value; r threshold; s platform entity_type entity_id"
        " entity_name; d alert_date; s status",
        lambda s: alerts.active_alerts(m6(s)),
        using("alerts") + "SELECT * REPLACE (round(metric_value, 2) AS metric_value), 'active' AS status FROM alerts",
    ),
    Check(
        "v13_alert_summary",
        "s alert_type severity; l alert_count platforms_affected entities_affected; d earliest_alert latest_alert",
        lambda s: alerts.alert_summary(m6(s), AS_OF),
        using("alerts")
        + f"""
SELECT alert_type, severity, count(*) AS alert_count, count(DISTINCT platform) AS platforms_affected,
  count(DISTINCT entity_id) AS entities_affected, min(alert_date) AS earliest_alert, max(alert_date) AS latest_alert
FROM alerts WHERE alert_date >= {SQL_AS_OF} - 7 AND alert_date <= {SQL_AS_OF} GROUP BY ALL""",
    ),
    Check(
        "v14_platform_alert_health",
        "s platform; l critical_alerts warning_alerts info_alerts total_alerts health_score",
        lambda s: alerts.platform_alert_health(m6(s), AS_OF),
        using("alerts")
        + f"""
SELECT *, greatest(0, 100 - 20 * critical_alerts - 5 * warning_alerts - info_alerts) AS health_score FROM (
  SELECT platform, count(*) FILTER (severity = 'critical') AS critical_alerts,
    count(*) FILTER (severity = 'warning') AS warning_alerts, count(*) FILTER (severity = 'info') AS info_alerts,
    count(*) AS total_alerts FROM alerts WHERE alert_date >= {SQL_AS_OF} - 7 AND alert_date <= {SQL_AS_OF} GROUP BY platform)""",
    ),
    Check(
        "v15_alert_trend",
        "d alert_date; s alert_type severity; l alert_count",
        lambda s: alerts.alert_trend(m6(s), AS_OF),
        using("alerts")
        + f"""SELECT alert_date, alert_type, severity, count(*) AS alert_count FROM alerts
WHERE alert_date >= {SQL_AS_OF} - 30 AND alert_date <= {SQL_AS_OF} GROUP BY ALL""",
    ),
    Check(
        "l6_alert_counts",
        "l critical warning info total; d as_of",
        lambda s: alerts.alert_counts(m6(s), AS_OF),
        using("alerts")
        + f"""SELECT count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'warning') AS warning,
  count(*) FILTER (severity = 'info') AS info, count(*) AS total, {SQL_AS_OF} AS as_of
FROM alerts WHERE alert_date >= {SQL_AS_OF} - 1 AND alert_date <= {SQL_AS_OF}""",
    ),
    Check(
        "s12_active_alerts_lookup",
        "s alert_type severity platform entity_id; m metric_value",
        lambda s: alerts.active_alerts(m6(s), severity="critical", platform="shopee", limit=100),
        using("alerts")
        + """SELECT *, round(metric_value, 2) AS metric_value FROM (SELECT * EXCLUDE (metric_value), metric_value FROM alerts)
WHERE severity = 'critical' AND platform = 'shopee' LIMIT 100""".replace(
            "SELECT *, round(metric_value, 2) AS metric_value FROM (SELECT * EXCLUDE (metric_value), metric_value FROM alerts)",
            "SELECT * REPLACE (round(metric_value, 2) AS metric_value) FROM alerts",
        ),
    ),
]
