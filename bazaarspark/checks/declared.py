"""Registered declared marts, report queries and rule evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarspark.checks.framework import Check
from bazaarspark.checks.marts import m2, m5
from bazaarspark.checks.sql_staging import AS_OF as D
from bazaarspark.checks.sql_staging import CHANNEL, using
from bazaarspark.checks.staging import AS_OF, Staging
from bazaarspark.operators import rules
from bazaarspark.plans import daily, dashboards, extended, metrics


def additive(s: Staging):
    return daily.daily_performance(s.orders, s.ads, AS_OF, additive=True)


def joined_map(column: str):
    """Map as sorted 'key=value' text."""
    return F.array_join(
        F.transform(F.map_entries(column), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ","
    )


def device(s: Staging):
    """Events with a device category out of their JSON properties."""
    number = F.get_json_object("props", "$.k").cast("int") % 3
    category = F.when(number == 0, "desktop").when(number == 1, "mobile").otherwise("tablet")
    return s.table("events").select(
        F.date_sub(F.to_date("ts"), 8217).alias("date"), category.alias("device_category"), "user_id", "event_type", "value"
    )


# The rule evaluation in SQL: one CASE per alert type, rules in list order.
RULES_SQL = """
SELECT * FROM (
  SELECT platform, entity_id, entity_name, date, 'low_roas' AS alert_type, 'roas' AS metric_name, roas AS metric_value,
    CASE WHEN roas < 1.5 THEN 'critical' WHEN roas < 2.0 THEN 'warning' END AS severity,
    CASE WHEN roas < 1.5 THEN 1.5 ELSE 2.0 END AS threshold, 'Low ROAS: ' || entity_name AS title,
    printf('ROAS is %.2f, below threshold of ', roas) || CASE WHEN roas < 1.5 THEN '1.5' ELSE '2.0' END AS message,
    CASE WHEN roas < 1.5 THEN 'Low ROAS - Critical' ELSE 'Low ROAS - Warning' END AS rule_name FROM metrics
  UNION ALL
  SELECT platform, entity_id, entity_name, date, 'high_cpa', 'cpa', cpa,
    CASE WHEN cpa > 500 THEN 'critical' WHEN cpa > 300 THEN 'warning' END, CASE WHEN cpa > 500 THEN 500 ELSE 300 END,
    'High CPA: ' || entity_name,
    printf('CPA is %.2f THB, above threshold of ', cpa) || CASE WHEN cpa > 500 THEN '500.0 THB' ELSE '300.0 THB' END,
    CASE WHEN cpa > 500 THEN 'High CPA - Critical' ELSE 'High CPA - Warning' END FROM metrics
  UNION ALL
  SELECT platform, entity_id, entity_name, date, 'revenue_drop', 'revenue_change_pct', change,
    CASE WHEN change < -0.3 THEN 'critical' WHEN change < -0.2 THEN 'warning' END,
    CASE WHEN change < -0.3 THEN -0.3 ELSE -0.2 END, 'Revenue Drop: ' || entity_name,
    printf('Revenue dropped by %.1f', abs(change) * 100) || '% compared to previous period',
    CASE WHEN change < -0.3 THEN 'Revenue Drop - Critical' ELSE 'Revenue Drop - Warning' END FROM metrics
  UNION ALL
  SELECT platform, entity_id, entity_name, date, 'low_conversion_rate', 'conversion_rate', conversion_rate,
    CASE WHEN conversion_rate < 0.01 THEN 'warning' END, 0.01, 'Low Conversion Rate: ' || entity_name,
    printf('Conversion rate is %.2f', conversion_rate * 100) || '%, below threshold of 1.0%', 'Low Conversion Rate' FROM metrics
  UNION ALL
  SELECT platform, entity_id, entity_name, date, 'high_cancellation_rate', 'cancellation_rate', cancellation_rate,
    CASE WHEN cancellation_rate > 0.15 THEN 'warning' END, 0.15, 'High Cancellation Rate: ' || entity_name,
    printf('Cancellation rate is %.1f', cancellation_rate * 100) || '%, above threshold of 15.0%', 'High Cancellation Rate'
  FROM metrics
) WHERE severity IS NOT NULL"""
METRICS_SQL = """, metrics AS (
SELECT a.*, a.platform || '_' || a.date AS entity_id, a.platform || ' - ' || a.date AS entity_name,
  a.cancelled_orders / nullif(a.total_orders, 0) AS cancellation_rate,
  CASE WHEN b.net_revenue > 0 THEN (a.net_revenue - b.net_revenue) / b.net_revenue END AS change
FROM daily_additive AS a LEFT JOIN daily_additive AS b ON b.platform = a.platform AND b.date = a.date - 7)
"""
RULE_COLUMNS = (
    "s platform entity_id entity_name; d date; s alert_type severity title message metric_name; r metric_value threshold;"
    " s rule_name"
)

SALES_SUMS = """sum(total) AS gross_revenue, sum(total - discount) AS net_revenue, sum(discount) AS total_discount,
  sum(shipping_fee) AS total_shipping_fee, sum(item_count) AS total_items_sold"""

CHECKS = [
    Check(
        "x1_sales_daily",
        "d date; s platform; l total_orders completed_orders cancelled_orders pending_orders; m gross_revenue net_revenue"
        " total_discount total_shipping_fee; l total_items_sold unique_customers new_customers returning_customers;"
        " r avg_items_per_order; m avg_order_value avg_item_value",
        lambda s: extended.sales_daily(s.orders),
        using("stg_orders")
        + f""", scoped AS (
  SELECT * REPLACE (scope AS platform), CAST(order_date AS DATE) AS date FROM stg_orders, unnest([platform, 'all']) AS u(scope)),
firsts AS (SELECT platform, customer_id, min(date) AS date FROM scoped GROUP BY ALL),
news AS (SELECT platform, date, count(*) AS n FROM firsts GROUP BY ALL)
SELECT d.*, coalesce(n, 0) AS new_customers, unique_customers - coalesce(n, 0) AS returning_customers,
  total_items_sold / total_orders AS avg_items_per_order, net_revenue / total_orders AS avg_order_value,
  net_revenue / nullif(total_items_sold, 0) AS avg_item_value
FROM (SELECT date, platform, count(*) AS total_orders, count(*) FILTER (status = 'completed') AS completed_orders,
  count(*) FILTER (status = 'cancelled') AS cancelled_orders, count(*) FILTER (status = 'pending') AS pending_orders,
  {SALES_SUMS}, count(DISTINCT customer_id) AS unique_customers FROM scoped GROUP BY date, platform) AS d
LEFT JOIN news ON news.platform = d.platform AND news.date = d.date""",
    ),
    Check(
        "x2_sales_by_product",
        "d date; s master_sku product_name platform; l quantity_sold; m gross_revenue net_revenue total_discount;"
        " l order_count; m avg_selling_price avg_discount_percent",
        lambda s: extended.sales_by_product(s.items, s.sku_map),
        using("stg_order_items", "stg_sku_mappings")
        + """
SELECT *, gross_revenue / nullif(quantity_sold, 0) AS avg_selling_price,
  total_discount / nullif(gross_revenue, 0) * 100 AS avg_discount_percent
FROM (SELECT CAST(order_date AS DATE) AS date, coalesce(m.master_sku, i.sku) AS master_sku, name AS product_name, i.platform,
  sum(quantity) AS quantity_sold, sum(total_price) AS gross_revenue, sum(total_price - discount) AS net_revenue,
  sum(discount) AS total_discount, count(DISTINCT order_id) AS order_count
  FROM stg_order_items AS i LEFT JOIN stg_sku_mappings AS m ON m.platform = i.platform AND m.platform_sku = i.sku
  GROUP BY ALL)""",
    ),
    Check(
        "x3_customer_segments",
        "d snapshot_date; s customer_id platform; l recency_days frequency; m monetary_value; l recency_score"
        " frequency_score monetary_score; s rfm_segment; d first_order_date last_order_date; l total_orders;"
        " m total_spent avg_order_value",
        lambda s: extended.customer_segments(s.orders, AS_OF, materialize=True),
        using("stg_orders")
        + f""", customers AS (
SELECT customer_id, platform, CAST(min(order_date) AS DATE) AS first_order_date,
  CAST(max(order_date) AS DATE) AS last_order_date, count(*) AS total_orders, sum(total) AS total_spent,
  {D} - CAST(max(order_date) AS DATE) AS recency_days
FROM stg_orders WHERE CAST(order_date AS DATE) <= {D} GROUP BY customer_id, platform),
scores AS (SELECT *,
  ntile(5) OVER (PARTITION BY platform ORDER BY -recency_days, md5(customer_id), customer_id) AS recency_score,
  ntile(5) OVER (PARTITION BY platform ORDER BY total_orders, md5(customer_id), customer_id) AS frequency_score,
  ntile(5) OVER (PARTITION BY platform ORDER BY round(total_spent, 4), md5(customer_id), customer_id) AS monetary_score
FROM customers)
SELECT *, {D} AS snapshot_date, total_orders AS frequency, total_spent AS monetary_value,
  total_spent / total_orders AS avg_order_value,
  CASE WHEN least(recency_score, frequency_score, monetary_score) >= 4 THEN 'Champions'
    WHEN least(recency_score, frequency_score) >= 3 THEN 'Loyal'
    WHEN recency_score >= 4 AND frequency_score <= 2 THEN 'New' WHEN recency_score <= 2 AND frequency_score >= 3 THEN 'At Risk'
    WHEN greatest(recency_score, frequency_score) <= 2 THEN 'Hibernating' ELSE 'Potential' END AS rfm_segment
FROM scores""",
    ),
    Check(
        "x4_marketing_daily",
        "d date; s platform; m total_spend; l total_impressions total_reach total_clicks; r avg_ctr; m avg_cpc avg_cpm;"
        " l total_conversions; m total_conversion_value avg_cost_per_conversion; r avg_conversion_rate;"
        " l total_video_views total_likes total_comments total_shares active_campaigns active_ads",
        lambda s: extended.marketing_daily(s.ads),
        using("stg_ads")
        + """
SELECT *, total_clicks / nullif(total_impressions, 0) AS avg_ctr, total_spend / nullif(total_clicks, 0) AS avg_cpc,
  1000 * total_spend / nullif(total_impressions, 0) AS avg_cpm,
  total_spend / nullif(total_conversions, 0) AS avg_cost_per_conversion,
  total_conversions / nullif(total_clicks, 0) AS avg_conversion_rate
FROM (SELECT date, scope AS platform, sum(spend) AS total_spend, sum(impressions) AS total_impressions,
  sum(reach) AS total_reach, sum(clicks) AS total_clicks, sum(conversions) AS total_conversions,
  sum(conversion_value) AS total_conversion_value, sum(video_views) AS total_video_views, sum(likes) AS total_likes,
  sum(comments) AS total_comments, sum(shares) AS total_shares, count(DISTINCT campaign_id) AS active_campaigns,
  count(DISTINCT ad_id) AS active_ads
  FROM stg_ads, unnest([platform, 'all']) AS u(scope) GROUP BY date, scope)""",
    ),
    Check(
        "x4b_marketing_by_campaign",
        "d date; s platform account_id campaign_id campaign_name campaign_type; m spend; l impressions clicks reach; r ctr;"
        " m cpc cpm; l conversions; m conversion_value cost_per_conversion; r roas; s status",
        lambda s: extended.marketing_by_campaign(s.ads),
        using("stg_ads")
        + """
SELECT date, platform, account_id, campaign_id, campaign_name, campaign_type, sum(spend) AS spend,
  sum(impressions) AS impressions, sum(clicks) AS clicks, sum(reach) AS reach,
  sum(clicks) / nullif(sum(impressions), 0) AS ctr, sum(spend) / nullif(sum(clicks), 0) AS cpc,
  1000 * sum(spend) / nullif(sum(impressions), 0) AS cpm, sum(conversions) AS conversions,
  sum(conversion_value) AS conversion_value, sum(spend) / nullif(sum(conversions), 0) AS cost_per_conversion,
  sum(conversion_value) / nullif(sum(spend), 0) AS roas, max(status) AS status
FROM stg_ads GROUP BY date, platform, account_id, campaign_id, campaign_name, campaign_type""",
    ),
    Check(
        "x5_channel_attribution",
        "d date; s channel_grouping source medium; l sessions users new_users; r bounce_rate; m avg_session_duration;"
        " l transactions; m revenue; r conversion_rate; m attributed_spend cost_per_session cost_per_acquisition; r roas",
        lambda s: extended.channel_attribution(s.traffic, s.ads),
        using("stg_ga4_sessions", "stg_ads")
        + f""", web AS (
SELECT date, channel_grouping, source, medium, {CHANNEL} AS platform, sum(sessions) AS sessions, sum(total_users) AS users,
  sum(new_users) AS new_users, avg(bounce_rate) AS bounce_rate, avg(avg_session_duration) AS avg_session_duration,
  sum(transactions) AS transactions, sum(revenue) AS revenue FROM stg_ga4_sessions GROUP BY ALL),
split AS (SELECT w.*, coalesce(a.spend * w.sessions / sum(w.sessions) OVER (PARTITION BY w.date, w.platform), 0) AS attributed_spend
  FROM web AS w LEFT JOIN (SELECT date, platform, sum(spend) AS spend FROM stg_ads GROUP BY ALL) AS a
  ON a.date = w.date AND a.platform = w.platform)
SELECT *, transactions / nullif(sessions, 0) AS conversion_rate, attributed_spend / nullif(sessions, 0) AS cost_per_session,
  attributed_spend / nullif(transactions, 0) AS cost_per_acquisition, revenue / nullif(attributed_spend, 0) AS roas
FROM split""",
    ),
    Check(
        "x6_product_catalog",
        "s master_sku product_name brand category platforms platform_skus; m min_price max_price avg_price; b is_active;"
        " l platforms_active total_units_sold; m total_revenue; r avg_daily_sales",
        lambda s: extended.product_catalog(s.products, s.items, s.sku_map, AS_OF)
        .withColumn("platforms", F.array_join("platforms", ","))
        .withColumn("platform_skus", joined_map("platform_skus")),
        using("products_mapped", "items_mapped")
        + f""", per AS (
SELECT master_sku, platform, min(name) AS name, min(brand) AS brand, min(category) AS category, min(sku) AS sku,
  min(unit_price) AS low, max(unit_price) AS high, sum(unit_price) AS total, count(*) AS n, bool_or(is_active) AS active
FROM products_mapped GROUP BY ALL),
sold AS (SELECT master_sku, sum(quantity) AS units, sum(total_price - discount) AS revenue FROM items_mapped
  WHERE order_date >= {D} - INTERVAL 30 DAY AND order_date < {D} + INTERVAL 1 DAY GROUP BY master_sku)
SELECT p.master_sku, min(name) AS product_name, min(brand) AS brand, min(category) AS category,
  string_agg(platform, ',' ORDER BY platform) AS platforms,
  string_agg(platform || '=' || sku, ',' ORDER BY platform) AS platform_skus, min(low) AS min_price, max(high) AS max_price,
  sum(total) / sum(n) AS avg_price, bool_or(active) AS is_active, count(*) FILTER (active) AS platforms_active,
  coalesce(max(units), 0) AS total_units_sold, coalesce(max(revenue), 0) AS total_revenue,
  coalesce(max(units), 0) / 30.0 AS avg_daily_sales
FROM per AS p LEFT JOIN sold ON sold.master_sku = p.master_sku GROUP BY p.master_sku""",
    ),
    Check(
        "x6b_product_sales_ranked",
        "d date; s master_sku product_name; l units_sold; m gross_revenue net_revenue; l order_count; s units_by_platform;"
        " m avg_selling_price min_selling_price max_selling_price; l rank_by_units rank_by_revenue; r pct_of_total_revenue",
        lambda s: extended.product_sales_ranked(s.items, s.sku_map, AS_OF, materialize=True).withColumn(
            "units_by_platform", joined_map("units_by_platform")
        ),
        using("items_mapped")
        + """, per AS (
SELECT CAST(order_date AS DATE) AS date, master_sku, platform, min(name) AS name, sum(quantity) AS units,
  sum(total_price) AS gross, round(sum(total_price - discount), 4) AS net, count(DISTINCT order_id) AS orders,
  min(unit_price) AS low, max(unit_price) AS high FROM items_mapped GROUP BY ALL),
days AS (SELECT date, master_sku, min(name) AS product_name, sum(units) AS units_sold, sum(gross) AS gross_revenue,
  round(sum(net), 4) AS net_revenue, sum(orders) AS order_count,
  string_agg(platform || '=' || CAST(units AS BIGINT), ',' ORDER BY platform) AS units_by_platform,
  sum(gross) / nullif(sum(units), 0) AS avg_selling_price, min(low) AS min_selling_price, max(high) AS max_selling_price
  FROM per GROUP BY ALL)
SELECT *, rank() OVER (PARTITION BY date ORDER BY units_sold DESC) AS rank_by_units,
  rank() OVER (PARTITION BY date ORDER BY net_revenue DESC) AS rank_by_revenue,
  net_revenue / nullif(sum(net_revenue) OVER (PARTITION BY date), 0) * 100 AS pct_of_total_revenue FROM days""",
    ),
    Check(
        "x6c_unmapped_products",
        "s platform platform_product_id platform_sku product_name variation; l total_units_sold; m total_revenue;"
        " l order_count; s review_status suggested_master_sku",
        lambda s: extended.unmapped_products(s.products, s.items, s.sku_map),
        using("stg_products", "stg_sku_mappings", "stg_order_items")
        + """
SELECT p.platform, platform_product_id, p.sku AS platform_sku, p.name AS product_name, p.variation,
  coalesce(sum(quantity), 0) AS total_units_sold, coalesce(sum(total_price), 0) AS total_revenue,
  count(DISTINCT order_id) AS order_count, 'pending' AS review_status, upper(p.sku) AS suggested_master_sku
FROM stg_products AS p LEFT JOIN stg_order_items AS i ON i.platform = p.platform AND i.sku = p.sku
WHERE NOT EXISTS (SELECT 1 FROM stg_sku_mappings AS m WHERE m.platform = p.platform AND m.platform_sku = p.sku)
GROUP BY p.platform, platform_product_id, p.sku, p.name, p.variation""",
    ),
    Check(
        "x7_analytics_daily",
        "d date; s property_id; l total_sessions engaged_sessions total_users new_users returning_users; r avg_bounce_rate"
        " avg_engagement_rate; m avg_session_duration; l total_page_views transactions; m revenue; r conversion_rate;"
        " s sessions_by_channel users_by_channel",
        lambda s: extended.analytics_daily(s.sessions)
        .withColumn("sessions_by_channel", joined_map("sessions_by_channel"))
        .withColumn("users_by_channel", joined_map("users_by_channel")),
        using("stg_ga4_sessions")
        + """, c AS (SELECT date, property_id, channel_grouping, CAST(sum(sessions) AS BIGINT) AS sessions,
    CAST(sum(total_users) AS BIGINT) AS users FROM stg_ga4_sessions GROUP BY ALL),
maps AS (SELECT date, property_id,
  string_agg(channel_grouping || '=' || sessions, ',' ORDER BY channel_grouping) AS sessions_by_channel,
  string_agg(channel_grouping || '=' || users, ',' ORDER BY channel_grouping) AS users_by_channel FROM c GROUP BY ALL),
days AS (SELECT date, property_id, sum(sessions) AS total_sessions, sum(engaged_sessions) AS engaged_sessions,
  sum(total_users) AS total_users, sum(new_users) AS new_users,
  greatest(0, sum(total_users) - sum(new_users)) AS returning_users, avg(bounce_rate) AS avg_bounce_rate,
  avg(engagement_rate) AS avg_engagement_rate, avg(avg_session_duration) AS avg_session_duration,
  sum(screen_page_views) AS total_page_views, sum(transactions) AS transactions, sum(revenue) AS revenue,
  sum(transactions) / nullif(sum(sessions), 0) AS conversion_rate FROM stg_ga4_sessions GROUP BY date, property_id)
SELECT * FROM days JOIN maps USING (date, property_id)""",
    ),
    Check(
        "x7b_top_pages_daily",
        "d date; s property_id page_path page_title; l page_rank page_views unique_page_views sessions; m avg_time_on_page;"
        " r bounce_rate exit_rate; l entrances",
        lambda s: extended.top_pages_daily(s.pages),
        using("stg_ga4_pages")
        + """
SELECT *, row_number() OVER (PARTITION BY date, property_id ORDER BY page_views DESC, md5(page_path), page_path) AS page_rank
FROM stg_ga4_pages""",
    ),
    Check(
        "x7c_traffic_sources_daily",
        "d date; s property_id channel_grouping source medium campaign; l sessions users new_users; r bounce_rate"
        " engagement_rate; m avg_session_duration; l transactions; m revenue; r conversion_rate pct_of_sessions"
        " pct_of_revenue",
        lambda s: extended.traffic_sources_daily(s.traffic),
        using("stg_ga4_sessions")
        + """
SELECT *, total_users AS users, transactions / nullif(sessions, 0) AS conversion_rate,
  sessions / sum(sessions) OVER (PARTITION BY date, property_id) * 100 AS pct_of_sessions,
  revenue / nullif(sum(revenue) OVER (PARTITION BY date, property_id), 0) * 100 AS pct_of_revenue FROM stg_ga4_sessions""",
    ),
    Check(
        "l2_rule_evaluation",
        RULE_COLUMNS,
        lambda s: rules.evaluate(metrics.daily_metrics(additive(s))),
        using("daily_additive") + METRICS_SQL + RULES_SQL,
    ),
    Check(
        "l2b_rules_with_platform_list",
        "s platform entity_id alert_type severity rule_name; r threshold",
        lambda s: rules.evaluate(
            metrics.daily_metrics(additive(s)),
            rules.add_rule(
                rules.remove_rule(rules.default_rules(), "Low ROAS - Critical"),
                rules.Rule("Thin ROAS", "low_roas", "ROAS < 40", "lte", 40.0, "info", True, ("shopee", "lazada")),
            ),
            ["low_roas"],
        ),
        using("daily_additive")
        + """
SELECT platform, platform || '_' || date AS entity_id, 'low_roas' AS alert_type,
  CASE WHEN roas < 2.0 THEN 'warning' ELSE 'info' END AS severity,
  CASE WHEN roas < 2.0 THEN 'Low ROAS - Warning' ELSE 'Thin ROAS' END AS rule_name,
  CASE WHEN roas < 2.0 THEN 2.0 ELSE 40.0 END AS threshold
FROM daily_additive WHERE roas < 2.0 OR (roas <= 40 AND platform IN ('shopee', 'lazada'))""",
    ),
    Check(
        "l3_shop_rules",
        RULE_COLUMNS,
        lambda s: rules.evaluate(metrics.shop_metrics(m2(s))),
        using("shop_mart")
        + """, metrics AS (SELECT platform, platform AS entity_id, platform AS entity_name, snapshot_date AS date, roas_30d AS roas,
  cpa_30d AS cpa, revenue_growth_rate_wow AS change, CAST(NULL AS DOUBLE) AS conversion_rate,
  cancellation_rate_30d AS cancellation_rate FROM shop_mart)"""
        + RULES_SQL,
    ),
    Check(
        "l5_spend_anomaly",
        "s platform alert_type severity metric_name; r metric_value threshold",
        lambda s: rules.evaluate(metrics.spend_metrics(s.ads, AS_OF), alert_types=["spend_anomaly"]),
        using("stg_ads")
        + f"""
SELECT platform, 'spend_anomaly' AS alert_type, 'info' AS severity, 'spend_vs_average' AS metric_name,
  (now - mean) / mean AS metric_value, 0.5 AS threshold
FROM (SELECT platform, coalesce(sum(spend) FILTER (date = {D} - 1), 0) AS now,
  coalesce(sum(spend) FILTER (date < {D} - 1), 0) / 7 AS mean
  FROM stg_ads WHERE date >= {D} - 8 AND date <= {D} AND date < {D} GROUP BY platform)
WHERE mean > 0 AND (now - mean) / mean > 0.5""",
    ),
    Check(
        "l5b_campaign_below_benchmark",
        "s platform entity_id alert_type severity; r metric_value",
        lambda s: rules.evaluate(metrics.campaign_metrics(s.ads, AS_OF), alert_types=["campaign_underperforming"]),
        using("campaign_bench")
        + f"""
SELECT platform, campaign_id AS entity_id, 'campaign_underperforming' AS alert_type, 'warning' AS severity,
  value / nullif(spend, 0) / nullif(b_roas, 0) AS metric_value
FROM (SELECT platform, campaign_id, sum(spend) AS spend, sum(conversion_value) AS value FROM campaign_day
  WHERE date >= {D} - 30 AND date <= {D} GROUP BY platform, campaign_id, campaign_name) JOIN campaign_bench USING (platform)
WHERE value / nullif(spend, 0) / nullif(b_roas, 0) < 0.5""",
    ),
    Check(
        "q1_scorecard",
        "s figure; m current previous; r change_pct",
        lambda s: dashboards.scorecard(additive(s), AS_OF),
        using("daily_additive")
        + f""", sums AS (SELECT
  coalesce(sum(net_revenue) FILTER (date >= {D} - 7 AND date <= {D}), 0) AS r1, coalesce(sum(net_revenue) FILTER (date < {D} - 7), 0) AS r0,
  coalesce(sum(total_orders) FILTER (date >= {D} - 7 AND date <= {D}), 0) AS o1, coalesce(sum(total_orders) FILTER (date < {D} - 7), 0) AS o0,
  coalesce(sum(total_ad_spend) FILTER (date >= {D} - 7 AND date <= {D}), 0) AS s1, coalesce(sum(total_ad_spend) FILTER (date < {D} - 7), 0) AS s0
  FROM daily_additive WHERE date >= {D} - 14 AND date <= {D} AND date < {D})
SELECT *, CASE WHEN previous = 0 AND current > 0 THEN 100 WHEN previous = 0 THEN 0
    ELSE (current - previous) / previous * 100 END AS change_pct
FROM (SELECT 'revenue' AS figure, r1 AS current, r0 AS previous FROM sums UNION ALL SELECT 'orders', o1, o0 FROM sums
  UNION ALL SELECT 'ad_spend', s1, s0 FROM sums UNION ALL SELECT 'roas', r1 / nullif(s1, 0), r0 / nullif(s0, 0) FROM sums)""",
    ),
    Check(
        "q2_revenue_share",
        "s platform; m amount; r share_pct",
        lambda s: dashboards.share_breakdown(additive(s), "platform", "net_revenue", AS_OF),
        using("daily_additive")
        + f"""SELECT platform, sum(net_revenue) AS amount, sum(net_revenue) / sum(sum(net_revenue)) OVER () * 100 AS share_pct
FROM daily_additive WHERE date >= {D} - 30 AND date <= {D} GROUP BY platform""",
    ),
    Check(
        "q2b_ad_spend_share",
        "s platform; m amount; r share_pct",
        lambda s: dashboards.share_breakdown(s.ads, "platform", "spend", AS_OF),
        using("stg_ads")
        + f"""SELECT platform, sum(spend) AS amount, sum(spend) / sum(sum(spend)) OVER () * 100 AS share_pct
FROM stg_ads WHERE date >= {D} - 30 AND date <= {D} GROUP BY platform""",
    ),
    Check(
        "q2c_category_share",
        "s category; m amount; r share_pct",
        lambda s: dashboards.share_breakdown(m5(s), "category", "net_revenue", AS_OF),
        using("product_mart")
        + f"""SELECT category, sum(net_revenue) AS amount, sum(net_revenue) / sum(sum(net_revenue)) OVER () * 100 AS share_pct
FROM product_mart WHERE date >= {D} - 30 AND date <= {D} GROUP BY category""",
    ),
    Check(
        "q3_calculated_fields",
        "d date; s platform; r roas; m cpa; r ctr_pct cvr_pct; m aov",
        lambda s: dashboards.calculated_fields(additive(s)),
        using("daily_additive")
        + """SELECT date, platform, CASE WHEN total_ad_spend > 0 THEN net_revenue / total_ad_spend ELSE 0 END AS roas,
  CASE WHEN total_conversions > 0 THEN total_ad_spend / total_conversions ELSE 0 END AS cpa,
  CASE WHEN total_impressions > 0 THEN total_clicks / total_impressions * 100 ELSE 0 END AS ctr_pct,
  CASE WHEN total_clicks > 0 THEN total_conversions / total_clicks * 100 ELSE 0 END AS cvr_pct,
  CASE WHEN total_orders > 0 THEN net_revenue / total_orders ELSE 0 END AS aov FROM daily_additive""",
    ),
    Check(
        "q4_growth_rates",
        "s platform; r wow_growth_pct mom_growth_pct yoy_growth_pct",
        lambda s: dashboards.growth_rates(s.orders, AS_OF),
        using("stg_orders")
        + f""", d AS (SELECT platform, total, {D} - CAST(order_date AS DATE) AS age FROM stg_orders)
SELECT platform, 100 * (w1 - w0) / nullif(w0, 0) AS wow_growth_pct, 100 * (m1 - m0) / nullif(m0, 0) AS mom_growth_pct,
  100 * (y1 - y0) / nullif(y0, 0) AS yoy_growth_pct
FROM (SELECT platform, coalesce(sum(total) FILTER (age <= 7), 0) AS w1,
  coalesce(sum(total) FILTER (age > 7 AND age <= 14), 0) AS w0, coalesce(sum(total) FILTER (age <= 30), 0) AS m1,
  coalesce(sum(total) FILTER (age > 30 AND age <= 60), 0) AS m0, coalesce(sum(total) FILTER (age <= 365), 0) AS y1,
  coalesce(sum(total) FILTER (age > 365), 0) AS y0 FROM d WHERE age > 0 AND age <= 730 GROUP BY platform)""",
    ),
    Check(
        "q5_top_sources_and_other",
        "s slice; l sessions",
        lambda s: dashboards.top_and_other(s.sessions, "source", "sessions", 5),
        using("stg_ga4_sessions")
        + """, t AS (SELECT source, sum(sessions) AS sessions, row_number() OVER (ORDER BY sum(sessions) DESC, source) AS r
  FROM stg_ga4_sessions GROUP BY source)
SELECT CASE WHEN r <= 5 THEN source ELSE 'Other' END AS slice, sum(sessions) AS sessions FROM t GROUP BY ALL""",
    ),
    Check(
        "q6_top_products_table",
        "l rank; s master_sku product_name; m sales; l units; r revenue_pct",
        lambda s: dashboards.top_products_table(m5(s), AS_OF),
        using("product_mart")
        + f""", t AS (SELECT master_sku, min(product_name) AS product_name, sum(net_revenue) AS sales, sum(units_sold) AS units
  FROM product_mart WHERE date >= {D} - 30 AND date <= {D} GROUP BY master_sku)
SELECT *, row_number() OVER (ORDER BY round(sales, 4) DESC, master_sku) AS rank,
  100 * sales / sum(sales) OVER () AS revenue_pct FROM t ORDER BY rank LIMIT 10""",
    ),
    Check(
        "q6b_top_pages_table",
        "l rank; s page_path; l views; m avg_time",
        lambda s: dashboards.top_pages_table(s.pages),
        using("stg_ga4_pages")
        + """SELECT page_path, sum(page_views) AS views, avg(avg_time_on_page) AS avg_time,
  row_number() OVER (ORDER BY sum(page_views) DESC, page_path) AS rank FROM stg_ga4_pages GROUP BY page_path
ORDER BY rank LIMIT 10""",
    ),
    Check(
        "q6c_platform_top_products",
        "s platform master_sku; m sales; l rank",
        lambda s: dashboards.platform_top_products(m5(s), AS_OF),
        using("product_mart")
        + f"""SELECT platform, master_sku, sum(net_revenue) AS sales,
  row_number() OVER (PARTITION BY platform ORDER BY round(sum(net_revenue), 4) DESC, master_sku) AS rank
FROM product_mart WHERE date >= {D} - 30 AND date <= {D} GROUP BY platform, master_sku QUALIFY rank <= 5""",
    ),
    Check(
        "q7_conversion_goals",
        "s goal; l completions; m value; r rate_pct; m value_per_completion",
        lambda s: dashboards.conversion_goals(s.table("events"), ["purchase", "signup"]),
        """
SELECT event_type AS goal, count(*) AS completions, sum(value) AS value, sum(value) / count(*) AS value_per_completion,
  100.0 * count(*) / (SELECT count(*) FROM (SELECT DISTINCT CAST(ts AS DATE), user_id FROM events)) AS rate_pct
FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY event_type""",
    ),
    Check(
        "q8_shop_trend",
        "d date; s platform; m revenue",
        lambda s: dashboards.shop_trend(s.orders, AS_OF),
        using("stg_orders")
        + f"""SELECT CAST(order_date AS DATE) AS date, platform, sum(total) AS revenue FROM stg_orders
WHERE CAST(order_date AS DATE) >= {D} - 30 GROUP BY ALL""",
    ),
    Check(
        "q9_headline_flags",
        "d date; r roas; s roas_flag revenue_flag roas_grade",
        lambda s: dashboards.headline_flags(daily.daily_performance_total(additive(s)), AS_OF),
        using("daily_additive")
        + f""", t AS (SELECT date, sum(net_revenue) AS revenue, sum(total_ad_spend) AS spend FROM daily_additive GROUP BY date)
SELECT t.date, t.revenue / nullif(t.spend, 0) AS roas,
  CASE WHEN t.revenue / nullif(t.spend, 0) < 2 THEN 'ROAS Below Target' ELSE '' END AS roas_flag,
  CASE WHEN (t.revenue - b.revenue) / nullif(b.revenue, 0) < -0.1 THEN 'Revenue Dropped >10%' ELSE '' END AS revenue_flag,
  CASE WHEN t.revenue / nullif(t.spend, 0) >= 4 THEN 'Good' WHEN t.revenue / nullif(t.spend, 0) >= 2 THEN 'OK' ELSE 'Poor'
    END AS roas_grade
FROM t LEFT JOIN t AS b ON b.date = t.date - 7 WHERE t.date >= {D} - 30 AND t.date <= {D}""",
    ),
    Check(
        "q10_device_summary",
        "d date; s device_category; l sessions users; r bounce_rate pages_per_session; m avg_session_duration;"
        " l conversions; m revenue",
        lambda s: dashboards.device_summary(device(s)),
        """
SELECT CAST(ts AS DATE) - 8217 AS date,
  CASE CAST(json_extract_string(props, '$.k') AS INT) % 3 WHEN 0 THEN 'desktop' WHEN 1 THEN 'mobile' ELSE 'tablet' END
    AS device_category,
  count(*) AS sessions, count(DISTINCT user_id) AS users, 100.0 * count(*) FILTER (event_type = 'error') / count(*) AS bounce_rate,
  count(*) FILTER (event_type = 'view') / count(*) AS pages_per_session, avg(value) AS avg_session_duration,
  count(*) FILTER (event_type = 'purchase') AS conversions,
  coalesce(sum(value) FILTER (event_type = 'purchase'), 0) AS revenue FROM events GROUP BY ALL""",
    ),
    Check(
        "q10b_daily_overview",
        "d date; l sessions users new_users pageviews; r pages_per_session; m avg_session_duration; r bounce_rate;"
        " l conversions; r conversion_rate; m revenue",
        lambda s: dashboards.daily_overview(s.visits),
        using("visits")
        + """SELECT date, count(*) AS sessions, count(DISTINCT user_id) AS users,
  count(DISTINCT user_id) FILTER (event_type = 'signup') AS new_users, count(*) FILTER (event_type = 'view') AS pageviews,
  count(*) FILTER (event_type = 'view') / count(*) AS pages_per_session, avg(value) AS avg_session_duration,
  100.0 * count(*) FILTER (event_type = 'error') / count(*) AS bounce_rate,
  count(*) FILTER (event_type = 'purchase') AS conversions,
  100.0 * count(*) FILTER (event_type = 'purchase') / count(*) AS conversion_rate,
  coalesce(sum(value) FILTER (event_type = 'purchase'), 0) AS revenue FROM visits GROUP BY date""",
    ),
    Check(
        "q11_report_filters",
        "d date; s platform; m net_revenue total_ad_spend",
        lambda s: dashboards.apply_filters(
            additive(s), start="2001-06-01", end="2001-07-15", platform=["shopee", "lazada"]
        ),
        using("daily_additive")
        + """SELECT date, platform, net_revenue, total_ad_spend FROM daily_additive
WHERE date BETWEEN DATE '2001-06-01' AND DATE '2001-07-15' AND platform IN ('shopee', 'lazada')""",
    ),
]
