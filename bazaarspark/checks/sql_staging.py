"""DuckDB CTEs for the staging tables and marts, written from their definitions."""

from __future__ import annotations

AS_OF = "DATE '2001-08-01'"

STAGES: dict[str, tuple[tuple[str, ...], str]] = {}


def stage(name: str, needs: tuple[str, ...], body: str) -> None:
    STAGES[name] = (needs, body.strip())


def using(*names: str) -> str:
    """WITH clause defining the named stages and everything they need, in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        needs, _ = STAGES[name]
        for n in needs:
            visit(n)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS (\n{STAGES[n][1]}\n)" for n in ordered) + "\n"


def pick(key: str, *names: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    return f"(CASE ({key}) % {len(names)} {arms} END)"


SHOP = pick("o_custkey", "shopee", "lazada", "tiktok_shop")
CHANNEL = """CASE
  WHEN contains(lower(source), 'facebook') OR lower(medium) = 'paid_social' THEN 'facebook_ads'
  WHEN contains(lower(source), 'google') AND lower(medium) IN ('cpc','ppc') THEN 'google_ads'
  WHEN contains(lower(source), 'tiktok') THEN 'tiktok_ads'
  WHEN contains(lower(source), 'line') THEN 'line_ads'
  WHEN contains(lower(source), 'shopee') THEN 'shopee_ads'
  WHEN contains(lower(source), 'lazada') THEN 'lazada_ads'
  ELSE 'organic_and_other' END"""
GROUPING = """CASE
  WHEN s IN ('(direct)','direct') AND m IN ('(none)','(not set)','') THEN 'Direct'
  WHEN m = 'organic' THEN 'Organic Search'
  WHEN m IN ('cpc','ppc','paidsearch') THEN 'Paid Search'
  WHEN m IN ('display','cpm','banner') THEN 'Display'
  WHEN m IN ('paid_social','paidsocial','paid-social') THEN 'Paid Social'
  WHEN m = 'social' OR s IN ('facebook','instagram','twitter','linkedin','tiktok','youtube','pinterest') THEN 'Social'
  WHEN m = 'email' THEN 'Email'
  WHEN m = 'affiliate' THEN 'Affiliates'
  WHEN m = 'referral' THEN 'Referral'
  WHEN m = 'video' THEN 'Video'
  WHEN m = 'audio' THEN 'Audio'
  WHEN m = 'sms' THEN 'SMS'
  WHEN m IN ('push','mobile','notification') THEN 'Mobile Push'
  ELSE 'Other' END"""

stage(
    "stg_orders",
    (),
    f"""
SELECT {SHOP} || '_' || o_orderkey AS order_id, {SHOP} AS platform, CAST(o_orderkey AS VARCHAR) AS platform_order_id,
  CAST(o_custkey AS VARCHAR) AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' WHEN 'P' THEN 'cancelled' END AS status,
  o_orderdate AS order_date, o_totalprice AS total,
  o_totalprice * CAST(o_orderkey % 10 AS DOUBLE) * CAST(0.01 AS DOUBLE) AS discount,
  CAST(o_custkey % 50 AS DOUBLE) AS shipping_fee, coalesce(n, 0) AS item_count
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
""",
)
stage(
    "stg_order_items",
    (),
    f"""
SELECT l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS item_id,
  {SHOP} || '_' || o_orderkey AS order_id, {SHOP} AS platform, o_orderdate AS order_date,
  CAST(l_partkey AS VARCHAR) AS product_id, upper(substr({SHOP}, 1, 3)) || '-' || l_partkey AS sku, p_name AS name,
  CAST(NULL AS VARCHAR) AS variation, CAST(l_quantity AS BIGINT) AS quantity,
  l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total_price, l_extendedprice * l_discount AS discount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey
""",
)
stage(
    "stg_products",
    (),
    """
SELECT platform || '_' || p_partkey AS product_id, platform, CAST(p_partkey AS VARCHAR) AS platform_product_id,
  upper(substr(platform, 1, 3)) || '-' || p_partkey AS sku, p_name AS name, CAST(NULL AS VARCHAR) AS variation,
  p_type AS category, p_brand AS brand, p_retailprice AS unit_price, p_size <> 1 AS is_active, p_partkey AS seen_order,
  p_partkey
FROM part CROSS JOIN (VALUES ('shopee'), ('lazada'), ('tiktok_shop')) AS shops(platform)
""",
)
stage(
    "stg_sku_mappings",
    ("stg_products",),
    """
SELECT 'M-' || (p_partkey % 500) AS master_sku, platform, sku AS platform_sku, name AS product_name, variation
FROM stg_products WHERE p_partkey % 20 <> 0
""",
)
stage(
    "stg_ads",
    (),
    f"""
SELECT *, clicks / nullif(CAST(impressions AS DOUBLE), 0) AS ctr, spend / nullif(CAST(clicks AS DOUBLE), 0) AS cpc,
  spend * 1000 / nullif(CAST(impressions AS DOUBLE), 0) AS cpm
FROM (
  SELECT l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS record_id,
    {pick('l_suppkey', 'facebook_ads', 'google_ads', 'tiktok_ads', 'line_ads', 'shopee_ads', 'lazada_ads')} AS platform,
    'a_' || (l_suppkey % 7) AS account_id, 'c_' || l_suppkey AS campaign_id, 'Campaign ' || l_suppkey AS campaign_name,
    CAST(l_partkey % 4 AS VARCHAR) AS adgroup_id, CAST(l_partkey % 12 AS VARCHAR) AS ad_id,
    'conversions' AS campaign_type, 'CONVERSIONS' AS objective,
    CASE WHEN l_suppkey % 4 = 0 THEN 'paused' ELSE 'active' END AS status, 'ad' AS level,
    CAST(l_shipdate AS DATE) AS date, l_extendedprice * CAST(0.01 AS DOUBLE) AS spend,
    CAST(floor(l_quantity * 100) AS BIGINT) AS impressions,
    CAST(floor(l_quantity * l_tax * 10) AS BIGINT) AS clicks, CAST(floor(l_quantity * 60) AS BIGINT) AS reach,
    CAST(floor(l_quantity * l_tax) AS BIGINT) AS conversions,
    CAST(floor(l_quantity * l_tax) AS BIGINT) * l_extendedprice * CAST(0.02 AS DOUBLE) AS conversion_value,
    CAST(floor(l_quantity * 7) AS BIGINT) AS video_views,
    CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS BIGINT) END AS likes, CAST(l_linenumber AS BIGINT) AS comments,
    l_partkey % 3 AS shares
  FROM lineitem
)
""",
)
stage(
    "visits",
    (),
    f"""
SELECT CAST(ts AS DATE) - 8217 AS date,
  {pick('user_id', 'facebook', 'google', 'tiktok', 'line', 'shopee', 'lazada', '(direct)')} AS source,
  {pick('event_id', 'cpc', 'organic', 'paid_social', '(none)')} AS medium, event_id, user_id, event_type, value
FROM events
""",
)
stage(
    "stg_ga4_sessions",
    ("visits",),
    f"""
SELECT *, 1.0 - bounce_rate AS engagement_rate, 'properties/1' AS property_id, CAST(NULL AS VARCHAR) AS campaign,
  {GROUPING} AS channel_grouping
FROM (
  SELECT date, source, medium, lower(trim(source)) AS s, lower(trim(medium)) AS m, count(*) AS sessions,
    count(*) FILTER (event_type <> 'error') AS engaged_sessions, count(DISTINCT user_id) AS total_users,
    count(DISTINCT user_id) FILTER (event_type = 'signup') AS new_users,
    avg(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) AS bounce_rate, avg(value) AS avg_session_duration,
    count(*) FILTER (event_type = 'view') AS screen_page_views,
    count(*) FILTER (event_type = 'purchase') AS transactions,
    coalesce(sum(value) FILTER (event_type = 'purchase'), 0) AS revenue
  FROM visits GROUP BY date, source, medium
)
""",
)
stage(
    "stg_ga4_pages",
    ("visits",),
    """
SELECT *, sessions AS unique_page_views, exits * 100.0 / page_views AS exit_rate, 'properties/1' AS property_id,
  'Page ' || page_path AS page_title
FROM (
  SELECT date, '/' || event_type || '/' || (user_id % 10) AS page_path, count(*) AS page_views,
    count(DISTINCT user_id) AS sessions, count(*) FILTER (event_id % 3 = 0) AS entrances,
    count(*) FILTER (event_id % 5 = 0) AS exits, avg(event_id % 2) AS bounce_rate, avg(value) AS avg_time_on_page
  FROM visits GROUP BY ALL
)
""",
)

# --- marts ---------------------------------------------------------------------------------------
stage(
    "orders_day",
    ("stg_orders",),
    f"""
SELECT CAST(order_date AS DATE) AS date, platform, count(*) AS total_orders,
  count(*) FILTER (status = 'completed') AS completed_orders, count(*) FILTER (status = 'cancelled') AS cancelled_orders,
  count(*) FILTER (status = 'pending') AS pending_orders, sum(total) AS gross_revenue,
  sum(total - discount) AS net_revenue, sum(discount) AS total_discount, sum(shipping_fee) AS total_shipping_fee,
  sum(item_count) AS total_items_sold, count(DISTINCT customer_id) AS unique_customers
FROM stg_orders WHERE order_date >= {AS_OF} - INTERVAL 90 DAY AND order_date < {AS_OF} + INTERVAL 1 DAY GROUP BY ALL
""",
)
stage(
    "ads_day",
    ("stg_ads",),
    f"""
SELECT date, platform AS ads_platform,
  CASE platform WHEN 'shopee_ads' THEN 'shopee' WHEN 'lazada_ads' THEN 'lazada' WHEN 'tiktok_ads' THEN 'tiktok_shop'
    ELSE 'all' END AS shop,
  sum(spend) AS total_ad_spend, sum(impressions) AS total_impressions, sum(clicks) AS total_clicks,
  sum(conversions) AS total_conversions, sum(conversion_value) AS total_conversion_value,
  avg(ctr) AS avg_ctr, avg(cpc) AS avg_cpc, avg(cpm) AS avg_cpm
FROM stg_ads WHERE date >= {AS_OF} - 90 AND date <= {AS_OF} GROUP BY ALL
""",
)
M1_MEASURES = """
  coalesce(total_orders, 0) AS total_orders, coalesce(completed_orders, 0) AS completed_orders,
  coalesce(cancelled_orders, 0) AS cancelled_orders, coalesce(pending_orders, 0) AS pending_orders,
  coalesce(gross_revenue, 0) AS gross_revenue, coalesce(net_revenue, 0) AS net_revenue,
  coalesce(total_discount, 0) AS total_discount, coalesce(total_shipping_fee, 0) AS total_shipping_fee,
  coalesce(total_items_sold, 0) AS total_items_sold, coalesce(unique_customers, 0) AS unique_customers,
  coalesce(total_ad_spend, 0) AS total_ad_spend, coalesce(total_impressions, 0) AS total_impressions,
  coalesce(total_clicks, 0) AS total_clicks, coalesce(total_conversions, 0) AS total_conversions,
  coalesce(total_conversion_value, 0) AS total_conversion_value, avg_ctr, avg_cpc, avg_cpm,
  net_revenue / nullif(total_ad_spend, 0) AS roas, total_ad_spend / nullif(completed_orders, 0) AS cpa,
  net_revenue / nullif(completed_orders, 0) AS avg_order_value,
  completed_orders / nullif(total_orders, 0) AS order_completion_rate,
  total_conversions / nullif(total_clicks, 0) AS conversion_rate
"""
stage(
    "daily_mart",
    ("orders_day", "ads_day"),
    f"""
SELECT coalesce(o.date, a.date) AS date, coalesce(o.platform, a.shop) AS platform, {M1_MEASURES}
FROM orders_day AS o FULL JOIN ads_day AS a ON o.date = a.date AND a.shop IN (o.platform, 'all')
""",
)
stage(
    "daily_additive",
    ("orders_day", "stg_ads"),
    f"""
SELECT coalesce(o.date, a.date) AS date, coalesce(o.platform, a.shop) AS platform, {M1_MEASURES}
FROM orders_day AS o FULL JOIN (
  SELECT date, CASE platform WHEN 'shopee_ads' THEN 'shopee' WHEN 'lazada_ads' THEN 'lazada'
      WHEN 'tiktok_ads' THEN 'tiktok_shop' ELSE 'all' END AS shop,
    sum(spend) AS total_ad_spend, sum(impressions) AS total_impressions, sum(clicks) AS total_clicks,
    sum(conversions) AS total_conversions, sum(conversion_value) AS total_conversion_value,
    avg(ctr) AS avg_ctr, avg(cpc) AS avg_cpc, avg(cpm) AS avg_cpm
  FROM stg_ads WHERE date >= {AS_OF} - 90 AND date <= {AS_OF} GROUP BY ALL) AS a ON o.date = a.date AND o.platform = a.shop
""",
)
stage(
    "shop_mart",
    ("stg_orders", "stg_ads"),
    f"""
SELECT {AS_OF} AS snapshot_date, o.*,
  coalesce(ad_30, 0) AS ad_spend_30d, coalesce(ad_60, 0) AS ad_spend_prev_30d,
  coalesce(impressions_30, 0) AS impressions_30d, coalesce(clicks_30, 0) AS clicks_30d,
  coalesce(conversions_30, 0) AS conversions_30d,
  (orders_30d - orders_prev_30d) / nullif(orders_prev_30d, 0) AS order_growth_rate_mom,
  (revenue_30d - revenue_prev_30d) / nullif(revenue_prev_30d, 0) AS revenue_growth_rate_mom,
  (net_revenue_30d - net_revenue_prev_30d) / nullif(net_revenue_prev_30d, 0) AS net_revenue_growth_rate_mom,
  (customers_30d - customers_prev_30d) / nullif(customers_prev_30d, 0) AS customer_growth_rate_mom,
  (orders_7d - orders_prev_7d) / nullif(orders_prev_7d, 0) AS order_growth_rate_wow,
  (revenue_7d - revenue_prev_7d) / nullif(revenue_prev_7d, 0) AS revenue_growth_rate_wow,
  (ad_30 - ad_60) / nullif(ad_60, 0) AS ad_spend_growth_rate_mom,
  net_revenue_30d / nullif(ad_30, 0) AS roas_30d, ad_30 / nullif(completed_orders_30d, 0) AS cpa_30d,
  net_revenue_30d / nullif(orders_30d, 0) AS aov_30d,
  completed_orders_30d / nullif(orders_30d, 0) AS completion_rate_30d,
  cancelled_orders_30d / nullif(orders_30d, 0) AS cancellation_rate_30d,
  CASE WHEN revenue_30d > 1.1 * revenue_prev_30d AND revenue_prev_30d > 0 THEN 'growing'
       WHEN revenue_30d < 0.9 * revenue_prev_30d AND revenue_prev_30d > 0 THEN 'declining'
       ELSE 'stable' END AS performance_status
FROM (
  SELECT platform, count(*) FILTER (age <= 30) AS orders_30d, coalesce(sum(total) FILTER (age <= 30), 0) AS revenue_30d,
    coalesce(sum(total - discount) FILTER (age <= 30), 0) AS net_revenue_30d,
    count(DISTINCT customer_id) FILTER (age <= 30) AS customers_30d,
    coalesce(sum(item_count) FILTER (age <= 30), 0) AS items_sold_30d,
    count(*) FILTER (age > 30 AND age <= 60) AS orders_prev_30d,
    coalesce(sum(total) FILTER (age > 30 AND age <= 60), 0) AS revenue_prev_30d,
    coalesce(sum(total - discount) FILTER (age > 30 AND age <= 60), 0) AS net_revenue_prev_30d,
    count(DISTINCT customer_id) FILTER (age > 30 AND age <= 60) AS customers_prev_30d,
    count(*) FILTER (age <= 7) AS orders_7d, coalesce(sum(total) FILTER (age <= 7), 0) AS revenue_7d,
    count(*) FILTER (age > 7 AND age <= 14) AS orders_prev_7d,
    coalesce(sum(total) FILTER (age > 7 AND age <= 14), 0) AS revenue_prev_7d,
    count(*) FILTER (age <= 30 AND status = 'completed') AS completed_orders_30d,
    count(*) FILTER (age <= 30 AND status = 'cancelled') AS cancelled_orders_30d,
    count(*) FILTER (age <= 30 AND status = 'pending') AS pending_orders_30d,
    count(*) AS total_orders_all_time, sum(total) AS total_revenue_all_time,
    count(DISTINCT customer_id) AS total_customers_all_time,
    CAST(min(order_date) AS DATE) AS first_order_date, CAST(max(order_date) AS DATE) AS last_order_date
  FROM (SELECT *, date_diff('second', order_date, CAST({AS_OF} AS TIMESTAMP)) / 86400.0 AS age FROM stg_orders)
  WHERE age > -1 AND age <= 365 GROUP BY platform) AS o
LEFT JOIN (
  SELECT CASE platform WHEN 'shopee_ads' THEN 'shopee' WHEN 'lazada_ads' THEN 'lazada' ELSE 'tiktok_shop' END AS shop,
    coalesce(sum(spend) FILTER (date >= {AS_OF} - 30 AND date <= {AS_OF}), 0) AS ad_30,
    coalesce(sum(spend) FILTER (date < {AS_OF} - 30), 0) AS ad_60,
    sum(impressions) FILTER (date >= {AS_OF} - 30 AND date <= {AS_OF}) AS impressions_30,
    sum(clicks) FILTER (date >= {AS_OF} - 30 AND date <= {AS_OF}) AS clicks_30, sum(conversions) FILTER (date >= {AS_OF} - 30 AND date <= {AS_OF}) AS conversions_30
  FROM stg_ads WHERE platform IN ('shopee_ads', 'lazada_ads', 'tiktok_ads') AND date >= {AS_OF} - 60 AND date <= {AS_OF} GROUP BY ALL
) AS a ON a.shop = o.platform
""",
)
_CHANNEL_SELECT = """
SELECT coalesce(a.date, g.date) AS date, coalesce(a.platform, g.platform) AS platform, coalesce(spend, 0) AS spend,
  coalesce(impressions, 0) AS impressions, coalesce(reach, 0) AS reach, coalesce(clicks, 0) AS clicks,
  clicks / nullif(impressions, 0) AS ctr, spend / nullif(clicks, 0) AS cpc, 1000 * spend / nullif(impressions, 0) AS cpm,
  coalesce(conversions, 0) AS platform_conversions, coalesce(conversion_value, 0) AS platform_conversion_value,
  spend / nullif(conversions, 0) AS cost_per_conversion, conversion_value / nullif(spend, 0) AS platform_roas,
  coalesce(video_views, 0) AS video_views, coalesce(likes, 0) AS likes, coalesce(comments, 0) AS comments,
  coalesce(shares, 0) AS shares, likes + comments + shares AS total_engagement,
  (likes + comments + shares) / nullif(impressions, 0) AS engagement_rate,
  coalesce(active_campaigns, 0) AS active_campaigns, coalesce(active_ads, 0) AS active_ads,
  coalesce(sessions, 0) AS ga4_sessions, coalesce(users, 0) AS ga4_users, coalesce(new_users, 0) AS ga4_new_users,
  bounce AS ga4_bounce_rate, duration AS ga4_avg_session_duration,
  coalesce(transactions, 0) AS ga4_transactions, coalesce(revenue, 0) AS ga4_revenue,
  transactions / nullif(sessions, 0) AS ga4_conversion_rate, revenue / nullif(spend, 0) AS ga4_roas,
  spend / nullif(sessions, 0) AS cost_per_session, spend / nullif(transactions, 0) AS cost_per_acquisition,
  spend / nullif(users, 0) AS cost_per_user, revenue / nullif(users, 0) AS revenue_per_user
FROM channel_ads AS a FULL JOIN channel_web AS g ON a.date = g.date AND a.platform = g.platform
LEFT JOIN channel_sales AS c ON """
stage(
    "channel_ads",
    ("stg_ads",),
    f"""
SELECT date, platform, sum(spend) AS spend, sum(impressions) AS impressions, sum(clicks) AS clicks, sum(reach) AS reach,
  sum(conversions) AS conversions, sum(conversion_value) AS conversion_value, sum(video_views) AS video_views,
  sum(likes) AS likes, sum(comments) AS comments, sum(shares) AS shares,
  count(DISTINCT campaign_id) AS active_campaigns, count(DISTINCT ad_id) AS active_ads
FROM stg_ads WHERE date >= {AS_OF} - 90 AND date <= {AS_OF} GROUP BY ALL
""",
)
stage(
    "channel_web",
    ("stg_ga4_sessions",),
    f"""
SELECT date, {CHANNEL} AS platform, sum(sessions) AS sessions, sum(total_users) AS users, sum(new_users) AS new_users,
  avg(bounce_rate) AS bounce, avg(avg_session_duration) AS duration
FROM stg_ga4_sessions WHERE date >= {AS_OF} - 90 AND date <= {AS_OF} GROUP BY ALL
""",
)
stage(
    "channel_sales",
    ("stg_ga4_sessions",),
    f"""
SELECT date, {CHANNEL} AS platform, sum(transactions) AS transactions, sum(revenue) AS revenue
FROM stg_ga4_sessions WHERE date >= {AS_OF} - 90 AND date <= {AS_OF} GROUP BY ALL
""",
)
stage(
    "channel_mart",
    ("channel_ads", "channel_web", "channel_sales"),
    _CHANNEL_SELECT + "a.date = c.date AND a.platform = c.platform",
)
stage(
    "channel_filled",
    ("channel_ads", "channel_web", "channel_sales"),
    _CHANNEL_SELECT + "coalesce(a.date, g.date) = c.date AND coalesce(a.platform, g.platform) = c.platform",
)
stage(
    "campaign_day",
    ("stg_ads",),
    f"""
SELECT date, platform, account_id, campaign_id, campaign_name, campaign_type, objective, status, sum(spend) AS spend,
  sum(impressions) AS impressions, sum(clicks) AS clicks, sum(reach) AS reach, sum(conversions) AS conversions,
  sum(conversion_value) AS conversion_value, sum(video_views) AS video_views, sum(likes) AS likes,
  sum(comments) AS comments, sum(shares) AS shares, count(DISTINCT adgroup_id) AS active_adgroups,
  count(DISTINCT ad_id) AS active_ads
FROM stg_ads WHERE date >= {AS_OF} - 90 AND date <= {AS_OF} AND level IN ('campaign', 'ad', 'adgroup') GROUP BY ALL
""",
)
stage(
    "campaign_bench",
    ("campaign_day",),
    f"""
SELECT platform, avg(clicks / nullif(impressions, 0)) AS b_ctr, avg(spend / nullif(clicks, 0)) AS b_cpc,
  avg(conversion_value / nullif(spend, 0)) AS b_roas
FROM campaign_day WHERE date >= {AS_OF} - 30 AND date <= {AS_OF} GROUP BY platform
""",
)
stage(
    "campaign_past",
    ("campaign_day",),
    f"""
SELECT platform, campaign_id, min(date) AS first_active_date, max(date) AS last_active_date,
  count(DISTINCT date) AS days_active, coalesce(sum(spend) FILTER (date >= {AS_OF} - 7 AND date <= {AS_OF}), 0) AS spend_7d,
  coalesce(sum(spend) FILTER (date >= {AS_OF} - 14 AND date <= {AS_OF} AND date < {AS_OF} - 7), 0) AS spend_prev_7d,
  coalesce(sum(conversion_value) FILTER (date >= {AS_OF} - 7 AND date <= {AS_OF}), 0) AS conv_value_7d,
  coalesce(sum(conversion_value) FILTER (date >= {AS_OF} - 14 AND date <= {AS_OF} AND date < {AS_OF} - 7), 0) AS conv_value_prev_7d
FROM campaign_day WHERE date >= {AS_OF} - 30 AND date <= {AS_OF} GROUP BY ALL
""",
)
stage(
    "campaign_mart",
    ("campaign_day", "campaign_bench", "campaign_past"),
    """
SELECT *, CASE WHEN spend > 0 AND roas > b_roas * 1.5 THEN 'top_performer' WHEN spend > 0 AND roas > b_roas THEN 'good'
    WHEN spend > 0 AND roas < b_roas * 0.5 THEN 'underperforming' WHEN days_active < 7 THEN 'learning'
    WHEN status = 'paused' THEN 'paused' ELSE 'average' END AS performance_status,
  CASE WHEN ctr < b_ctr * 0.7 THEN 'low_ctr' WHEN cpc > b_cpc * 1.3 THEN 'high_cpc'
    WHEN conversion_rate < 0.01 THEN 'low_cvr' END AS optimization_flag,
  ctr - b_ctr AS ctr_vs_benchmark, cpc - b_cpc AS cpc_vs_benchmark, roas - b_roas AS roas_vs_benchmark
FROM (
  SELECT d.*, b.* EXCLUDE (platform), p.* EXCLUDE (platform, campaign_id),
    clicks / nullif(impressions, 0) AS ctr, spend / nullif(clicks, 0) AS cpc, 1000 * spend / nullif(impressions, 0) AS cpm,
    spend / nullif(conversions, 0) AS cost_per_conversion, conversions / nullif(clicks, 0) AS conversion_rate,
    conversion_value / nullif(spend, 0) AS roas, video_views / nullif(impressions, 0) AS video_view_rate,
    likes + comments + shares AS total_engagement,
    (likes + comments + shares) / nullif(impressions, 0) AS engagement_rate,
    (spend_7d - spend_prev_7d) / nullif(spend_prev_7d, 0) AS spend_change_wow,
    (conv_value_7d - conv_value_prev_7d) / nullif(conv_value_prev_7d, 0) AS conv_value_change_wow
  FROM campaign_day AS d LEFT JOIN campaign_bench AS b ON d.platform = b.platform
  LEFT JOIN campaign_past AS p ON d.platform = p.platform AND d.campaign_id = p.campaign_id)
""",
)
stage(
    "items_mapped",
    ("stg_order_items", "stg_sku_mappings", "stg_orders"),
    f"""
SELECT i.*, coalesce(m.master_sku, i.sku) AS master_sku, o.status AS order_status
FROM stg_order_items AS i
LEFT JOIN stg_sku_mappings AS m ON m.platform = i.platform AND m.platform_sku = i.sku
LEFT JOIN stg_orders AS o ON o.order_id = i.order_id
WHERE i.order_date >= {AS_OF} - INTERVAL 90 DAY AND i.order_date < {AS_OF} + INTERVAL 1 DAY
""",
)
stage(
    "product_day",
    ("items_mapped",),
    """
SELECT CAST(order_date AS DATE) AS date, master_sku, platform, name AS product_name, variation,
  sum(quantity) AS units_sold, sum(total_price) AS gross_revenue, sum(total_price - discount) AS net_revenue,
  sum(discount) AS total_discount, count(DISTINCT order_id) AS order_count,
  coalesce(sum(quantity) FILTER (order_status = 'completed'), 0) AS units_completed,
  coalesce(sum(total_price) FILTER (order_status = 'completed'), 0) AS revenue_completed,
  coalesce(sum(quantity) FILTER (order_status = 'cancelled'), 0) AS units_cancelled,
  avg(unit_price) AS avg_unit_price, avg(quantity) AS avg_quantity_per_order
FROM items_mapped GROUP BY ALL
""",
)
stage(
    "products_mapped",
    ("stg_products", "stg_sku_mappings"),
    """
SELECT p.*, coalesce(m.master_sku, p.sku) AS master_sku FROM stg_products AS p
LEFT JOIN stg_sku_mappings AS m ON m.platform = p.platform AND m.platform_sku = p.sku
""",
)
stage(
    "product_names",
    ("products_mapped",),
    """
SELECT DISTINCT ON (master_sku) master_sku, name AS canonical_name, category, brand
FROM products_mapped ORDER BY master_sku, seen_order DESC, product_id DESC, sku DESC
""",
)
stage(
    "product_offers",
    ("products_mapped",),
    """
SELECT DISTINCT ON (master_sku, platform) master_sku, platform, unit_price AS current_price, is_active
FROM products_mapped ORDER BY master_sku, platform, seen_order DESC, product_id DESC, sku DESC
""",
)
stage(
    "product_past",
    ("product_day",),
    f"""
SELECT master_sku, platform, coalesce(sum(units_sold) FILTER (date >= {AS_OF} - 7 AND date <= {AS_OF}), 0) AS units_7d,
  coalesce(sum(units_sold) FILTER (date >= {AS_OF} - 14 AND date <= {AS_OF} AND date < {AS_OF} - 7), 0) AS units_prev_7d,
  coalesce(sum(units_sold) FILTER (date >= {AS_OF} - 30 AND date <= {AS_OF}), 0) AS units_30d,
  coalesce(sum(units_sold) FILTER (date >= {AS_OF} - 60 AND date <= {AS_OF} AND date < {AS_OF} - 30), 0) AS units_prev_30d,
  coalesce(sum(net_revenue) FILTER (date >= {AS_OF} - 30 AND date <= {AS_OF}), 0) AS revenue_30d,
  coalesce(sum(net_revenue) FILTER (date >= {AS_OF} - 60 AND date <= {AS_OF} AND date < {AS_OF} - 30), 0) AS revenue_prev_30d
FROM product_day GROUP BY ALL
""",
)
_PRODUCT_SELECT = """
SELECT d.*, canonical_name, category, brand, current_price, is_active, p.* EXCLUDE (master_sku, platform),
  net_revenue / nullif(order_count, 0) AS avg_order_value, total_discount / nullif(gross_revenue, 0) AS discount_rate,
  (units_7d - units_prev_7d) / nullif(units_prev_7d, 0) AS units_growth_wow,
  (units_30d - units_prev_30d) / nullif(units_prev_30d, 0) AS units_growth_mom,
  (revenue_30d - revenue_prev_30d) / nullif(revenue_prev_30d, 0) AS revenue_growth_mom,
  units_cancelled / nullif(units_sold, 0) AS cancellation_rate, units_completed / nullif(units_sold, 0) AS completion_rate
FROM product_day AS d
LEFT JOIN {offers} AS f ON f.master_sku = d.master_sku AND f.platform = d.platform
LEFT JOIN product_names AS n ON n.master_sku = f.master_sku
LEFT JOIN product_past AS p ON p.master_sku = d.master_sku AND p.platform = d.platform
"""
stage(
    "product_mart",
    ("product_day", "product_names", "product_offers", "product_past"),
    _PRODUCT_SELECT.format(offers="product_offers"),
)
stage(
    "product_fanned",
    ("product_day", "product_names", "products_mapped", "product_past"),
    _PRODUCT_SELECT.format(
        offers="(SELECT master_sku, platform, unit_price AS current_price, is_active FROM products_mapped)"
    ),
)
NUM = "regexp_replace(CAST(CAST(round({0}, {1}) AS DECIMAL(38, {1})) AS VARCHAR), '\\.?0+$', '')"


def number(x: str, places: int = 2) -> str:
    return NUM.format(x, places)


stage(
    "revenue_weeks",
    ("daily_mart",),
    f"""
SELECT platform, now, before, (now - before) / before AS drop_rate FROM (
  SELECT platform, coalesce(sum(net_revenue) FILTER (date >= {AS_OF} - 7 AND date <= {AS_OF}), 0) AS now,
    coalesce(sum(net_revenue) FILTER (date < {AS_OF} - 7), 0) AS before
  FROM daily_mart WHERE date >= {AS_OF} - 14 AND date <= {AS_OF} AND date < {AS_OF} GROUP BY platform) WHERE before > 0
""",
)
stage(
    "alerts",
    ("daily_mart", "campaign_mart", "revenue_weeks"),
    f"""
SELECT 'low_roas' AS alert_type, CASE WHEN roas < 1.5 THEN 'critical' ELSE 'warning' END AS severity,
  CASE WHEN roas < 1.5 THEN 'Low ROAS: ' ELSE 'Low ROAS Warning: ' END || platform AS title,
  'ROAS is ' || {number('roas')} || CASE WHEN roas < 1.5 THEN ', below critical threshold of 1.5'
    ELSE ', below warning threshold of 2.0' END AS message,
  'roas' AS metric_name, roas AS metric_value, CASE WHEN roas < 1.5 THEN 1.5 ELSE 2.0 END AS threshold, platform,
  'daily' AS entity_type, platform || '_' || date AS entity_id, platform || ' - ' || date AS entity_name,
  date AS alert_date, net_revenue, total_ad_spend, cpa
FROM daily_mart WHERE date = {AS_OF} - 1 AND roas < 2.0 AND total_ad_spend > 0
UNION ALL
SELECT 'high_cpa', CASE WHEN cpa > 500 THEN 'critical' ELSE 'warning' END,
  CASE WHEN cpa > 500 THEN 'High CPA: ' ELSE 'High CPA Warning: ' END || platform,
  'CPA is ' || {number('cpa')} || ' THB, above ' || CASE WHEN cpa > 500 THEN 'critical threshold of 500 THB'
    ELSE 'warning threshold of 300 THB' END,
  'cpa', cpa, CASE WHEN cpa > 500 THEN 500.0 ELSE 300.0 END, platform, 'daily', platform || '_' || date,
  platform || ' - ' || date, date, net_revenue, total_ad_spend, cpa
FROM daily_mart WHERE date = {AS_OF} - 1 AND cpa > 300
UNION ALL
SELECT 'revenue_drop', CASE WHEN drop_rate < -0.3 THEN 'critical' ELSE 'warning' END,
  'Revenue Drop ' || CASE WHEN drop_rate < -0.3 THEN 'Critical: ' ELSE 'Warning: ' END || platform,
  'Revenue dropped by ' || {number('abs(drop_rate) * 100', 1)} || '% WoW (from ' || {number('before')} || ' to '
    || {number('now')} || ')',
  'revenue_change_pct', drop_rate, CASE WHEN drop_rate < -0.3 THEN -0.3 ELSE -0.2 END, platform, 'weekly',
  platform || '_week_' || CAST({AS_OF} - 7 AS DATE), platform || ' Weekly Revenue', CAST({AS_OF} - 1 AS DATE), now, NULL, NULL
FROM revenue_weeks WHERE drop_rate < -0.2
UNION ALL
SELECT 'campaign_underperforming', 'warning', 'Underperforming Campaign: ' || campaign_name,
  'Campaign ROAS (' || {number('roas')} || ') is significantly below platform benchmark', 'roas', roas, NULL, platform,
  'campaign', campaign_id, campaign_name, date, conversion_value, spend, cost_per_conversion
FROM campaign_mart WHERE date = {AS_OF} - 1 AND performance_status = 'underperforming' AND spend > 100
""",
)
