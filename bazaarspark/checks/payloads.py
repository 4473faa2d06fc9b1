"""Registered normalisers, routing, SKU operations, raw indexes, sources and functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bazaarspark.checks import records
from bazaarspark.checks.framework import Check
from bazaarspark.checks.sql_staging import AS_OF as D
from bazaarspark.checks.sql_staging import pick, using
from bazaarspark.checks.staging import AS_OF, Staging
from bazaarspark.functions import dates, labels, money, scalars
from bazaarspark.operators import ranking, shares, sku
from bazaarspark.operators.dedupe import keep_one
from bazaarspark.plans.ads_payloads import normalize_ads
from bazaarspark.plans.order_payloads import normalize_orders, order_items
from bazaarspark.plans.product_payloads import normalize_products
from bazaarspark.plans.web_payloads import normalize_web
from bazaarspark.sources import landing, raw_index, store

RUN_AT = dt.datetime(2001, 8, 1, tzinfo=dt.timezone.utc)


def stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def orders_of(platform: str):
    def build(s: Staging):
        good = normalize_orders(records.landed_orders(s), RUN_AT).good
        return good.where(F.col("platform") == platform).withColumns(
            {c: stamp(c) for c in ("order_date", "completed_date", "extracted_at")}
        )

    return build


def google_levels(s: Staging):
    """Google rows as reports of four levels; which of them follows from the campaign."""
    number = F.get_json_object("payload", "$.campaign.id").cast("long")
    level = records.code(F.floor(number / 6), ("campaign", "adgroup", "ad", "keyword"))
    raw = records.landed_ads(s).where(F.col("customer_id") == "cust").withColumn("type", level)
    days = ("2000-01-01", "2000-12-31")
    present = {}
    for name, parts in landing.GOOGLE_LEVELS.items():
        present[name] = ",".join(c for c in landing.google_rows(raw, name, *days).columns if c in parts)
    rows = landing.google_reports(raw.where(F.col("type").isin(*present)), *days)
    sums = rows.groupBy(F.col("type").alias("level"), F.col("campaign.id").alias("campaign_id"), "date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("metrics")["impressions"].cast("long")).alias("impressions")
    )
    return sums.withColumn("parts", F.element_at(F.create_map(*[F.lit(x) for i in present.items() for x in i]), F.col("level")))


def landed_entities(s: Staging):
    """One structure record per supplier, each kind with its own identifier."""
    key = F.col("s_suppkey")
    kinds = ("campaign", "adset", "adgroup", "ad", "product_ad", "shop_ad")
    named = ("campaign_id", "adset_id", "adgroup_id", "ad_id", "product_id", "item_id")
    own = {
        n: F.when(F.pmod(key, F.lit(6)) == i, F.concat(F.lit(p), key.cast("string")))
        for i, (n, p) in enumerate(zip(named, "csgapi"))
    }
    own["campaign_id"] = F.concat(F.lit("c"), key.cast("string"))
    body = F.struct(
        *[c.alias(n) for n, c in own.items()],
        F.when(key % 3 == 0, F.col("s_name")).alias("name"),
        F.col("s_name").alias("campaign_name"),
        records.code(key, ("ACTIVE", "Paused")).alias("status"),
        F.when(key % 2 == 0, key).alias("budget"),
        (key * 2).cast("string").alias("daily_budget"),
    )
    platform = records.code(key, ("facebook_ads", "tiktok_ads", "shopee_ads"))
    whole = F.struct(records.code(key, kinds).alias("type"), platform.alias("platform"), body.alias("data"))
    return landing.from_text(s.table("supplier").select(F.to_json(whole).alias("value")))


def impossible_values(s: Staging):
    """Orders some of whose amounts or times no column can hold: they are dead letters and end no job."""
    key, case = F.col("o_orderkey"), F.pmod(F.floor(F.col("o_orderkey") / 3), F.lit(7))
    amount = F.when(case == 1, "1e30").when(case == 2, "Infinity").when(case == 3, "NaN").otherwise(F.col("o_totalprice").cast("string"))
    seconds = F.unix_seconds(F.col("o_orderdate").cast("timestamp"))
    at = F.when(case == 4, seconds * 1000).when(case == 5, seconds * 1_000_000).when(case == 6, F.lit(86_400)).otherwise(seconds)
    number = key.cast("string")
    payload = (
        F.when(key % 3 == 0, F.to_json(F.struct(number.alias("order_sn"), amount.alias("total_amount"), at.alias("create_time"))))
        .when(
            key % 3 == 1,
            F.to_json(
                F.struct(
                    number.alias("order_id"), amount.alias("price"), at.cast("string").alias("created_at"),
                    F.array(F.lit("shipped")).alias("statuses"), F.array(F.struct(F.lit("1").alias("order_item_id"))).alias("order_items"),
                )
            ),
        )
        .otherwise(
            F.to_json(
                F.struct(
                    number.alias("order_id"), number.alias("buyer_uid"), at.alias("create_time"),
                    F.struct(amount.alias("sub_total"), amount.alias("total_amount")).alias("payment_info"),
                )
            )
        )
    )
    parts = normalize_orders(landing.from_text(s.table("orders").select(payload.alias("value"))), RUN_AT)
    good = parts.good.where(F.col("order_date").isNotNull() & F.col("total").isNotNull())
    rows = good.select("platform", F.lit("good").alias("outcome")).union(parts.dead.select("source_platform", "error_type"))
    return rows.groupBy("platform", "outcome").agg(F.count(F.lit(1)).alias("records"))


ORDER_COLUMNS = (
    "s order_id platform platform_order_id customer_id customer_name status status_raw order_date completed_date;"
    " m subtotal shipping_fee discount total; s currency currency_raw shipping_address; l item_count; s extracted_at"
)
# Orders that are neither cut off nor without an identifier, with their number of lines.
ORDER_BASE = """
SELECT o.*, coalesce(n, 0) AS item_count, coalesce(lines_total, 0) AS lines_total,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_date, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S') AS next_day,
  '2001-08-01 00:00:00' AS extracted_at, 'THB' AS currency, CAST(o_orderkey AS VARCHAR) AS platform_order_id
FROM orders AS o LEFT JOIN (SELECT l_orderkey, count(*) AS n,
  sum(floor(l_extendedprice) * CAST(l_quantity AS BIGINT)) AS lines_total FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
WHERE o_orderkey % 13 <> 0"""


def thb(x: str) -> str:
    return f"CAST(round(CAST(({x}) AS DECIMAL(18,4)) * rate, 2) AS DOUBLE)"


ITEM_BASE = f"""
SELECT l.*, o_custkey % 3 AS shop, o_orderkey, {pick('o_custkey', 'shopee', 'lazada', 'tiktok_shop')} AS platform,
  {pick('o_custkey', 'shopee', 'lazada', 'tiktok')} || '_' || o_orderkey AS order_id,
  l_linenumber || '-' || l_partkey || '-' || l_suppkey AS line_id, CAST(l_quantity AS BIGINT) AS quantity
FROM lineitem AS l JOIN orders ON o_orderkey = l_orderkey
WHERE o_orderkey % 13 <> 0 AND (o_custkey % 3 <> 0 OR o_orderkey % 11 <> 0)"""

AD_COLUMNS = (
    "s record_id platform account_id campaign_id adgroup_id ad_id; l impressions clicks reach; m spend spend_raw;"
    " s currency_raw; l conversions; m conversion_value cost_per_conversion; r conversion_rate; l likes shares;"
    " s status campaign_type level; d date"
)


def ads_of(*platforms: str):
    return lambda s: normalize_ads(records.landed_ads(s), RUN_AT, platforms).good


AD_BASE = f"""
SELECT *, CAST(l_shipdate AS DATE) AS date, CAST(floor(l_quantity * 100) AS BIGINT) AS impressions,
  CAST(floor(l_quantity * l_tax * 10) AS BIGINT) AS clicks, floor(l_extendedprice) AS price,
  l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS number, l_suppkey AS campaign_id,
  CAST(l_partkey % 4 AS VARCHAR) AS adgroup_id
FROM lineitem"""
NONE = "CAST(NULL AS VARCHAR)"


def visits_sql(kind: str, key: str, condition: str = "true") -> str:
    return f"""
SELECT *, 'ga4_{kind}_properties/1_' || {key} || '_' || source || '_' || (CASE medium WHEN 'organic' THEN '(not set)' ELSE medium END)
  || '_None' AS record_id, CASE WHEN medium <> 'organic' THEN medium END AS shown_medium
FROM stg_ga4_sessions WHERE {condition}"""


def landed_map(s: Staging):
    """Mapping rows as a hand-kept file has them: blanks, odd cases, unknown platforms, later overwrites."""
    m = s.sku_map.withColumn("n", F.regexp_extract("platform_sku", r"(\d+)$", 1).cast("long"))
    dirty = m.select(
        F.when(F.col("n") % 31 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" "), "master_sku", F.lit(" "))).alias("master_sku"),
        F.when(F.col("n") % 37 == 0, F.lit("amazon")).otherwise(F.upper("platform")).alias("platform"),
        F.concat("platform_sku", F.lit(" ")).alias("platform_sku"),
        "product_name",
        "variation",
        F.lit("").alias("notes"),
        F.lit(1).alias("line"),
        "n",
    )
    later = dirty.where(F.col("n") % 5 == 0).withColumns({"master_sku": F.concat(F.lit("NEW-"), F.col("n")), "line": F.lit(2)})
    return sku.cleaned(dirty.unionByName(later).drop("n"))


# The same mapping after cleaning; later rows win.
CLEAN_MAP = using("stg_sku_mappings") + """, dirty AS (
SELECT *, CAST(regexp_extract(platform_sku, '([0-9]+)$', 1) AS BIGINT) AS n FROM stg_sku_mappings),
clean AS (SELECT platform, platform_sku, product_name, variation, CASE WHEN n % 5 = 0 THEN 'NEW-' || n ELSE master_sku END AS master_sku
  FROM dirty WHERE n % 37 <> 0 AND (n % 31 <> 0 OR n % 5 = 0))
"""


def newest_map(s: Staging):
    return sku.latest_mapping(landed_map(s), "line")


def pages_as_responses(s: Staging):
    """Response pages of 50 orders each, as landed JSON documents."""
    o = s.table("orders").select(
        F.floor(F.col("o_orderkey") / 50).alias("page"),
        F.struct(F.col("o_orderkey").cast("string").alias("order_sn"), F.col("o_totalprice").alias("amount")).alias("order"),
    )
    return o.groupBy("page").agg(
        F.to_json(F.struct(F.struct(F.sort_array(F.collect_list("order")).alias("order_list")).alias("response"))).alias("body")
    )


def positional_reports(s: Staging):
    """Reports with header arrays and positional values, one report per day."""
    row = F.struct(
        F.array("source", "medium").alias("dimension_values"),
        F.array(F.col("sessions").cast("string"), F.col("total_users").cast("string")).alias("metric_values"),
    )
    return s.sessions.groupBy("date").agg(F.sort_array(F.collect_list(row)).alias("rows")).select(
        "date",
        F.array(F.lit("sessionSource"), F.lit("sessionMedium")).alias("dims"),
        F.array(F.lit("sessions"), F.lit("totalUsers")).alias("mets"),
        "rows",
    )


def order_page():
    """Texts with one prefix, a third of them the same."""
    page = F.when(F.col("o_orderkey") % 3 == 0, "home").otherwise(F.col("o_custkey").cast("string"))
    return F.concat(F.lit("https://shop.example/p/"), page)


FX_CODES = ("USD", "EUR", "THB", "JPY", "PHP", "XXX")
FX_TARGETS = ("THB", "USD", "EUR", "GBP")
FX_SQL = {
    ("USD", "THB"): "35", ("USD", "USD"): "1", ("USD", "EUR"): "0.9205", ("USD", "GBP"): "1",
    ("EUR", "THB"): "38", ("EUR", "USD"): "1.0868", ("EUR", "EUR"): "1", ("EUR", "GBP"): "1",
    ("THB", "THB"): "1", ("THB", "USD"): "0.0286", ("THB", "EUR"): "0.0263", ("THB", "GBP"): "0.0227",
    ("JPY", "THB"): "0.24", ("JPY", "USD"): "0.006864", ("JPY", "EUR"): "0.006312", ("JPY", "GBP"): "1",
    ("PHP", "THB"): "0.63", ("PHP", "USD"): "0.018018", ("PHP", "EUR"): "0.016569", ("PHP", "GBP"): "1",
    ("XXX", "THB"): "1", ("XXX", "USD"): "1", ("XXX", "EUR"): "1", ("XXX", "GBP"): "1",
}
FX_VALUES = ", ".join(f"('{a}', '{b}', CAST({r} AS DECIMAL(20,18)))" for (a, b), r in FX_SQL.items())
UPSERT_KEYS = ["customer_id"]


def customer_state(s: Staging, until: str):
    """Latest order per customer of orders up to a day: a table that changes over time."""
    o = s.orders.where(F.col("order_date") < F.lit(until).cast("timestamp"))
    return o.select("customer_id", "order_id", "total", "order_date")


CHECKS = [
    Check(
        "n1_shopee_orders",
        ORDER_COLUMNS,
        orders_of("shopee"),
        f"""SELECT *, 'shopee_' || o_orderkey AS order_id, 'shopee' AS platform, CAST(o_custkey AS VARCHAR) AS customer_id,
  'Buyer ' || o_custkey AS customer_name, {pick('0', 'x')} AS dummy,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
  CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'UNPAID' ELSE 'CANCELLED' END AS status_raw,
  CASE WHEN o_orderstatus = 'F' THEN next_day END AS completed_date, {thb('o_totalprice')} AS subtotal, {thb('o_totalprice')} AS total,
  {thb("CASE WHEN o_custkey % 3 = 0 THEN 7.5 ELSE o_custkey % 3 END")} AS shipping_fee,
  {thb('CASE WHEN o_orderkey % 3 = 0 THEN 2.5 ELSE o_orderkey % 3 END')} AS discount,
  CASE WHEN o_orderkey % 2 = 0 THEN o_custkey || ' Main St, Bangkok' ELSE 'Bangkok' END AS shipping_address
FROM (SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN 'USD' ELSE 'THB' END AS currency_raw,
  CASE WHEN o_orderkey % 4 = 0 THEN 35 ELSE 1 END AS rate FROM ({ORDER_BASE}))
WHERE o_custkey % 3 = 0 AND o_orderkey % 11 <> 0""",
    ),
    Check(
        "n3_lazada_orders",
        ORDER_COLUMNS,
        orders_of("lazada"),
        f"""SELECT * REPLACE (CASE WHEN o_orderkey % 5 = 0 THEN 0 WHEN o_orderkey % 5 = 1 THEN subtotal - discount + shipping_fee
    ELSE o_totalprice END AS total) FROM (
SELECT *, 0.0 AS total, 'lazada_' || o_orderkey AS order_id, 'lazada' AS platform, CAST(o_custkey AS VARCHAR) AS customer_id,
  'C' || o_custkey AS customer_name,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status,
  CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status_raw,
  CASE WHEN o_orderstatus = 'F' THEN next_day END AS completed_date,
  CASE WHEN o_orderkey % 5 IN (0, 1) THEN lines_total ELSE o_totalprice END AS subtotal,
  CAST(o_custkey % 50 AS DOUBLE) AS shipping_fee, 5.0 + CASE WHEN o_orderkey % 2 = 0 THEN 2.0 ELSE 0 END AS discount,
  'THB' AS currency_raw, '1 Second St, 11000' AS shipping_address
FROM ({ORDER_BASE}) WHERE o_custkey % 3 = 1)""",
    ),
    Check(
        "n5_tiktok_orders",
        ORDER_COLUMNS,
        orders_of("tiktok_shop"),
        f"""SELECT *, CASE WHEN o_orderkey % 4 = 0 THEN subtotal + shipping_fee - discount ELSE subtotal + 1 END AS total FROM (
SELECT *, 'tiktok_' || o_orderkey AS order_id, 'tiktok_shop' AS platform, 'u' || o_custkey AS customer_id, {NONE} AS customer_name,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'on_hold' END AS status,
  CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'UNPAID' ELSE 'ON_HOLD' END AS status_raw,
  {NONE} AS completed_date, floor(o_totalprice) AS subtotal, 0.0 AS shipping_fee, 10.0 + o_orderkey % 3 AS discount,
  'THB' AS currency_raw, {NONE} AS shipping_address
FROM ({ORDER_BASE}) WHERE o_custkey % 3 = 2)""",
    ),
    Check(
        "n19_order_items",
        "s item_id order_id platform product_id sku name; l quantity; m unit_price total_price discount",
        lambda s: order_items(normalize_orders(records.landed_orders(s), RUN_AT).good),
        f"""SELECT order_id, platform, CASE shop WHEN 0 THEN CAST(l_partkey AS VARCHAR) ELSE line_id END AS item_id,
  CAST(l_partkey AS VARCHAR) AS product_id, upper(substr(platform, 1, 3)) || '-' || l_partkey AS sku,
  'Item ' || l_partkey AS name, quantity, unit_price, unit_price * quantity AS total_price,
  CASE shop WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS discount
FROM (SELECT *, floor(l_extendedprice) + CASE WHEN shop = 0 AND l_linenumber = 1 THEN 1 ELSE 0 END AS unit_price FROM ({ITEM_BASE}))""",
    ),
    Check(
        "r13_order_dead_letters",
        "s error_type error source_platform; l records",
        lambda s: normalize_orders(records.landed_orders(s), RUN_AT)
        # What is left of a broken text may or may not name its platform.
        .dead.groupBy("error_type", "error", F.when(F.col("error_type") != "JSONDecodeError", F.col("source_platform")).alias("source_platform"))
        .agg(F.count(F.lit(1)).alias("records")),
        """SELECT 'MappingError' AS error_type, 'Missing order_sn' AS error, 'shopee' AS source_platform, count(*) AS records
FROM orders WHERE o_custkey % 3 = 0 AND o_orderkey % 11 = 0 AND o_orderkey % 13 <> 0 HAVING count(*) > 0
UNION ALL SELECT 'JSONDecodeError', 'record is not a JSON object', NULL, count(*)
FROM orders WHERE o_orderkey % 13 = 0 HAVING count(*) > 0""",
    ),
    Check(
        "r13b_dead_and_good_add_up",
        "s outcome; l records",
        lambda s: (
            lambda parts: parts.good.select(F.lit("good").alias("outcome"))
            .union(parts.dead.select("error_type"))
            .groupBy("outcome")
            .agg(F.count(F.lit(1)).alias("records"))
        )(normalize_orders(records.landed_orders(s), RUN_AT)),
        """SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'JSONDecodeError' WHEN o_custkey % 3 = 0 AND o_orderkey % 11 = 0 THEN 'MappingError'
  ELSE 'good' END AS outcome, count(*) AS records FROM orders GROUP BY ALL""",
    ),
    Check(
        "r1_order_platform_detection",
        "s platform; l orders",
        lambda s: normalize_orders(records.landed_orders(s, named=False), RUN_AT)
        .good.groupBy("platform")
        .agg(F.count(F.lit(1)).alias("orders")),
        """SELECT CASE o_custkey % 3 WHEN 0 THEN 'shopee' WHEN 1 THEN 'lazada' ELSE 'tiktok_shop' END AS platform, count(*) AS orders
FROM orders WHERE o_orderkey % 13 <> 0 AND (o_custkey % 3 <> 0 OR o_orderkey % 11 <> 0) GROUP BY ALL""",
    ),
    Check(
        "n8_facebook_ads",
        AD_COLUMNS,
        ads_of("facebook_ads"),
        f"""SELECT *, 'fb_' || campaign_id || '_' || adgroup_id || '_' || number AS record_id, 'facebook_ads' AS platform,
  'act' AS account_id, number AS ad_id, CASE WHEN l_partkey % 2 = 0 THEN floor(l_quantity * 60) END AS reach,
  (l_quantity + 0.25) * 35 AS spend, l_quantity + 0.25 AS spend_raw, 'USD' AS currency_raw,
  l_linenumber + 2 AS conversions, 0 AS conversion_value, l_linenumber * 35 AS cost_per_conversion,
  CAST(NULL AS DOUBLE) AS conversion_rate, CAST(NULL AS BIGINT) AS likes, CAST(NULL AS BIGINT) AS shares, {NONE} AS status,
  CASE l_partkey % 3 WHEN 0 THEN 'sales' WHEN 1 THEN 'other' END AS campaign_type, 'ad' AS level
FROM ({AD_BASE}) WHERE l_suppkey % 6 = 0""",
    ),
    Check(
        "n12_google_ads",
        AD_COLUMNS,
        ads_of("google_ads"),
        f"""SELECT *, 'gads_' || campaign_id || '_' || adgroup_id || '_' || number AS record_id, 'google_ads' AS platform,
  'cust' AS account_id, number AS ad_id, CAST(NULL AS BIGINT) AS reach, price AS spend, price AS spend_raw, 'THB' AS currency_raw,
  l_linenumber AS conversions, 2 * price AS conversion_value,
  CASE WHEN price > 0 THEN CAST(round(price / l_linenumber + 1e-9, 2) AS DOUBLE) END AS cost_per_conversion,
  CASE WHEN clicks > 0 THEN CAST(round(100.0 * l_linenumber / clicks + 1e-9, 2) AS DOUBLE) END AS conversion_rate,
  CAST(NULL AS BIGINT) AS likes, CAST(NULL AS BIGINT) AS shares, 'active' AS status, 'search' AS campaign_type, 'ad' AS level
FROM ({AD_BASE}) WHERE l_suppkey % 6 = 1""",
    ),
    Check(
        "n13_tiktok_ads",
        AD_COLUMNS,
        ads_of("tiktok_ads"),
        f"""SELECT *, 'tiktok_' || campaign_id || '_' || adgroup_id || '_' || number || '_' || date || ' 00:00:00' AS record_id,
  'tiktok_ads' AS platform, 'adv' AS account_id, number AS ad_id, CAST(NULL AS BIGINT) AS reach, price AS spend,
  price AS spend_raw, 'THB' AS currency_raw, l_linenumber AS conversions, 0 AS conversion_value,
  CAST(NULL AS DOUBLE) AS cost_per_conversion, CAST(NULL AS DOUBLE) AS conversion_rate, nullif(l_partkey % 3, 0) AS likes,
  0 AS shares, {NONE} AS status, {NONE} AS campaign_type, 'ad' AS level
FROM ({AD_BASE}) WHERE l_suppkey % 6 = 2 AND l_partkey % 7 <> 0""",
    ),
    Check(
        "n14_line_shopee_lazada_ads",
        AD_COLUMNS,
        ads_of("line_ads", "shopee_ads", "lazada_ads"),
        f"""SELECT * REPLACE (coalesce(campaign, '') AS campaign_id, {NONE} AS adgroup_id),
  CASE l_suppkey % 6 WHEN 3 THEN 'line' WHEN 4 THEN 'shopee' ELSE 'lazada' END || '_' || number || coalesce('_' || campaign, '') AS record_id,
  CASE l_suppkey % 6 WHEN 3 THEN 'line_ads' WHEN 4 THEN 'shopee_ads' ELSE 'lazada_ads' END AS platform,
  number AS account_id, {NONE} AS ad_id, CAST(NULL AS BIGINT) AS reach, price AS spend, price AS spend_raw,
  'THB' AS currency_raw, 0 AS conversions, 0 AS conversion_value, CAST(NULL AS DOUBLE) AS cost_per_conversion,
  CAST(NULL AS DOUBLE) AS conversion_rate, CAST(NULL AS BIGINT) AS likes, CAST(NULL AS BIGINT) AS shares, {NONE} AS status,
  {NONE} AS campaign_type, CASE WHEN campaign IS NULL THEN 'account' ELSE 'campaign' END AS level
FROM (SELECT *, CASE WHEN l_partkey % 2 = 0 THEN number END AS campaign FROM ({AD_BASE})) WHERE l_suppkey % 6 > 2""",
    ),
    Check(
        "r13c_ads_dead_letters",
        "s error_type error source_platform; l records",
        lambda s: normalize_ads(records.landed_ads(s), RUN_AT)
        .dead.groupBy("error_type", "error", "source_platform")
        .agg(F.count(F.lit(1)).alias("records")),
        f"""SELECT 'ValidationError' AS error_type, 'date is missing or unreadable' AS error, 'tiktok_ads' AS source_platform,
  count(*) AS records FROM lineitem WHERE l_suppkey % 6 = 2 AND l_partkey % 7 = 0 HAVING count(*) > 0""",
    ),
    Check(
        "n15_web_sessions",
        "s record_id property_id; d date; s source medium channel_grouping; l sessions engaged_sessions total_users new_users"
        " screen_page_views returning_users; r bounce_rate; m avg_session_duration session_duration_total",
        lambda s: normalize_web(records.landed_web(s), RUN_AT).sessions,
        using("stg_ga4_sessions")
        + """SELECT * EXCLUDE (channel_grouping), shown_medium AS medium, 0 AS screen_page_views, greatest(0, total_users - new_users) AS returning_users,
  avg_session_duration * sessions AS session_duration_total,
  CASE WHEN shown_medium IS NULL AND source IN ('facebook', 'tiktok') THEN 'Social'
    WHEN shown_medium IS NULL AND source <> '(direct)' THEN 'Other' WHEN shown_medium IS NULL THEN 'Direct' ELSE channel_grouping END
    AS channel_grouping FROM (SELECT * EXCLUDE (medium, screen_page_views) FROM (
"""
        + visits_sql("session", "CAST(date AS VARCHAR)")
        + "))",
    ),
    Check(
        "n16_web_traffic",
        "s record_id property_id; d date; s source medium; l sessions total_users new_users transactions; m revenue"
        " avg_order_value; r conversion_rate",
        lambda s: normalize_web(records.landed_web(s), RUN_AT).traffic,
        using("stg_ga4_sessions")
        + """SELECT *, shown_medium AS medium, revenue / nullif(transactions, 0) AS avg_order_value,
  100.0 * transactions / nullif(sessions, 0) AS conversion_rate FROM (SELECT * EXCLUDE (medium) FROM (
"""
        + visits_sql("traffic", "strftime(date, '%Y%m%d')")
        + "))",
    ),
    Check(
        "n17_web_pages",
        "s record_id property_id; d date; s page_path page_title; l page_views unique_page_views sessions entrances exits;"
        " m avg_time_on_page; r exit_rate",
        lambda s: normalize_web(records.landed_web(s), RUN_AT).pages,
        using("stg_ga4_pages")
        + """SELECT *, 'ga4_page_properties/1_' || strftime(date, '%Y%m%d') || '_' || replace(page_path, '/', '_') AS record_id
FROM stg_ga4_pages WHERE exits % 4 <> 0""",
    ),
    Check(
        "r4_web_dead_letters",
        "s error_type; l records",
        lambda s: normalize_web(records.landed_web(s), RUN_AT).dead.groupBy("error_type").agg(F.count(F.lit(1)).alias("records")),
        using("stg_ga4_pages")
        + "SELECT 'ValidationError' AS error_type, count(*) AS records FROM stg_ga4_pages WHERE exits % 4 = 0 HAVING count(*) > 0",
    ),
    Check(
        "n18_products_first_kept",
        "s product_id platform platform_product_id sku seller_sku name category brand; m unit_price original_price"
        " discount_price; s currency weight_unit; b is_active is_mapped; s extracted_at",
        lambda s: normalize_products(records.landed_products(s), RUN_AT).good.withColumn("extracted_at", stamp("extracted_at")),
        using("stg_products")
        + """SELECT * REPLACE (CASE platform WHEN 'tiktok_shop' THEN 'tiktok' ELSE platform END || '_' || p_partkey AS product_id),
  CASE WHEN platform <> 'tiktok_shop' THEN sku END AS seller_sku, CAST(NULL AS DOUBLE) AS original_price,
  CASE WHEN platform <> 'tiktok_shop' THEN unit_price END AS discount_price, 'THB' AS currency, 'kg' AS weight_unit,
  false AS is_mapped, '2001-07-01 00:00:00' AS extracted_at
FROM (SELECT * REPLACE (true AS is_active) FROM stg_products)""",
    ),
    Check(
        "r7_sku_lookup",
        "s product_id sku master_sku; b is_mapped",
        lambda s: sku.map_products(s.products, newest_map(s)),
        CLEAN_MAP
        + """SELECT product_id, sku, c.master_sku, c.master_sku IS NOT NULL AS is_mapped
FROM stg_products AS p LEFT JOIN clean AS c ON c.platform = p.platform AND c.platform_sku = p.sku""",
    ),
    Check(
        "r8_reverse_lookup",
        "s master_sku platform platform_sku",
        lambda s: sku.platform_skus(newest_map(s)),
        CLEAN_MAP + "SELECT DISTINCT master_sku, platform, platform_sku FROM clean",
    ),
    Check(
        "r9_unmapped_skus",
        "s platform sku name variation",
        lambda s: sku.unmapped_skus(s.items, newest_map(s), "item_id"),
        CLEAN_MAP.replace("WITH ", "WITH sold AS (SELECT DISTINCT " + pick("o_custkey", "shopee", "lazada", "tiktok_shop")
        + " AS platform, l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey),\n", 1)
        + """SELECT DISTINCT s.platform, upper(substr(s.platform, 1, 3)) || '-' || l_partkey AS sku, p_name AS name, '' AS variation
FROM sold AS s JOIN part ON p_partkey = l_partkey
WHERE NOT EXISTS (SELECT 1 FROM clean AS c WHERE c.platform = s.platform AND c.platform_sku = upper(substr(s.platform, 1, 3)) || '-' || l_partkey)""",
    ),
    Check(
        "r10_sku_map_statistics",
        "s platform; l mappings master_skus",
        lambda s: sku.map_statistics(newest_map(s)),
        CLEAN_MAP
        + """SELECT platform, count(*) AS mappings, count(DISTINCT master_sku) AS master_skus FROM clean GROUP BY platform
UNION ALL SELECT 'all', count(*), count(DISTINCT master_sku) FROM clean""",
    ),
    Check(
        "r11_removed_mappings",
        "s platform platform_sku master_sku",
        lambda s: sku.remove_mappings(
            newest_map(s),
            s.products.where(~F.col("is_active")).select(F.upper("platform").alias("platform"), F.col("sku").alias("platform_sku")),
        ),
        CLEAN_MAP
        + """SELECT platform, platform_sku, master_sku FROM clean AS c WHERE NOT EXISTS (SELECT 1 FROM stg_products AS p
WHERE p.platform = c.platform AND p.sku = c.platform_sku AND NOT p.is_active)""",
    ),
    Check(
        "r12_suggested_master_sku",
        "l p_partkey; s from_sku from_name nothing",
        lambda s: s.table("part").select(
            "p_partkey",
            labels.suggested_master_sku(F.concat(F.lit("ab-"), F.col("p_partkey").cast("string")), F.col("p_name")).alias("from_sku"),
            labels.suggested_master_sku(F.concat(F.lit("item"), F.col("p_partkey").cast("string")), F.col("p_name")).alias("from_name"),
            labels.suggested_master_sku(F.lit(""), F.lit(None).cast("string")).alias("nothing"),
        ),
        """SELECT p_partkey, 'AB-' || p_partkey AS from_sku,
  upper(array_to_string(list_transform(list_slice(string_split(p_name, ' '), 1, 3), lambda w: substr(w, 1, 2)), '')) || '-'
    || upper(substr('item' || p_partkey, 1, 8)) AS from_name, 'UNKNOWN' AS nothing FROM part""",
    ),
    Check(
        "k2_raw_order_index",
        "s platform; l records ids; s batch",
        lambda s: raw_index.raw_orders(records.landed_orders(s, named=False), "b1", RUN_AT)
        .groupBy("platform", F.col("_batch_id").alias("batch"))
        .agg(F.count(F.lit(1)).alias("records"), F.count_distinct(F.nullif("platform_order_id", F.lit(""))).alias("ids")),
        """SELECT CASE WHEN o_custkey % 3 = 1 THEN 'lazada' WHEN o_custkey % 3 = 2 THEN 'tiktok_shop'
    WHEN o_orderkey % 11 = 0 THEN 'unknown' ELSE 'shopee' END AS platform, 'b1' AS batch, count(*) AS records,
  count(DISTINCT CASE WHEN o_custkey % 3 <> 0 OR o_orderkey % 11 <> 0 THEN o_orderkey END) AS ids
FROM orders WHERE o_orderkey % 13 <> 0 GROUP BY ALL""",
    ),
    Check(
        "k3_raw_ads_index",
        "s platform account_id campaign_id adgroup_id ad_id level; s report_date; l records",
        lambda s: raw_index.raw_ads(records.landed_ads(s), None, RUN_AT)
        .groupBy("platform", "account_id", "campaign_id", "adgroup_id", "ad_id", "level", "report_date")
        .agg(F.count(F.lit(1)).alias("records")),
        f"""SELECT CASE l_suppkey % 6 WHEN 0 THEN 'facebook_ads' WHEN 1 THEN 'google_ads' WHEN 2 THEN 'tiktok_ads' WHEN 3 THEN 'line_ads'
    WHEN 4 THEN 'shopee_ads' ELSE 'lazada_ads' END AS platform,
  CASE l_suppkey % 6 WHEN 0 THEN 'act' WHEN 1 THEN 'cust' WHEN 2 THEN 'adv' ELSE '' END AS account_id,
  CASE WHEN l_suppkey % 6 < 3 THEN CAST(campaign_id AS VARCHAR) WHEN l_partkey % 2 = 0 THEN number ELSE '' END AS campaign_id,
  CASE WHEN l_suppkey % 6 IN (0, 2) THEN adgroup_id ELSE '' END AS adgroup_id,
  CASE WHEN l_suppkey % 6 IN (0, 2) THEN number ELSE '' END AS ad_id,
  CASE WHEN l_suppkey % 6 = 0 THEN 'insight' WHEN l_suppkey % 6 < 3 THEN 'ad' ELSE 'daily_report' END AS level,
  CASE WHEN l_suppkey % 6 = 0 THEN CAST(date AS VARCHAR) WHEN l_suppkey % 6 = 2 AND l_partkey % 7 <> 0 THEN date || ' 00:00:00'
    ELSE '2001-08-01' END AS report_date, count(*) AS records
FROM ({AD_BASE}) GROUP BY ALL""",
    ),
    Check(
        "k4b_raw_page_index",
        "s property_id report_date page_path; l records",
        lambda s: raw_index.raw_web_pages(records.landed_web(s).where(F.col("type") == "pages"), None, RUN_AT)
        .groupBy("property_id", "report_date", "page_path")
        .agg(F.count(F.lit(1)).alias("records")),
        using("stg_ga4_pages")
        + """SELECT property_id, CASE WHEN exits % 4 = 0 THEN 'soon' ELSE CAST(date AS VARCHAR) END AS report_date, page_path,
  count(*) AS records FROM stg_ga4_pages GROUP BY ALL""",
    ),
    Check(
        "k4_raw_web_index",
        "s property_id report_type report_date source medium; l records",
        lambda s: raw_index.raw_web(records.landed_web(s), None, RUN_AT)
        .groupBy("property_id", "report_type", "report_date", "source", "medium")
        .agg(F.count(F.lit(1)).alias("records")),
        using("stg_ga4_sessions", "stg_ga4_pages")
        + """SELECT property_id, report_type, CAST(date AS VARCHAR) AS report_date, source,
  CASE medium WHEN 'organic' THEN '(not set)' ELSE medium END AS medium, count(*) AS records
FROM stg_ga4_sessions, (VALUES ('ecommerce'), ('custom')) AS k(report_type) GROUP BY ALL
UNION ALL SELECT property_id, 'pages', CASE WHEN exits % 4 = 0 THEN 'soon' ELSE CAST(date AS VARCHAR) END, NULL, NULL, count(*)
FROM stg_ga4_pages GROUP BY ALL""",
    ),
    Check(
        "k5_raw_product_index",
        "s platform platform_product_id sku; l records",
        lambda s: raw_index.raw_products(records.landed_products(s), None, RUN_AT)
        .groupBy("platform", "platform_product_id", "sku")
        .agg(F.count(F.lit(1)).alias("records")),
        using("stg_products")
        + """SELECT platform, CASE WHEN platform = 'tiktok_shop' THEN sku ELSE platform_product_id END AS platform_product_id,
  CASE WHEN platform <> 'tiktok_shop' THEN sku END AS sku, 2 AS records FROM stg_products""",
    ),
    Check(
        "k6_keyed_upsert",
        "s customer_id order_id; m total",
        lambda s: store.upserted(
            store.upserted(customer_state(s, "1997-01-01"), customer_state(s, "1999-01-01"), UPSERT_KEYS, ["order_date", "order_id"]),
            customer_state(s, "2003-01-01"),
            UPSERT_KEYS,
            ["order_date", "order_id"],
        ),
        using("stg_orders")
        + """SELECT DISTINCT ON (customer_id) customer_id, order_id, total FROM stg_orders
ORDER BY customer_id, order_date DESC, order_id DESC""",
    ),
    Check(
        "s2_response_pages",
        "l page position; s order_sn; m amount",
        lambda s: landing.page_items(pages_as_responses(s), "body", ("response", "order_list"), ("page",)).select(
            "page",
            "position",
            F.get_json_object("item", "$.order_sn").alias("order_sn"),
            F.get_json_object("item", "$.amount").alias("amount"),
        ),
        """SELECT o_orderkey // 50 AS page, CAST(o_orderkey AS VARCHAR) AS order_sn, o_totalprice AS amount,
  row_number() OVER (PARTITION BY o_orderkey // 50 ORDER BY CAST(o_orderkey AS VARCHAR)) - 1 AS position FROM orders""",
    ),
    Check(
        "s3_orders_with_items",
        "l o_orderkey lines; m amount",
        lambda s: records.priced_orders(s).select(
            "o_orderkey",
            F.size("lines").alias("lines"),
            F.aggregate("lines", F.lit(0.0), lambda t, i: t + i["l_extendedprice"]).alias("amount"),
        ),
        """SELECT o_orderkey, count(l_orderkey) AS lines, coalesce(sum(l_extendedprice), 0) AS amount
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
    ),
    Check(
        "s4_positional_report_rows",
        "d date; s source medium; l sessions users",
        lambda s: landing.report_rows(positional_reports(s), "dims", "mets", "rows", ("date",)).select(
            "date",
            F.col("dimensions")["sessionSource"].alias("source"),
            F.col("dimensions")["sessionMedium"].alias("medium"),
            F.col("metrics")["sessions"].alias("sessions"),
            F.col("metrics")["totalUsers"].alias("users"),
        ),
        using("stg_ga4_sessions") + "SELECT date, source, medium, sessions, total_users AS users FROM stg_ga4_sessions",
    ),
    Check(
        "s8_google_report_rows",
        "s customer_id campaign_id; d date; l rows impressions",
        lambda s: landing.google_rows(records.landed_ads(s), "ad", "2001-05-01", "2001-07-31")
        .groupBy("customer_id", F.col("campaign.id").alias("campaign_id"), "date")
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("metrics")["impressions"].cast("long")).alias("impressions")),
        f"""SELECT 'cust' AS customer_id, campaign_id, date, count(*) AS rows, sum(impressions) AS impressions
FROM ({AD_BASE}) WHERE l_suppkey % 6 = 1 AND date BETWEEN DATE '2001-05-01' AND DATE '2001-07-31' GROUP BY ALL""",
    ),
    Check(
        "s8b_google_levels",
        "s level campaign_id; d date; l rows impressions; s parts",
        google_levels,
        f"""SELECT level, campaign_id, date, count(*) AS rows, sum(impressions) AS impressions, CASE level WHEN 'campaign' THEN 'campaign'
    WHEN 'adgroup' THEN 'campaign,adGroup' WHEN 'ad' THEN 'campaign,adGroup,adGroupAd' ELSE 'campaign,adGroup,adGroupCriterion' END AS parts
FROM (SELECT *, {pick('l_suppkey // 6', 'campaign', 'adgroup', 'ad', 'keyword')} AS level FROM ({AD_BASE}) WHERE l_suppkey % 6 = 1)
WHERE date BETWEEN DATE '2000-01-01' AND DATE '2000-12-31' GROUP BY ALL""",
    ),
    Check(
        "s6_entities",
        "s platform entity_kind entity_id campaign_id name status; m budget",
        lambda s: landing.entities(landed_entities(s)),
        f"""SELECT {pick('s_suppkey', 'facebook_ads', 'tiktok_ads', 'shopee_ads')} AS platform,
  {pick('s_suppkey', 'campaign', 'adset', 'adgroup', 'ad', 'product_ad', 'shop_ad')} AS entity_kind,
  CASE WHEN s_suppkey % 6 = 5 THEN 'i' ELSE {pick('s_suppkey', 'c', 's', 'g', 'a', 'p', 'i')} END || s_suppkey AS entity_id,
  'c' || s_suppkey AS campaign_id, s_name AS name, {pick('s_suppkey', 'active', 'paused')} AS status,
  CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey ELSE 2 * s_suppkey END AS budget FROM supplier""",
    ),
    Check(
        "s5_realtime_rows",
        "s property_id country city; l active_users",
        lambda s: landing.realtime_rows(
            s.table("customer").select(
                F.lit("properties/1").alias("property_id"),
                F.create_map(F.lit("country"), F.col("c_nationkey").cast("string"), F.lit("city"), F.col("c_mktsegment")).alias("dimensions"),
                F.create_map(
                    F.lit("activeUsers"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_custkey").cast("string")).otherwise("few")
                ).alias("metrics"),
            )
        ),
        """SELECT 'properties/1' AS property_id, CAST(c_nationkey AS VARCHAR) AS country, c_mktsegment AS city,
  CASE WHEN c_custkey % 5 <> 0 THEN c_custkey ELSE 0 END AS active_users FROM customer""",
    ),
    Check(
        "s14_breakdowns",
        "s platform campaign_id; m spend",
        lambda s: landing.breakdowns(s.ads, ["platform", "device", "campaign_id", "spend"]),
        using("stg_ads") + "SELECT platform, campaign_id, spend FROM stg_ads",
    ),
    Check(
        "r13d_impossible_values",
        "s platform outcome; l records",
        impossible_values,
        f"""SELECT {pick('o_orderkey', 'shopee', 'lazada', 'tiktok_shop')} AS platform, CASE (o_orderkey // 3) % 7 WHEN 0 THEN 'good' WHEN 6 THEN 'good'
  ELSE 'ValidationError' END AS outcome, count(*) AS records FROM orders GROUP BY ALL""",
    ),
    Check(
        "s11_ads_date_window",
        "s platform; l rows; m spend",
        lambda s: s.ads.where(dates.since_day("date", AS_OF, 60)).groupBy("platform").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("spend").alias("spend")
        ),
        using("stg_ads") + f"SELECT platform, count(*) AS rows, sum(spend) AS spend FROM stg_ads WHERE date >= {D} - 60 AND date <= {D} GROUP BY platform",
    ),
    Check(
        "s13_campaign_rollup",
        "s campaign_id; l impressions clicks; m spend; l conversions; r ctr; m cpc",
        lambda s: landing.campaign_rollup(landing.with_status(s.ads.where(F.col("platform") == "lazada_ads"), ["active"])),
        using("stg_ads")
        + """SELECT campaign_id, sum(impressions) AS impressions, sum(clicks) AS clicks, sum(spend) AS spend, sum(conversions) AS conversions,
  sum(clicks) / nullif(sum(impressions), 0) AS ctr, sum(spend) / nullif(sum(clicks), 0) AS cpc
FROM stg_ads WHERE platform = 'lazada_ads' AND status = 'active' GROUP BY campaign_id""",
    ),
    Check(
        "f10_exchange_rates",
        "l o_orderkey; s source target; m converted",
        lambda s: s.table("orders")
        .select("o_orderkey", "o_totalprice", records.code(F.col("o_custkey"), FX_CODES).alias("source"),
                F.explode(F.array(*[F.lit(t) for t in FX_TARGETS])).alias("target"))
        .select("o_orderkey", "source", "target", money.convert("o_totalprice", "source", F.col("target")).alias("converted")),
        # One 44th has no finite decimal form: cents are divided half-up as whole numbers.
        f"""SELECT o_orderkey, source, target, CASE WHEN source = 'THB' AND target = 'GBP'
    THEN (CAST(round(o_totalprice * 100) AS BIGINT) + 22) // 44 / 100.0
    ELSE CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) * rate, 2) AS DOUBLE) END AS converted
FROM (SELECT *, {pick('o_custkey', *FX_CODES)} AS source FROM orders) JOIN (VALUES {FX_VALUES}) AS r(source, target, rate) USING (source)""",
    ),
    Check(
        "f12_currency_text",
        "l o_orderkey; m amount; s currency shown",
        lambda s: s.table("orders")
        .select(
            "o_orderkey",
            F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
            .when(F.col("o_orderkey") % 3 == 1, F.concat(F.format_number("o_totalprice", 2), F.lit(" jpy")))
            .otherwise(F.format_number("o_totalprice", 2))
            .alias("text"),
        )
        .withColumn("parsed", money.amount_and_currency("text"))
        .select("o_orderkey", "parsed.*", money.money_text(F.col("parsed.amount"), F.col("parsed.currency")).alias("shown")),
        """SELECT o_orderkey, o_totalprice AS amount, currency,
  CASE currency WHEN 'USD' THEN '$' || t WHEN 'JPY' THEN t || ' ¥' ELSE t || ' ฿' END AS shown
FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'JPY' ELSE 'THB' END AS currency,
  format('{:,.2f}', o_totalprice) AS t FROM orders)""",
    ),
    Check(
        "f14_percentage_and_change",
        "l l_orderkey l_linenumber l_partkey l_suppkey; m part_pct change_pct difference",
        lambda s: s.table("lineitem").select(
            *["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
            money.percentage("l_discount", "l_tax").alias("part_pct"),
            money.change("l_quantity", F.col("l_linenumber") - 1).alias("change_pct"),
            money.change("l_quantity", F.col("l_linenumber") - 1, relative=False).alias("difference"),
        ),
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity - (l_linenumber - 1) AS difference,
  CASE WHEN l_tax = 0 THEN 0 ELSE round(100 * l_discount / l_tax + 1e-9, 2) END AS part_pct,
  CASE WHEN l_linenumber = 1 THEN 100 ELSE round(100 * (l_quantity - l_linenumber + 1) / (l_linenumber - 1)
    + CASE WHEN l_quantity < l_linenumber - 1 THEN -1e-9 ELSE 1e-9 END, 2) END AS change_pct FROM lineitem""",
    ),
    Check(
        "f15_instants_and_bangkok_days",
        "l o_orderkey; s utc; d bangkok",
        lambda s: s.table("orders")
        .withColumn("placed", F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(hours=F.pmod(F.col("o_orderkey"), F.lit(24)).cast("int")))
        .withColumn(
            "text",
            F.when(F.col("o_orderkey") % 3 == 0, F.unix_timestamp("placed").cast("string"))
            .when(F.col("o_orderkey") % 3 == 1, F.date_format("placed", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .otherwise(F.date_format(F.col("placed") + F.expr("interval 7 hours"), "yyyy-MM-dd'T'HH:mm:ss'+07:00'")),
        )
        .withColumn("at", dates.parse_instant("text"))
        .select("o_orderkey", stamp("at").alias("utc"), dates.local_day("at").alias("bangkok")),
        """SELECT o_orderkey, strftime(t, '%Y-%m-%d %H:%M:%S') AS utc, CAST(t + INTERVAL 7 HOUR AS DATE) AS bangkok
FROM (SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS t FROM orders)""",
    ),
    Check(
        "f17_lenient_numbers",
        "l l_orderkey l_linenumber l_partkey l_suppkey whole; m number",
        lambda s: s.table("lineitem")
        .withColumn(
            "text",
            F.when(F.col("l_linenumber") == 1, F.lit("n/a"))
            .when(F.col("l_linenumber") == 2, F.format_number("l_extendedprice", 2))
            .otherwise(F.col("l_extendedprice").cast("string")),
        )
        .select(
            *["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
            scalars.lenient_long("text").alias("whole"),
            scalars.as_double("text").alias("number"),
        ),
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_linenumber = 1 THEN 0 ELSE trunc(l_extendedprice) END AS whole,
  CASE WHEN l_linenumber <> 1 THEN l_extendedprice END AS number FROM lineitem""",
    ),
    Check(
        "f16_day_spine",
        "d date; l orders",
        lambda s: dates.day_spine(s.spark, *dates.named_period("last_30_days", AS_OF))
        .join(s.orders.groupBy(F.to_date("order_date").alias("date")).agg(F.count(F.lit(1)).alias("n")), "date", "left")
        .select("date", scalars.zero("n").alias("orders")),
        f"""SELECT CAST(d AS DATE) AS date, count(o_orderkey) AS orders
FROM generate_series({D} - INTERVAL 29 DAY, CAST({D} AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)
LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY ALL""",
    ),
    Check(
        "w5_rank_of_hot_values",
        "l l_orderkey l_linenumber l_partkey l_suppkey position",
        lambda s: ranking.with_rank(
            s.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity"),
            ["l_returnflag"], "l_quantity", "l_orderkey", "position",
        ),
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  rank() OVER (PARTITION BY l_returnflag ORDER BY l_quantity DESC) AS position FROM lineitem""",
    ),
    Check(
        "w5b_rank_of_large_numbers",
        "l o_orderkey position",
        lambda s: ranking.with_rank(
            s.table("orders").select("o_orderkey", "o_orderstatus", (F.lit(1 << 53) + F.pmod("o_custkey", F.lit(50))).alias("v")), ["o_orderstatus"], "v", "o_orderkey", "position"
        ),
        """SELECT o_orderkey, rank() OVER (PARTITION BY o_orderstatus ORDER BY CAST(9007199254740992 AS BIGINT) + o_custkey % 50 DESC) AS position FROM orders""",
    ),
    Check(
        "w5c_rank_of_decimals",
        "l o_orderkey position",
        lambda s: ranking.with_rank(
            s.table("orders").select("o_orderkey", "o_orderstatus", (F.lit(120_000_000_000_000_000).cast("decimal(20,2)") + F.pmod("o_custkey", F.lit(90)).cast("decimal(20,2)") / 100).alias("v")), ["o_orderstatus"], "v", "o_orderkey", "position"
        ),
        """SELECT o_orderkey, rank() OVER (PARTITION BY o_orderstatus ORDER BY o_custkey % 90 DESC) AS position FROM orders""",
    ),
    Check(
        "w5d_rank_of_days",
        "l o_orderkey position",
        lambda s: ranking.with_rank(
            s.table("orders").select("o_orderkey", "o_orderstatus", (F.to_date("o_orderdate")).alias("v")), ["o_orderstatus"], "v", "o_orderkey", "position"
        ),
        """SELECT o_orderkey, rank() OVER (PARTITION BY o_orderstatus ORDER BY CAST(o_orderdate AS DATE) DESC) AS position FROM orders""",
    ),
    Check(
        "w5e_rank_of_texts",
        "l o_orderkey position",
        lambda s: ranking.with_position(
            s.table("orders").select("o_orderkey", "o_orderstatus", order_page().alias("v")), ["o_orderstatus"], "v", "o_orderkey", per_range=500
        ).select("o_orderkey", F.col("_rank").alias("position")),
        """SELECT o_orderkey, rank() OVER (PARTITION BY o_orderstatus ORDER BY 'https://shop.example/p/' ||
    CASE WHEN o_orderkey % 3 = 0 THEN 'home' ELSE CAST(o_custkey AS VARCHAR) END DESC) AS position FROM orders""",
    ),
    Check(
        "w6_share_of_total",
        "l o_orderkey; r share",
        lambda s: shares.with_share(
            s.table("orders").withColumn("day", F.to_date("o_orderdate")), "o_totalprice", ["day"], "share"
        ),
        """SELECT o_orderkey, o_totalprice / sum(o_totalprice) OVER (PARTITION BY CAST(o_orderdate AS DATE)) AS share FROM orders""",
    ),
    Check(
        "w7_ntile_of_orders",
        "l o_orderkey tile",
        lambda s: ranking.with_ntile(s.table("orders"), ["o_orderstatus"], "o_totalprice", "o_orderkey", "tile", 5),
        """SELECT o_orderkey, ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, md5(CAST(o_orderkey AS VARCHAR)), o_orderkey) AS tile
FROM orders""",
    ),
    Check(
        "r6_newest_per_key",
        "l o_custkey o_orderkey; m o_totalprice",
        lambda s: keep_one(s.table("orders").drop("o_orderpriority"), ["o_custkey"], newest=["o_orderdate", "o_orderkey"]),
        """SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice FROM orders
ORDER BY o_custkey, o_orderdate DESC, o_orderkey DESC""",
    ),
]
