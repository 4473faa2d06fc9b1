"""Registered detection of unnamed records, video measures, CSV reports and merged customer counts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarspark.checks import records
from bazaarspark.checks.framework import Check
from bazaarspark.checks.payloads import AD_BASE, RUN_AT
from bazaarspark.checks.sql_staging import pick, using
from bazaarspark.checks.staging import AS_OF, LINES, Staging
from bazaarspark.functions.dates import since_instant
from bazaarspark.plans import daily
from bazaarspark.plans.ads_payloads import mapped_ads, normalize_ads
from bazaarspark.plans.product_payloads import normalize_products
from bazaarspark.session import shared_checkpoint_dir
from bazaarspark.sources import landing


def unnamed_ads(s: Staging) -> DataFrame:
    """Ad records without a platform: told apart by accounts in the envelope or by keys of the payload alone."""
    supplier, part = F.col("l_suppkey"), F.col("l_partkey")
    day, number = F.date_format("l_shipdate", "yyyy-MM-dd"), records.text(part)
    account = F.when(part % 2 == 0, "acc")  # half of them have only their payload to go by
    none = F.lit(None).cast("string")
    facebook = records.envelope(
        records.json(campaign_id=number, adset_id=F.when(part % 2 == 1, "7"), clicks=F.lit("1"), date_start=day), type=F.lit("ad"), ad_account_id=account
    )
    google = records.envelope(
        records.json(metrics=F.struct(F.when(part % 2 == 1, "5000000").alias("costMicros"), F.lit("1").alias("clicks")), date=day),
        type=F.lit("ad"),
        customer_id=account,
    )
    tiktok = records.envelope(
        records.json(dimensions=F.struct(F.when(part % 2 == 1, "7").alias("adgroup_id"), day.alias("stat_time_day")), metrics=F.struct(F.lit("1").alias("clicks"))),
        type=F.lit("ad"),
        advertiser_id=account,
    )
    other = records.envelope(records.json(clicks=F.lit("1"), date=day), type=F.lit("ad"), platform=none)
    value = F.when(supplier % 4 == 0, facebook).when(supplier % 4 == 1, google).when(supplier % 4 == 2, tiktok).otherwise(other)
    # Good and dead records in one pass: a record is built and parsed once.
    rows, bad = s.spread(s.table("lineitem"), "l_orderkey", "lineitem", LINES), F.col("_problem").isNotNull()
    mapped = mapped_ads(landing.from_text(rows.select(value.alias("value"))))
    found = mapped.select(
        F.when(bad, F.col("_platform")).otherwise(F.col("platform")).alias("platform"),
        F.when(bad, F.col("_problem.error_type")).otherwise("good").alias("outcome"),
        F.when(bad, 0).otherwise(F.col("clicks")).alias("clicks"),
    )
    return found.groupBy("platform", "outcome").agg(F.count(F.lit(1)).alias("records"), F.sum("clicks").alias("clicks"))


def unnamed_products(s: Staging) -> DataFrame:
    good = normalize_products(records.landed_products(s, named=False), RUN_AT).good
    return good.groupBy("platform").agg(F.count(F.lit(1)).alias("products"), F.sum("unit_price").alias("price"))


def video_measures(s: Staging) -> DataFrame:
    """Video views at each quarter; a list that is missing gives NULL, one without a readable number gives zero."""
    key, line = F.col("l_partkey"), F.col("l_linenumber")

    def seen(part: int):
        value = F.when(key % 5 == part, "many").otherwise(records.text(line * (5 - part)))
        return F.when(key % 7 != part, F.array(F.struct(F.lit("video_view").alias("action_type"), value.alias("value"))))

    number = F.concat_ws("-", *(records.text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")))
    payload = records.json(
        campaign_id=records.text("l_suppkey"), adset_id=F.lit("1"), ad_id=number, date_start=F.date_format("l_shipdate", "yyyy-MM-dd"),
        video_p25_watched_actions=seen(1), video_p50_watched_actions=seen(2),
        video_p75_watched_actions=seen(3), video_p100_watched_actions=seen(4),
    )
    value = records.envelope(payload, type=F.lit("insight"), platform=F.lit("facebook_ads"), ad_account_id=F.lit("act"))
    rows = s.spread(s.table("lineitem"), "l_orderkey", "lineitem", LINES)
    return normalize_ads(landing.from_text(rows.select(value.alias("value"))), RUN_AT).good


def quarter(part: int, name: str) -> str:
    return f"CASE WHEN l_partkey % 7 = {part} THEN NULL WHEN l_partkey % 5 = {part} THEN 0 ELSE l_linenumber * {5 - part} END AS video_views_{name}"


LINE_REPORT = "campaign string, day date, impressions bigint, spend double"


def csv_report(s: Staging) -> DataFrame:
    """A report as CSV files, every part of which begins with a header; some lines have a wrong cell or lack one."""
    place = f"{shared_checkpoint_dir(s.spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    day, shown = F.date_format("l_shipdate", "yyyy-MM-dd"), records.text(F.floor("l_quantity"))
    cells = [F.concat(F.lit('"c, '), records.text("l_suppkey"), F.lit('"')), day]
    line = (
        F.when(F.col("l_partkey") % 17 == 0, F.concat_ws(",", *cells, F.lit("n/a"), F.lit("1.5")))
        .when(F.col("l_partkey") % 19 == 0, F.concat_ws(",", *cells))
        .when(F.col("l_partkey") % 23 == 0, F.concat_ws(",", *cells, shown, F.lit("")))
        .otherwise(F.concat_ws(",", *cells, shown, F.lit("1.5")))
    )
    header = s.spark.range(3).select(F.lit("Campaign,Day,Impressions,Spend").alias("value"))
    s.table("lineitem").select(line.alias("value")).union(header).write.text(place)
    parts = landing.csv_rows(s.spark.read.text(place), LINE_REPORT, "line_ads", F.lit(RUN_AT))
    dead = parts.dead.groupBy(F.col("error_type").alias("outcome"), F.col("source_platform").alias("campaign")).agg(F.count(F.lit(1)).alias("rows"))
    good = parts.good.groupBy(F.lit("good").alias("outcome"), "campaign").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("impressions").alias("impressions"), F.sum("spend").alias("spend"),
        F.min("day").alias("first_day"),
    )
    return good.unionByName(dead, allowMissingColumns=True)


def customers(s: Staging) -> DataFrame:
    """Estimates of distinct customers by day, month and year, and whether they are within 5 % of the exact counts."""
    mart = daily.daily_performance(s.orders, s.ads, AS_OF, sketches=True)
    orders, found = s.orders.where(since_instant("order_date", AS_OF, daily.LOOKBACK)), None
    for period in ("day", "month", "year"):
        exact = orders.groupBy(F.to_date(F.date_trunc(period, "order_date")).alias("period_start")).agg(F.count_distinct("customer_id").alias("exact"))
        part = daily.unique_customers(mart, period).join(exact, "period_start", "full")
        near = F.abs(F.col("unique_customers") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * 0.05)
        part = part.select(F.lit(period).alias("period"), "period_start", "exact", F.coalesce(near, F.lit(False)).alias("near"))
        found = part if found is None else found.unionByName(part)
    return found


CHECKS = [
    Check(
        "r2_ads_platform_detection",
        "s platform outcome; l records clicks",
        unnamed_ads,
        f"""SELECT {pick('l_suppkey', 'facebook_ads', 'google_ads', 'tiktok_ads', 'unknown')} AS platform,
  CASE WHEN l_suppkey % 4 = 3 THEN 'UnknownPlatform' ELSE 'good' END AS outcome, count(*) AS records,
  count(*) FILTER (l_suppkey % 4 <> 3) AS clicks FROM lineitem GROUP BY ALL""",
    ),
    Check(
        "r3_product_platform_detection",
        "s platform; l products; m price",
        unnamed_products,
        # A record with an item_id is Shopee's; the landed Lazada records have one.
        using("stg_products")
        + """SELECT CASE platform WHEN 'lazada' THEN 'shopee' ELSE platform END AS platform, count(*) AS products, sum(unit_price) AS price
FROM stg_products GROUP BY ALL""",
    ),
    Check(
        "n11_video_measures",
        "s ad_id; d date; l video_views_p25 video_views_p50 video_views_p75 video_views_p100",
        video_measures,
        f"""SELECT number AS ad_id, date, {quarter(1, 'p25')}, {quarter(2, 'p50')}, {quarter(3, 'p75')}, {quarter(4, 'p100')} FROM ({AD_BASE})""",
    ),
    Check(
        "s9_csv_report",
        "s outcome campaign; l rows impressions; m spend; d first_day",
        csv_report,
        """SELECT CASE WHEN bad THEN 'CSVDecodeError' ELSE 'good' END AS outcome, CASE WHEN bad THEN 'line_ads' ELSE 'c, ' || l_suppkey END AS campaign,
  count(*) AS rows, CASE WHEN NOT bad THEN CAST(sum(floor(l_quantity)) AS BIGINT) END AS impressions,
  sum(CASE WHEN NOT bad AND l_partkey % 23 <> 0 THEN 1.5 END) AS spend, CASE WHEN NOT bad THEN min(CAST(l_shipdate AS DATE)) END AS first_day
FROM (SELECT *, l_partkey % 17 = 0 OR l_partkey % 19 = 0 AS bad FROM lineitem) GROUP BY bad, outcome, campaign""",
    ),
    Check(
        "v1b_unique_customers",
        "s period; d period_start; l exact; b near",
        customers,
        using("stg_orders")
        + """SELECT period, CAST(date_trunc(period, order_date) AS DATE) AS period_start, count(DISTINCT customer_id) AS exact, true AS near
FROM stg_orders, (VALUES ('day'), ('month'), ('year')) AS p(period)
WHERE order_date >= TIMESTAMP '2001-08-01' - INTERVAL 90 DAY AND order_date < TIMESTAMP '2001-08-02' GROUP BY ALL""",
    ),
]
