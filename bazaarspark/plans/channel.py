"""Advertising channel mart: platform-reported results next to web analytics, and its views."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bazaarspark.functions.dates import since_day
from bazaarspark.functions.labels import ads_channel
from bazaarspark.functions.scalars import ratio, zero

LOOKBACK = 90
SUMMED = (
    *("spend", "impressions", "clicks", "reach", "conversions", "conversion_value"),
    *("video_views", "likes", "comments", "shares"),
)


def distinct(c: str, approximate: bool):
    return F.approx_count_distinct(c) if approximate else F.count_distinct(c)


def ads_by_channel(ads: DataFrame, as_of, approximate: bool = False) -> DataFrame:
    recent = ads.where(since_day("date", as_of, LOOKBACK))
    keys = ["date", "platform"]
    if approximate:
        return recent.groupBy(*keys).agg(
            *[F.sum(c).alias(c) for c in SUMMED],
            distinct("campaign_id", True).alias("active_campaigns"),
            distinct("ad_id", True).alias("active_ads"),
        )
    return counted_once(recent, keys, {"active_campaigns": "campaign_id", "active_ads": "ad_id"})


def counted_once(ads: DataFrame, keys: list[str], counts: dict[str, str]) -> DataFrame:
    """Sums and exact distinct counts per group.

    Several distinct counts make Spark expand its rows; so rows are reduced to the different combinations of the counted
    columns first, and only those few are expanded.
    """
    inner = ads.groupBy(*keys, *counts.values()).agg(*[F.sum(c).alias(c) for c in SUMMED])
    exact = [F.count_distinct(c).alias(name) for name, c in counts.items()]
    return inner.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in SUMMED], *exact)


def sessions_by_channel(sessions: DataFrame, as_of) -> DataFrame:
    return (
        sessions.where(since_day("date", as_of, LOOKBACK))
        .groupBy("date", ads_channel("source", "medium").alias("platform"))
        .agg(
            F.sum("sessions").alias("sessions"),
            F.sum("total_users").alias("users"),
            F.sum("new_users").alias("new_users"),
            F.avg("bounce_rate").alias("bounce_rate"),
            F.avg("avg_session_duration").alias("avg_session_duration"),
        )
    )


def conversions_by_channel(traffic: DataFrame, as_of) -> DataFrame:
    return (
        traffic.where(since_day("date", as_of, LOOKBACK))
        .groupBy("date", ads_channel("source", "medium").alias("platform"))
        .agg(F.sum("transactions").alias("transactions"), F.sum("revenue").alias("revenue"))
    )


def ads_channel_performance(
    ads: DataFrame,
    sessions: DataFrame,
    traffic: DataFrame,
    as_of,
    web_only_conversions: bool = False,
    approximate_distinct: bool = False,
) -> DataFrame:
    """Ads and web sessions per day and channel, with web conversions attached.

    Conversions go to rows that have ads, as the published mart does; `web_only_conversions=True` also
    gives them to days and channels seen by web analytics alone. `approximate_distinct` trades the two
    exact distinct counts, which make Spark expand every row three times, for sketches.
    """
    a = ads_by_channel(ads, as_of, approximate_distinct).alias("a")
    g = sessions_by_channel(sessions, as_of).alias("g")
    c = conversions_by_channel(traffic, as_of).alias("c")
    both = a.join(g, (F.col("a.date") == F.col("g.date")) & (F.col("a.platform") == F.col("g.platform")), "full")
    day = F.coalesce("a.date", "g.date")
    channel = F.coalesce("a.platform", "g.platform")
    if web_only_conversions:
        match = (day == F.col("c.date")) & (channel == F.col("c.platform"))
    else:
        match = (F.col("a.date") == F.col("c.date")) & (F.col("a.platform") == F.col("c.platform"))
    spend, clicks, shown = F.col("a.spend"), F.col("a.clicks"), F.col("a.impressions")
    engagement = F.col("likes") + F.col("comments") + F.col("shares")
    sessions_n, users_n = F.col("g.sessions"), F.col("g.users")
    return both.join(c, match, "left").where(day.isNotNull()).select(
        day.alias("date"),
        channel.alias("platform"),
        zero(spend).alias("spend"),
        zero(shown).alias("impressions"),
        zero("reach").alias("reach"),
        zero(clicks).alias("clicks"),
        ratio(clicks, shown).alias("ctr"),
        ratio(spend, clicks).alias("cpc"),
        ratio(spend * 1000, shown).alias("cpm"),
        zero("conversions").alias("platform_conversions"),
        zero("conversion_value").alias("platform_conversion_value"),
        ratio(spend, "conversions").alias("cost_per_conversion"),
        ratio("conversion_value", spend).alias("platform_roas"),
        *[zero(x).alias(x) for x in ("video_views", "likes", "comments", "shares")],
        engagement.alias("total_engagement"),
        ratio(engagement, shown).alias("engagement_rate"),
        zero("active_campaigns").alias("active_campaigns"),
        zero("active_ads").alias("active_ads"),
        zero(sessions_n).alias("ga4_sessions"),
        zero(users_n).alias("ga4_users"),
        zero("g.new_users").alias("ga4_new_users"),
        F.col("g.bounce_rate").alias("ga4_bounce_rate"),
        F.col("g.avg_session_duration").alias("ga4_avg_session_duration"),
        zero("transactions").alias("ga4_transactions"),
        zero("revenue").alias("ga4_revenue"),
        ratio("transactions", sessions_n).alias("ga4_conversion_rate"),
        ratio("revenue", spend).alias("ga4_roas"),
        ratio(spend, sessions_n).alias("cost_per_session"),
        ratio(spend, "transactions").alias("cost_per_acquisition"),
        ratio(spend, users_n).alias("cost_per_user"),
        ratio("revenue", users_n).alias("revenue_per_user"),
    )


def ads_channel_summary(mart: DataFrame, as_of) -> DataFrame:
    """30-day totals per channel with ratios of the totals, biggest spender first."""
    sums = {
        "total_spend": "spend",
        "total_impressions": "impressions",
        "total_clicks": "clicks",
        "total_conversions": "platform_conversions",
        "total_conversion_value": "platform_conversion_value",
        "total_ga4_sessions": "ga4_sessions",
        "total_ga4_transactions": "ga4_transactions",
        "total_ga4_revenue": "ga4_revenue",
    }
    totals = (
        mart.where(since_day("date", as_of, 30))
        .groupBy("platform")
        .agg(*[F.sum(source).alias(name) for name, source in sums.items()])
    )
    return totals.withColumns(
        {
            "avg_ctr": ratio("total_clicks", "total_impressions"),
            "avg_cpc": ratio("total_spend", "total_clicks"),
            "avg_cpm": ratio(F.col("total_spend") * 1000, "total_impressions"),
            "avg_roas": ratio("total_conversion_value", "total_spend"),
            "avg_cost_per_conversion": ratio("total_spend", "total_conversions"),
            "avg_ga4_roas": ratio("total_ga4_revenue", "total_spend"),
        }
    ).orderBy(F.desc("total_spend"), "platform")


def ads_channel_trend(mart: DataFrame, as_of) -> DataFrame:
    """Daily figures with month-to-date totals. A window holds one channel and month: at most 31 rows."""
    month = Window.partitionBy("platform", F.trunc("date", "MM")).orderBy("date")
    kept = (
        *("date", "platform", "spend", "impressions", "clicks", "platform_conversions"),
        *("platform_conversion_value", "ctr", "cpc", "cpm", "platform_roas"),
        *("ga4_sessions", "ga4_transactions", "ga4_revenue", "ga4_roas"),
    )
    return (
        mart.where(since_day("date", as_of, LOOKBACK))
        .select(
            *kept,
            F.sum("spend").over(month).alias("mtd_spend"),
            F.sum("platform_conversion_value").over(month).alias("mtd_conversion_value"),
        )
        .orderBy(F.desc("date"), "platform")
    )
