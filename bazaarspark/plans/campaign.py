"""Campaign mart: daily campaign results against platform benchmarks and their own history, and views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarspark.functions.dates import since_day
from bazaarspark.functions.labels import campaign_class, optimization_flag
from bazaarspark.functions.scalars import growth, ratio
from bazaarspark.operators.periods import period_sum
from bazaarspark.operators.rolling import rolling_days, rolling_rows
from bazaarspark.plans.channel import SUMMED, counted_once, distinct
from bazaarspark.session import checkpointed

LOOKBACK, RECENT = 90, 30
GRAIN = ("date", "platform", "account_id", "campaign_id", "campaign_name", "campaign_type", "objective", "status")


def campaign_days(ads: DataFrame, as_of, approximate_distinct: bool = False) -> DataFrame:
    """Daily sums per campaign, the base of everything below. Ad sets count as ad groups."""
    level = F.when(F.col("level") == "adset", "adgroup").otherwise(F.col("level"))
    recent = ads.where(since_day("date", as_of, LOOKBACK) & level.isin("campaign", "ad", "adgroup"))
    if approximate_distinct:
        return recent.groupBy(*GRAIN).agg(
            *[F.sum(c).alias(c) for c in SUMMED],
            distinct("adgroup_id", True).alias("active_adgroups"),
            distinct("ad_id", True).alias("active_ads"),
        )
    return counted_once(recent, list(GRAIN), {"active_adgroups": "adgroup_id", "active_ads": "ad_id"})


def benchmarks(days: DataFrame, as_of) -> DataFrame:
    """Plain means of the daily ratios per platform over 30 days; undefined ratios do not count."""
    return (
        days.where(since_day("date", as_of, RECENT))
        .groupBy("platform")
        .agg(
            F.avg(ratio("clicks", "impressions")).alias("benchmark_ctr"),
            F.avg(ratio("spend", "clicks")).alias("benchmark_cpc"),
            F.avg(ratio(F.col("spend") * 1000, "impressions")).alias("benchmark_cpm"),
            F.avg(ratio("conversion_value", "spend")).alias("benchmark_roas"),
            F.avg(ratio("spend", "conversions")).alias("benchmark_cpa"),
        )
    )


def history(days: DataFrame, as_of) -> DataFrame:
    """Weekly comparison and activity per campaign over 30 days."""
    return (
        days.where(since_day("date", as_of, RECENT))
        .groupBy("platform", "campaign_id")
        .agg(
            period_sum("spend", "date", as_of, 7).alias("spend_7d"),
            period_sum("spend", "date", as_of, 14, 7).alias("spend_prev_7d"),
            period_sum("conversion_value", "date", as_of, 7).alias("conv_value_7d"),
            period_sum("conversion_value", "date", as_of, 14, 7).alias("conv_value_prev_7d"),
            F.min("date").alias("first_active_date"),
            F.max("date").alias("last_active_date"),
            F.count_distinct("date").alias("days_active"),
        )
    )


def campaign_performance(
    ads: DataFrame, as_of, approximate_distinct: bool = False, materialize: bool = False
) -> DataFrame:
    """Daily campaign results with benchmarks, history, class and flag.

    The daily sums feed the mart, the benchmarks and the history. Each use prunes other columns, so Spark
    does not share them and reads the ads three times. `materialize=True` checkpoints the sums, a fraction
    of the ads, and reads those instead; it runs that one job right away.
    """
    days = campaign_days(ads, as_of, approximate_distinct)
    if materialize:
        days = checkpointed(days)
    # One row per advertising platform present; Spark sees how small it is.
    bench = benchmarks(days, as_of)
    joined = days.join(bench, "platform", "left").join(history(days, as_of), ["platform", "campaign_id"], "left")
    engagement = F.col("likes") + F.col("comments") + F.col("shares")
    rated = joined.withColumns(
        {
            "ctr": ratio("clicks", "impressions"),
            "cpc": ratio("spend", "clicks"),
            "cpm": ratio(F.col("spend") * 1000, "impressions"),
            "cost_per_conversion": ratio("spend", "conversions"),
            "conversion_rate": ratio("conversions", "clicks"),
            "roas": ratio("conversion_value", "spend"),
            "video_view_rate": ratio("video_views", "impressions"),
            "total_engagement": engagement,
            "engagement_rate": ratio(engagement, "impressions"),
            "spend_change_wow": growth("spend_7d", "spend_prev_7d"),
            "conv_value_change_wow": growth("conv_value_7d", "conv_value_prev_7d"),
        }
    )
    return rated.select(
        *GRAIN,
        *["spend", "impressions", "reach", "clicks", "ctr", "cpc", "cpm"],
        *["conversions", "conversion_value", "cost_per_conversion", "conversion_rate", "roas"],
        *["video_views", "video_view_rate", "likes", "comments", "shares", "total_engagement", "engagement_rate"],
        *["active_adgroups", "active_ads"],
        *[(F.col(c) - F.col(f"benchmark_{c}")).alias(f"{c}_vs_benchmark") for c in ("ctr", "cpc", "roas")],
        *["first_active_date", "last_active_date", "days_active"],
        *["spend_7d", "spend_prev_7d", "spend_change_wow"],
        *["conv_value_7d", "conv_value_prev_7d", "conv_value_change_wow"],
        campaign_class("roas", "benchmark_roas", "spend", "days_active", "status").alias("performance_status"),
        optimization_flag("ctr", "benchmark_ctr", "cpc", "benchmark_cpc", "conversion_rate").alias("optimization_flag"),
    )


def campaign_summary(mart: DataFrame) -> DataFrame:
    """Rows of each campaign's latest day, ties kept, biggest spend first.

    Joined to the latest day per campaign (a partial aggregate) rather than ranked in a window.
    """
    latest = mart.groupBy(F.col("platform").alias("_p"), F.col("campaign_id").alias("_c")).agg(
        F.max("date").alias("_d")
    )
    same = (F.col("platform") == F.col("_p")) & (F.col("campaign_id") == F.col("_c")) & (F.col("date") == F.col("_d"))
    return mart.join(latest, same, "inner").drop("_p", "_c", "_d").orderBy(F.desc("spend"), "platform", "campaign_id")


def campaign_trend(mart: DataFrame, as_of, calendar_days: bool = False) -> DataFrame:
    """Rolling week of spend, conversion value and ROAS per campaign.

    The frame is seven rows, as published; `calendar_days=True` takes seven calendar days instead.
    """
    measures = {
        "spend_7d_rolling": ("sum", "spend"),
        "conv_value_7d_rolling": ("sum", "conversion_value"),
        "roas_7d_rolling": ("avg", "roas"),
    }
    recent = mart.where(since_day("date", as_of, RECENT)).select(
        *["date", "platform", "campaign_id", "campaign_name", "spend", "conversions", "conversion_value", "roas"],
        *["performance_status", "account_id", "campaign_type", "objective", "status"],
    )
    keys = ["platform", "campaign_id"]
    ties = ["account_id", "campaign_name", "campaign_type", "objective", "status"]
    rolled = (
        rolling_days(recent, keys, "date", measures)
        if calendar_days
        else rolling_rows(recent, keys, "date", ties, measures)
    )
    return rolled.drop("account_id", "campaign_type", "objective", "status").orderBy(
        F.desc("date"), "platform", "campaign_id"
    )


def top_campaigns(mart: DataFrame, as_of, k: int = 50, alphabetical_status: bool = False) -> DataFrame:
    """Campaigns with the highest 30-day conversion value.

    `latest_status` is the status of the latest day; `alphabetical_status=True` gives the alphabetically
    last one instead, as published.
    """
    status = (
        F.max("performance_status")
        if alphabetical_status
        else F.max(F.struct("date", "performance_status"))["performance_status"]
    )
    totals = (
        mart.where(since_day("date", as_of, RECENT))
        .groupBy("platform", "campaign_id", "campaign_name")
        .agg(
            F.sum("spend").alias("total_spend"),
            F.sum("conversion_value").alias("total_conversion_value"),
            F.sum("conversions").alias("total_conversions"),
            status.alias("latest_status"),
        )
        .where(F.col("total_spend") > 0)
    )
    return (
        totals.withColumns(
            {
                "avg_roas": ratio("total_conversion_value", "total_spend"),
                "avg_cpa": ratio("total_spend", "total_conversions"),
            }
        )
        .orderBy(F.desc("total_conversion_value"), "platform", "campaign_id", "campaign_name")
        .limit(k)
    )
