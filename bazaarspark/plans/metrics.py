"""Metric rows for the rule evaluation, one row per entity and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarspark.functions.dates import between_days, day, since_day
from bazaarspark.functions.scalars import ratio
from bazaarspark.operators.periods import period_sum
from bazaarspark.plans.campaign import benchmarks, campaign_days


def daily_metrics(daily: DataFrame) -> DataFrame:
    """Every row of a daily mart with the metrics the standard rules watch.

    Revenue change is against the same platform seven days earlier.
    """
    own = daily.select(
        "platform",
        F.lit("daily").alias("entity_type"),
        F.concat_ws("_", "platform", F.col("date").cast("string")).alias("entity_id"),
        F.concat_ws(" - ", "platform", F.col("date").cast("string")).alias("entity_name"),
        "date",
        "roas",
        "cpa",
        "conversion_rate",
        ratio("cancelled_orders", "total_orders").alias("cancellation_rate"),
        "net_revenue",
    )
    earlier = daily.select("platform", F.date_add("date", 7).alias("date"), F.col("net_revenue").alias("_before"))
    return own.join(earlier, ["platform", "date"], "left").withColumn(
        "revenue_change_pct", F.when(F.col("_before") > 0, ratio(F.col("net_revenue") - F.col("_before"), "_before"))
    ).drop("_before")


def shop_metrics(shops: DataFrame) -> DataFrame:
    """Metrics of the shop snapshot."""
    return shops.select(
        "platform",
        F.lit("shop").alias("entity_type"),
        F.col("platform").alias("entity_id"),
        F.col("platform").alias("entity_name"),
        F.col("snapshot_date").alias("date"),
        F.col("roas_30d").alias("roas"),
        F.col("cpa_30d").alias("cpa"),
        F.col("revenue_growth_rate_wow").alias("revenue_change_pct"),
        F.col("cancellation_rate_30d").alias("cancellation_rate"),
    )


def spend_metrics(ads: DataFrame, as_of) -> DataFrame:
    """Yesterday's spend per platform against the mean of the seven days before it (own definition)."""
    week = (
        ads.where(between_days("date", as_of, 0, 8))
        .groupBy("platform")
        .agg(
            period_sum("spend", "date", as_of, 1, 0).alias("_yesterday"),
            (period_sum("spend", "date", as_of, 8, 1) / 7).alias("_mean"),
        )
    )
    return week.select(
        "platform",
        F.lit("platform").alias("entity_type"),
        F.col("platform").alias("entity_id"),
        F.col("platform").alias("entity_name"),
        day(as_of, 1).alias("date"),
        ratio(F.col("_yesterday") - F.col("_mean"), "_mean").alias("spend_vs_average"),
    )


def campaign_metrics(ads: DataFrame, as_of) -> DataFrame:
    """ROAS of each campaign over 30 days as a fraction of its platform's benchmark (own definition)."""
    days = campaign_days(ads, as_of)
    bench = benchmarks(days, as_of)
    sums = (
        days.where(since_day("date", as_of, 30))
        .groupBy("platform", "campaign_id", "campaign_name")
        .agg(F.sum("spend").alias("_spend"), F.sum("conversion_value").alias("_value"))
    )
    return sums.join(bench, "platform", "left").select(
        "platform",
        F.lit("campaign").alias("entity_type"),
        F.col("campaign_id").alias("entity_id"),
        F.col("campaign_name").alias("entity_name"),
        day(as_of, 1).alias("date"),
        ratio(ratio("_value", "_spend"), "benchmark_roas").alias("roas_vs_benchmark_ratio"),
    )
