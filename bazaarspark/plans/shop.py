"""Shop performance mart: one snapshot row per shop platform with growth rates, and its total view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarspark.functions.dates import as_date, between_instants, since_day, since_instant
from bazaarspark.functions.fixed_values import ALL_SHOPS
from bazaarspark.functions.labels import shop_of_ads, trend_class
from bazaarspark.functions.scalars import growth, ratio, zero
from bazaarspark.operators.periods import period_sum

SHOP_ADS = ("shopee_ads", "lazada_ads", "tiktok_ads")
# Period name -> (oldest day, newest day), newest excluded.
PERIODS = {"30d": (30, None), "prev_30d": (60, 30), "7d": (7, None), "prev_7d": (14, 7)}


def _customer_measures(as_of) -> list[Column]:
    inside = {p: between_instants("order_date", as_of, newest, oldest) for p, (oldest, newest) in PERIODS.items()}
    net = F.col("total") - F.col("discount")
    measures = []
    for p, here in inside.items():
        measures += [
            F.count_if(here).alias(f"orders_{p}"),
            F.sum(F.when(here, F.col("total")).otherwise(0.0)).alias(f"revenue_{p}"),
        ]
    for p in ("30d", "prev_30d"):
        measures += [
            F.sum(F.when(inside[p], net).otherwise(0.0)).alias(f"net_revenue_{p}"),
            (F.count_if(inside[p]) > 0).alias(f"bought_{p}"),
        ]
    measures += [F.sum(F.when(inside["30d"], F.col("item_count")).otherwise(0)).alias("items_sold_30d")]
    measures += [
        F.count_if(inside["30d"] & (F.col("status") == s)).alias(f"{s}_orders_30d")
        for s in ("completed", "cancelled", "pending")
    ]
    return measures + [
        F.count(F.lit(1)).alias("total_orders_all_time"),
        F.sum("total").alias("total_revenue_all_time"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    ]


def shop_orders(orders: DataFrame, as_of) -> DataFrame:
    """Order measures per platform over the last 365 days.

    Customers are reduced first: per (platform, customer), then per platform. The three distinct customer
    counts become plain sums over that, so rows are not multiplied and no platform gathers in one task.
    """
    known = F.col("customer_id").isNotNull()
    per_customer = (
        orders.where(since_instant("order_date", as_of, 365))
        .groupBy("platform", "customer_id")
        .agg(*_customer_measures(as_of))
    )
    sums = [
        c
        for c in per_customer.columns
        if c not in ("platform", "customer_id", "first_order_date", "last_order_date") and not c.startswith("bought_")
    ]
    return per_customer.groupBy("platform").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.count_if(known & F.col("bought_30d")).alias("customers_30d"),
        F.count_if(known & F.col("bought_prev_30d")).alias("customers_prev_30d"),
        F.count_if(known).alias("total_customers_all_time"),
        F.min("first_order_date").alias("first_order_date"),
        F.max("last_order_date").alias("last_order_date"),
    )


def shop_ads(ads: DataFrame, as_of) -> DataFrame:
    """Spend of the three advertising platforms that belong to one shop, over 60 days."""
    return (
        ads.where(F.col("platform").isin(*SHOP_ADS) & since_day("date", as_of, 60))
        .groupBy(shop_of_ads("platform").alias("platform"))
        .agg(
            period_sum("spend", "date", as_of, 30).alias("ad_spend_30d"),
            period_sum("spend", "date", as_of, 60, 30).alias("ad_spend_prev_30d"),
            *[period_sum(c, "date", as_of, 30).alias(f"{c}_30d") for c in ("impressions", "clicks", "conversions")],
        )
    )


def shop_performance(orders: DataFrame, ads: DataFrame, as_of) -> DataFrame:
    s, a = shop_orders(orders, as_of), shop_ads(ads, as_of)
    kept = [
        *["orders_30d", "revenue_30d", "net_revenue_30d", "customers_30d", "items_sold_30d"],
        *["orders_7d", "revenue_7d", "orders_prev_7d", "revenue_prev_7d"],
        *["completed_orders_30d", "cancelled_orders_30d", "pending_orders_30d"],
        *["total_orders_all_time", "total_revenue_all_time", "total_customers_all_time"],
        *["first_order_date", "last_order_date"],
    ]
    spent = ["ad_spend_30d", "ad_spend_prev_30d", "impressions_30d", "clicks_30d", "conversions_30d"]
    joined = s.join(a, "platform", "left")
    return joined.select(
        F.lit(as_date(as_of)).alias("snapshot_date"),
        "platform",
        *kept,
        *[zero(c).alias(c) for c in spent],
        growth("orders_30d", "orders_prev_30d").alias("order_growth_rate_mom"),
        growth("revenue_30d", "revenue_prev_30d").alias("revenue_growth_rate_mom"),
        growth("net_revenue_30d", "net_revenue_prev_30d").alias("net_revenue_growth_rate_mom"),
        growth("customers_30d", "customers_prev_30d").alias("customer_growth_rate_mom"),
        growth("orders_7d", "orders_prev_7d").alias("order_growth_rate_wow"),
        growth("revenue_7d", "revenue_prev_7d").alias("revenue_growth_rate_wow"),
        growth("ad_spend_30d", "ad_spend_prev_30d").alias("ad_spend_growth_rate_mom"),
        ratio("net_revenue_30d", "ad_spend_30d").alias("roas_30d"),
        ratio("ad_spend_30d", "completed_orders_30d").alias("cpa_30d"),
        ratio("net_revenue_30d", "orders_30d").alias("aov_30d"),
        ratio("completed_orders_30d", "orders_30d").alias("completion_rate_30d"),
        ratio("cancelled_orders_30d", "orders_30d").alias("cancellation_rate_30d"),
        trend_class(growth("revenue_30d", "revenue_prev_30d")).alias("performance_status"),
    )


def shop_performance_total(mart: DataFrame) -> DataFrame:
    summed = [
        *["orders_30d", "revenue_30d", "net_revenue_30d", "customers_30d", "items_sold_30d", "orders_7d"],
        *["revenue_7d", "total_orders_all_time", "total_revenue_all_time", "ad_spend_30d"],
    ]
    sums = mart.groupBy("snapshot_date").agg(
        *[F.sum(c).alias(c) for c in summed], F.sum("completed_orders_30d").alias("_completed")
    )
    return sums.select(
        "snapshot_date",
        F.lit(ALL_SHOPS).alias("platform"),
        *summed,
        ratio("net_revenue_30d", "ad_spend_30d").alias("roas_30d"),
        ratio("ad_spend_30d", "_completed").alias("cpa_30d"),
        ratio("net_revenue_30d", "orders_30d").alias("aov_30d"),
    )
