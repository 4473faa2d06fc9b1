"""Marts whose columns are declared but whose formulas are this package's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarspark.functions.dates import as_date, since_day, since_instant
from bazaarspark.functions.fixed_values import ALL_SHOPS
from bazaarspark.functions.labels import ads_channel, rfm_segment, suggested_master_sku
from bazaarspark.functions.scalars import ratio, zero
from bazaarspark.operators.ranking import with_ntile, with_rank, with_row_number
from bazaarspark.operators.shares import with_share
from bazaarspark.plans.product import with_master_sku
from bazaarspark.session import checkpointed


def entries_map(key: str, value: str) -> Column:
    """Aggregate: {key: value} of the group's rows as a map sorted by key. For keys from a short code list."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(F.col(key), F.col(value)))))


def scoped(df: DataFrame) -> DataFrame:
    """Every row once under its platform and once under 'all'. Apply it to reduced rows."""
    return df.withColumn("platform", F.explode(F.array("platform", F.lit(ALL_SHOPS))))


# --- sales ---------------------------------------------------------------------------------------
def sales_daily(orders: DataFrame) -> DataFrame:
    """Sales per day and platform and over all platforms, with new and returning customers.

    A customer is new on the day of the first order in that scope. Orders are reduced per day, platform
    and customer before they are repeated for the total.
    """
    reduced = scoped(
        orders.groupBy(F.to_date("order_date").alias("date"), "platform", "customer_id").agg(
            F.count(F.lit(1)).alias("orders"),
            *[F.count_if(F.col("status") == s).alias(s) for s in ("completed", "cancelled", "pending")],
            *[F.sum(c).alias(c) for c in ("total", "discount", "shipping_fee", "item_count")],
        )
    )
    days = reduced.groupBy("date", "platform").agg(
        F.sum("orders").alias("total_orders"),
        *[F.sum(s).alias(f"{s}_orders") for s in ("completed", "cancelled", "pending")],
        F.sum("total").alias("gross_revenue"),
        F.sum(F.col("total") - F.col("discount")).alias("net_revenue"),
        F.sum("discount").alias("total_discount"),
        F.sum("shipping_fee").alias("total_shipping_fee"),
        F.sum("item_count").alias("total_items_sold"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    new = (
        reduced.where(F.col("customer_id").isNotNull())
        .groupBy("platform", "customer_id")
        .agg(F.min("date").alias("date"))
        .groupBy("date", "platform")
        .agg(F.count(F.lit(1)).alias("new_customers"))
    )
    return days.join(new, ["date", "platform"], "left").withColumns(
        {
            "new_customers": zero("new_customers"),
            "returning_customers": F.col("unique_customers") - zero("new_customers"),
            "avg_items_per_order": ratio("total_items_sold", "total_orders"),
            "avg_order_value": ratio("net_revenue", "total_orders"),
            "avg_item_value": ratio("net_revenue", "total_items_sold"),
        }
    )


def sales_by_product(items: DataFrame, sku_map: DataFrame) -> DataFrame:
    sold = with_master_sku(items, sku_map)
    sums = sold.groupBy(
        F.to_date("order_date").alias("date"), "master_sku", F.col("name").alias("product_name"), "platform"
    ).agg(
        F.sum("quantity").alias("quantity_sold"),
        F.sum("total_price").alias("gross_revenue"),
        F.sum(F.col("total_price") - F.col("discount")).alias("net_revenue"),
        F.sum("discount").alias("total_discount"),
        F.count_distinct("order_id").alias("order_count"),
    )
    return sums.withColumns(
        {
            "avg_selling_price": ratio("gross_revenue", "quantity_sold"),
            "avg_discount_percent": ratio("total_discount", "gross_revenue") * 100,
        }
    )


def customer_segments(orders: DataFrame, as_of, materialize: bool = False) -> DataFrame:
    """Recency, frequency and monetary value per customer and platform, each scored 1 to 5 (5 is best).

    The three measures are stacked and scored in one exact n-tile pass per platform and measure. That pass
    reads its input three times; `materialize=True` checkpoints the customers first instead of deriving
    them from the orders each time.
    """
    customers = (
        orders.where(F.col("customer_id").isNotNull() & (F.to_date("order_date") <= F.lit(as_date(as_of))))
        .groupBy("customer_id", "platform")
        .agg(
            F.min(F.to_date("order_date")).alias("first_order_date"),
            F.max(F.to_date("order_date")).alias("last_order_date"),
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("total").alias("total_spent"),
        )
        .withColumn("recency_days", F.date_diff(F.lit(as_date(as_of)), F.col("last_order_date")).cast("long"))
    )
    if materialize:
        customers = checkpointed(customers)
    # Higher is better for all three, so recency enters with its sign turned.
    stacked = customers.select(
        "*",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("measure"), F.round(value.cast("double"), 4).alias("level"))
                    for name, value in (
                        ("recency", -F.col("recency_days")),
                        ("frequency", F.col("total_orders")),
                        ("monetary", F.col("total_spent")),
                    )
                ]
            )
        ),
    )
    scored = with_ntile(stacked, ["platform", "measure"], "level", "customer_id", "score", 5)
    score = lambda name: F.max(F.when(F.col("measure") == name, F.col("score")))
    kept = ("first_order_date", "last_order_date", "total_orders", "total_spent", "recency_days")
    flat = scored.groupBy("customer_id", "platform").agg(
        *[F.max(c).alias(c) for c in kept],
        *[score(name).alias(f"{name}_score") for name in ("recency", "frequency", "monetary")],
    )
    return flat.withColumns(
        {
            "snapshot_date": F.lit(as_date(as_of)),
            "frequency": F.col("total_orders"),
            "monetary_value": F.col("total_spent"),
            "avg_order_value": ratio("total_spent", "total_orders"),
            "rfm_segment": rfm_segment("recency_score", "frequency_score", "monetary_score"),
        }
    )


# --- marketing -----------------------------------------------------------------------------------
def marketing_daily(ads: DataFrame) -> DataFrame:
    """Spend and results per day and platform and over all platforms."""
    summed = (
        *("spend", "impressions", "reach", "clicks", "conversions", "conversion_value"),
        *("video_views", "likes", "comments", "shares"),
    )
    reduced = scoped(
        ads.groupBy("date", "platform", "campaign_id", "ad_id").agg(*[F.sum(c).alias(c) for c in summed])
    )
    sums = reduced.groupBy("date", "platform").agg(
        *[F.sum(c).alias(f"total_{c}") for c in summed],
        F.count_distinct("campaign_id").alias("active_campaigns"),
        F.count_distinct("ad_id").alias("active_ads"),
    )
    return sums.withColumns(
        {
            "avg_ctr": ratio("total_clicks", "total_impressions"),
            "avg_cpc": ratio("total_spend", "total_clicks"),
            "avg_cpm": ratio(F.col("total_spend") * 1000, "total_impressions"),
            "avg_cost_per_conversion": ratio("total_spend", "total_conversions"),
            "avg_conversion_rate": ratio("total_conversions", "total_clicks"),
        }
    )


def marketing_by_campaign(ads: DataFrame) -> DataFrame:
    """Results per day and campaign; the status is that of the alphabetically last ad of the day."""
    summed = ("spend", "impressions", "clicks", "reach", "conversions", "conversion_value")
    sums = ads.groupBy("date", "platform", "account_id", "campaign_id", "campaign_name", "campaign_type").agg(
        *[F.sum(c).alias(c) for c in summed], F.max("status").alias("status")
    )
    return sums.withColumns(
        {
            "ctr": ratio("clicks", "impressions"),
            "cpc": ratio("spend", "clicks"),
            "cpm": ratio(F.col("spend") * 1000, "impressions"),
            "cost_per_conversion": ratio("spend", "conversions"),
            "roas": ratio("conversion_value", "spend"),
        }
    )


def channel_attribution(traffic: DataFrame, ads: DataFrame) -> DataFrame:
    """Web channels with the spend behind them.

    The day's spend of an advertising platform is divided over the source/medium rows that came through
    it, in proportion to their sessions.
    """
    keys = ("date", "channel_grouping", "source", "medium")
    web = (
        traffic.groupBy(*keys)
        .agg(
            *[F.sum(c).alias(n) for c, n in (("sessions", "sessions"), ("total_users", "users"), ("new_users", "new_users"))],
            F.avg("bounce_rate").alias("bounce_rate"),
            F.avg("avg_session_duration").alias("avg_session_duration"),
            F.sum("transactions").alias("transactions"),
            F.sum("revenue").alias("revenue"),
        )
        .withColumn("platform", ads_channel("source", "medium"))
    )
    shared = with_share(web, "sessions", ["date", "platform"], "_share")
    spend = ads.groupBy("date", "platform").agg(F.sum("spend").alias("_spend"))
    return (
        shared.join(spend, ["date", "platform"], "left")
        .withColumn("attributed_spend", zero(F.col("_spend") * F.col("_share")))
        .withColumns(
            {
                "conversion_rate": ratio("transactions", "sessions"),
                "cost_per_session": ratio("attributed_spend", "sessions"),
                "cost_per_acquisition": ratio("attributed_spend", "transactions"),
                "roas": ratio("revenue", "attributed_spend"),
            }
        )
        .drop("platform", "_spend", "_share")
    )


# --- products ------------------------------------------------------------------------------------
def product_catalog(products: DataFrame, items: DataFrame, sku_map: DataFrame, as_of) -> DataFrame:
    """One row per unified SKU: where it is sold, its prices and its sales of 30 days."""
    per_platform = (
        with_master_sku(products, sku_map)
        .groupBy("master_sku", "platform")
        .agg(
            F.min("name").alias("name"),
            F.min("brand").alias("brand"),
            F.min("category").alias("category"),
            F.min("sku").alias("sku"),
            F.min("unit_price").alias("low"),
            F.max("unit_price").alias("high"),
            F.sum("unit_price").alias("price_sum"),
            F.count("unit_price").alias("price_count"),
            F.max("is_active").alias("active"),
            F.min("last_seen_at").alias("first_seen_at"),
        )
    )
    # At most one row per platform is collected into the arrays and the map.
    catalog = per_platform.groupBy("master_sku").agg(
        F.min("name").alias("product_name"),
        F.min("brand").alias("brand"),
        F.min("category").alias("category"),
        F.array_sort(F.collect_set("platform")).alias("platforms"),
        entries_map("platform", "sku").alias("platform_skus"),
        F.min("low").alias("min_price"),
        F.max("high").alias("max_price"),
        F.sum("price_sum").alias("_prices"),
        F.sum("price_count").alias("_priced"),
        F.max("active").alias("is_active"),
        F.count_if("active").alias("platforms_active"),
        F.min("first_seen_at").alias("first_seen_at"),
    )
    sold = (
        with_master_sku(items.where(since_instant("order_date", as_of, 30)), sku_map)
        .groupBy("master_sku")
        .agg(
            F.sum("quantity").alias("total_units_sold"),
            F.sum(F.col("total_price") - F.col("discount")).alias("total_revenue"),
        )
    )
    return (
        catalog.join(sold, "master_sku", "left")
        .withColumns(
            {
                "avg_price": ratio("_prices", "_priced"),
                "total_units_sold": zero("total_units_sold"),
                "total_revenue": zero("total_revenue"),
                "avg_daily_sales": zero("total_units_sold") / 30.0,
            }
        )
        .drop("_prices", "_priced")
    )


def product_sales_ranked(items: DataFrame, sku_map: DataFrame, as_of, materialize: bool = False) -> DataFrame:
    """Daily sales per unified SKU over all platforms with ranks and share of the day's revenue (90 days).

    `materialize=True` checkpoints the daily sums, which ranking and share read several times.
    """
    per_platform = (
        with_master_sku(items.where(since_instant("order_date", as_of, 90)), sku_map)
        .groupBy(F.to_date("order_date").alias("date"), "master_sku", "platform")
        .agg(
            F.min("name").alias("name"),
            F.sum("quantity").alias("units"),
            F.sum("total_price").alias("gross"),
            F.round(F.sum(F.col("total_price") - F.col("discount")), 4).alias("net"),
            F.count_distinct("order_id").alias("orders"),
            F.min("unit_price").alias("low"),
            F.max("unit_price").alias("high"),
        )
    )
    days = per_platform.groupBy("date", "master_sku").agg(
        F.min("name").alias("product_name"),
        F.sum("units").alias("units_sold"),
        F.sum("gross").alias("gross_revenue"),
        F.round(F.sum("net"), 4).alias("net_revenue"),
        F.sum("orders").alias("order_count"),
        entries_map("platform", "units").alias("units_by_platform"),
        entries_map("platform", "net").alias("revenue_by_platform"),
        F.min("low").alias("min_selling_price"),
        F.max("high").alias("max_selling_price"),
    )
    if materialize:
        days = checkpointed(days)
    priced = days.withColumn("avg_selling_price", ratio("gross_revenue", "units_sold"))
    shared = with_share(priced, "net_revenue", ["date"], "pct_of_total_revenue", 100.0)
    # Both rankings in one pass: the two measures are stacked, ranked and laid side by side again.
    stacked = shared.select(
        "*",
        F.inline(
            F.array(
                F.struct(F.lit("units").alias("measure"), F.col("units_sold").cast("double").alias("level")),
                F.struct(F.lit("revenue").alias("measure"), F.col("net_revenue").alias("level")),
            )
        ),
    )
    ranked = with_rank(stacked, ["date", "measure"], "level", "master_sku", "position")
    return ranked.groupBy("date", "master_sku").agg(
        *[F.any_value(c).alias(c) for c in shared.columns if c not in ("date", "master_sku")],
        *[
            F.max(F.when(F.col("measure") == m, F.col("position"))).alias(f"rank_by_{m}")
            for m in ("units", "revenue")
        ],
    )


def unmapped_products(products: DataFrame, items: DataFrame, sku_map: DataFrame) -> DataFrame:
    """Products without a unified SKU, with their sales and a suggestion for review."""
    known = sku_map.select(F.col("platform").alias("_p"), F.col("platform_sku").alias("_s")).distinct()

    def without_mapping(df: DataFrame) -> DataFrame:
        return df.join(known, (F.col("platform") == F.col("_p")) & (F.col("sku") == F.col("_s")), "left_anti")

    sold = (
        without_mapping(items)
        .groupBy(F.col("platform").alias("_ip"), F.col("sku").alias("_is"))
        .agg(
            F.sum("quantity").alias("total_units_sold"),
            F.sum("total_price").alias("total_revenue"),
            F.count_distinct("order_id").alias("order_count"),
        )
    )
    return (
        without_mapping(products)
        .join(sold, (F.col("platform") == F.col("_ip")) & (F.col("sku") == F.col("_is")), "left")
        .select(
            "platform",
            "platform_product_id",
            F.col("sku").alias("platform_sku"),
            F.col("name").alias("product_name"),
            "variation",
            *[zero(c).alias(c) for c in ("total_units_sold", "total_revenue", "order_count")],
            F.col("last_seen_at").alias("first_seen_at"),
            "last_seen_at",
            F.lit("pending").alias("review_status"),
            suggested_master_sku("sku", "name").alias("suggested_master_sku"),
        )
    )


# --- analytics -----------------------------------------------------------------------------------
def analytics_daily(sessions: DataFrame) -> DataFrame:
    """Web traffic per day and property with sessions and users per channel group."""
    channels = sessions.groupBy("date", "property_id", "channel_grouping").agg(
        *[
            F.sum(c).alias(c)
            for c in ("sessions", "engaged_sessions", "total_users", "new_users", "screen_page_views", "transactions", "revenue")
        ],
        *[F.sum(c).alias(f"_s_{c}") for c in ("bounce_rate", "engagement_rate", "avg_session_duration")],
        *[F.count(c).alias(f"_n_{c}") for c in ("bounce_rate", "engagement_rate", "avg_session_duration")],
    )
    mean = lambda c: ratio(F.sum(f"_s_{c}"), F.sum(f"_n_{c}"))
    # A property has at most the fixed list of channel groups, so the maps stay small.
    days = channels.groupBy("date", "property_id").agg(
        F.sum("sessions").alias("total_sessions"),
        F.sum("engaged_sessions").alias("engaged_sessions"),
        F.sum("total_users").alias("total_users"),
        F.sum("new_users").alias("new_users"),
        mean("bounce_rate").alias("avg_bounce_rate"),
        mean("engagement_rate").alias("avg_engagement_rate"),
        mean("avg_session_duration").alias("avg_session_duration"),
        F.sum("screen_page_views").alias("total_page_views"),
        F.sum("transactions").alias("transactions"),
        F.sum("revenue").alias("revenue"),
        entries_map("channel_grouping", "sessions").alias("sessions_by_channel"),
        entries_map("channel_grouping", "total_users").alias("users_by_channel"),
    )
    return days.withColumns(
        {
            "returning_users": F.greatest(F.lit(0), F.col("total_users") - F.col("new_users")),
            "conversion_rate": ratio("transactions", "total_sessions"),
        }
    )


def top_pages_daily(pages: DataFrame) -> DataFrame:
    """Pages per day and property with their rank by views; equal views are ordered by a digest of the path."""
    sums = pages.groupBy("date", "property_id", "page_path").agg(
        F.min("page_title").alias("page_title"),
        *[F.sum(c).alias(c) for c in ("page_views", "unique_page_views", "sessions", "entrances", "exits")],
        F.avg("avg_time_on_page").alias("avg_time_on_page"),
        F.avg("bounce_rate").alias("bounce_rate"),
    )
    rated = sums.withColumn("exit_rate", ratio("exits", "page_views") * 100)
    return with_row_number(rated, ["date", "property_id"], "page_views", "page_path", "page_rank")


def traffic_sources_daily(traffic: DataFrame) -> DataFrame:
    """Source, medium and campaign per day with their shares of sessions and revenue."""
    sums = traffic.groupBy("date", "property_id", "channel_grouping", "source", "medium", "campaign").agg(
        F.sum("sessions").alias("sessions"),
        F.sum("total_users").alias("users"),
        F.sum("new_users").alias("new_users"),
        F.avg("bounce_rate").alias("bounce_rate"),
        F.avg("engagement_rate").alias("engagement_rate"),
        F.avg("avg_session_duration").alias("avg_session_duration"),
        F.sum("transactions").alias("transactions"),
        F.sum("revenue").alias("revenue"),
    )
    rated = sums.withColumn("conversion_rate", ratio("transactions", "sessions"))
    by = ["date", "property_id"]
    return with_share(with_share(rated, "sessions", by, "pct_of_sessions", 100.0), "revenue", by, "pct_of_revenue", 100.0)


def recent(df: DataFrame, as_of, days: int) -> DataFrame:
    return df.where(since_day("date", as_of, days))
