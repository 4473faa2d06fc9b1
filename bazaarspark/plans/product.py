"""Product mart: daily sales per unified SKU and platform, with product details and history, and views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bazaarspark.functions.dates import since_day, since_instant
from bazaarspark.functions.fixed_values import SHOP_PLATFORMS
from bazaarspark.functions.scalars import growth, ratio
from bazaarspark.operators.periods import period_sum
from bazaarspark.operators.rolling import rolling_days, rolling_rows
from bazaarspark.session import checkpointed

LOOKBACK = 90
SALES_GRAIN = ("date", "master_sku", "platform", "product_name", "variation")


def with_master_sku(df: DataFrame, sku_map: DataFrame) -> DataFrame:
    """Attach the unified SKU, the platform's own where the map has none.

    The map grows with the catalogue, and Spark's estimate of a map derived from other tables (from their compressed
    files, before they are expanded) can be far too low: it would be broadcast whole into every task. So it is always
    sorted and merged, which splits partitions that a hot SKU makes too large.
    """
    m = sku_map.select(
        F.col("platform").alias("_platform"), F.col("platform_sku").alias("_sku"), F.col("master_sku").alias("_master")
    ).hint("merge")
    return (
        df.join(m, (df["platform"] == m["_platform"]) & (df["sku"] == m["_sku"]), "left")
        .withColumn("master_sku", F.coalesce("_master", "sku"))
        .drop("_platform", "_sku", "_master")
    )


def enriched_items(items: DataFrame, orders: DataFrame, sku_map: DataFrame, as_of) -> DataFrame:
    """Items of the last 90 days with unified SKU and order status.

    An item carries the date of its order, so the same bound also cuts the order side before the one
    large join; both scans then read only the partitions of the window.
    """
    recent = since_instant("order_date", as_of, LOOKBACK)
    bought = items.where(recent).select(
        *["order_id", "platform", "sku", F.col("name").alias("product_name"), "variation"],
        *["quantity", "unit_price", "total_price", "discount", "order_date"],
    )
    statuses = orders.where(recent).select("order_id", F.col("status").alias("order_status"))
    return with_master_sku(bought.join(statuses, "order_id", "left"), sku_map)


def daily_product_sales(enriched: DataFrame) -> DataFrame:
    completed = F.col("order_status") == "completed"
    cancelled = F.col("order_status") == "cancelled"
    return enriched.groupBy(
        F.to_date("order_date").alias("date"), "master_sku", "platform", "product_name", "variation"
    ).agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("total_price").alias("gross_revenue"),
        F.sum(F.col("total_price") - F.col("discount")).alias("net_revenue"),
        F.sum("discount").alias("total_discount"),
        F.count_distinct("order_id").alias("order_count"),
        F.sum(F.when(completed, F.col("quantity")).otherwise(0)).alias("units_completed"),
        F.sum(F.when(completed, F.col("total_price")).otherwise(0.0)).alias("revenue_completed"),
        F.sum(F.when(cancelled, F.col("quantity")).otherwise(0)).alias("units_cancelled"),
        F.avg("unit_price").alias("avg_unit_price"),
        F.avg("quantity").alias("avg_quantity_per_order"),
    )


def product_info(products: DataFrame, sku_map: DataFrame, fan_out: bool = False) -> DataFrame:
    """Name, category and brand from the latest product of a unified SKU, price per platform.

    Latest means greatest last_seen_at, then product id and SKU. One row per unified SKU and platform;
    `fan_out=True` keeps one row per product, which multiplies sales rows as the published mart does.
    """
    mapped = with_master_sku(products, sku_map)
    order = F.struct("last_seen_at", "product_id", "sku")
    per_platform = mapped.groupBy("master_sku", "platform").agg(
        F.max(order).alias("_order"),
        F.max_by(F.struct("name", "category", "brand"), order).alias("_named"),
        F.max_by(F.struct("unit_price", "is_active"), order).alias("_offer"),
    )
    named = per_platform.groupBy(F.col("master_sku").alias("_master")).agg(
        F.max_by("_named", "_order").alias("_latest")
    )
    offers = (
        mapped.select("master_sku", "platform", F.struct("unit_price", "is_active").alias("_offer"))
        if fan_out
        else per_platform.select("master_sku", "platform", "_offer")
    )
    return offers.join(named, F.col("master_sku").eqNullSafe(F.col("_master")), "left").select(
        "master_sku",
        "platform",
        F.col("_latest.name").alias("canonical_name"),
        F.col("_latest.category").alias("category"),
        F.col("_latest.brand").alias("brand"),
        F.col("_offer.unit_price").alias("current_price"),
        F.col("_offer.is_active").alias("is_active"),
    )


def product_history(sales: DataFrame, as_of) -> DataFrame:
    return sales.groupBy("master_sku", "platform").agg(
        period_sum("units_sold", "date", as_of, 7).alias("units_7d"),
        period_sum("units_sold", "date", as_of, 14, 7).alias("units_prev_7d"),
        period_sum("units_sold", "date", as_of, 30).alias("units_30d"),
        period_sum("units_sold", "date", as_of, 60, 30).alias("units_prev_30d"),
        period_sum("net_revenue", "date", as_of, 30).alias("revenue_30d"),
        period_sum("net_revenue", "date", as_of, 60, 30).alias("revenue_prev_30d"),
    )


def product_performance(
    items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    sku_map: DataFrame,
    as_of,
    fan_out: bool = False,
    materialize: bool = False,
    formed: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """Daily sales with product details and history.

    `formed` is applied to the sales and to the product details before they meet, so its work does not grow with the
    rows that `fan_out` makes.

    The daily sales feed the mart and the history. `materialize=True` checkpoints them, so that the large
    join of items and orders runs once; it runs that job right away.
    """
    sales = daily_product_sales(enriched_items(items, orders, sku_map, as_of))
    if materialize:
        sales = checkpointed(sales)
    info = product_info(products, sku_map, fan_out)
    key = ["master_sku", "platform"]
    if fan_out:
        # Few rows become very many, which adaptive execution cannot see: it would merge them into a task or two.
        tasks = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sales, info = sales.repartition(tasks, *key), info.repartition(tasks, *key)
    return with_info(formed(sales_measures(sales, as_of)), formed(info))


INFO = ("canonical_name", "category", "brand", "current_price", "is_active")


def with_info(measures: DataFrame, info: DataFrame) -> DataFrame:
    """Every row of `sales_measures` with the product details of its unified SKU and platform, once for each row of them."""
    rest = [c for c in measures.columns if c not in SALES_GRAIN]
    return measures.join(info, ["master_sku", "platform"], "left").select(*SALES_GRAIN, *INFO, *rest)


def sales_measures(sales: DataFrame, as_of) -> DataFrame:
    """Daily sales with their history and all measures: computed once for a sale, however many products it meets."""
    joined = sales.join(product_history(sales, as_of), ["master_sku", "platform"], "left")
    return joined.select(
        *SALES_GRAIN,
        *["units_sold", "gross_revenue", "net_revenue", "total_discount", "order_count"],
        *["units_completed", "revenue_completed", "units_cancelled", "avg_unit_price", "avg_quantity_per_order"],
        ratio("net_revenue", "order_count").alias("avg_order_value"),
        ratio("total_discount", "gross_revenue").alias("discount_rate"),
        *["units_7d", "units_prev_7d"],
        growth("units_7d", "units_prev_7d").alias("units_growth_wow"),
        *["units_30d", "units_prev_30d"],
        growth("units_30d", "units_prev_30d").alias("units_growth_mom"),
        *["revenue_30d", "revenue_prev_30d"],
        growth("revenue_30d", "revenue_prev_30d").alias("revenue_growth_mom"),
        ratio("units_cancelled", "units_sold").alias("cancellation_rate"),
        ratio("units_completed", "units_sold").alias("completion_rate"),
    )


def latest_day(mart: DataFrame) -> DataFrame:
    """Rows of the last day in the mart; the day is a scalar subquery."""
    return mart.where(F.col("date") == mart.agg(F.max("date")).scalar())


def product_cross_platform(mart: DataFrame) -> DataFrame:
    """Latest day per unified SKU over all platforms. Names are the alphabetically first, so they are stable."""

    def on(platform: str, measure: str):
        return F.sum(F.when(F.col("platform") == platform, F.col(measure)).otherwise(0))

    short = {"shopee": "shopee", "lazada": "lazada", "tiktok_shop": "tiktok"}
    return (
        latest_day(mart)
        .groupBy("master_sku")
        .agg(
            F.min("canonical_name").alias("product_name"),
            F.min("category").alias("category"),
            F.min("brand").alias("brand"),
            F.array_sort(F.collect_set("platform")).alias("platforms"),
            F.count_distinct("platform").alias("platform_count"),
            F.sum("units_30d").alias("total_units_30d"),
            F.sum("revenue_30d").alias("total_revenue_30d"),
            *[on(p, "units_30d").alias(f"{short[p]}_units_30d") for p in SHOP_PLATFORMS],
            *[on(p, "revenue_30d").alias(f"{short[p]}_revenue_30d") for p in SHOP_PLATFORMS],
            F.avg("units_growth_mom").alias("avg_units_growth_mom"),
            F.avg("revenue_growth_mom").alias("avg_revenue_growth_mom"),
        )
        .orderBy(F.desc("total_revenue_30d"), "master_sku")
    )


def top_products(mart: DataFrame, as_of, k: int = 100) -> DataFrame:
    return (
        mart.where(since_day("date", as_of, 30))
        .groupBy("master_sku", "platform", "product_name", "category", "brand")
        .agg(
            F.sum("units_sold").alias("total_units"),
            F.sum("net_revenue").alias("total_revenue"),
            F.avg("avg_unit_price").alias("avg_price"),
            F.avg("discount_rate").alias("avg_discount_rate"),
            F.avg("completion_rate").alias("avg_completion_rate"),
            F.max("units_growth_wow").alias("latest_growth_wow"),
            F.max("units_growth_mom").alias("latest_growth_mom"),
        )
        .orderBy(F.desc("total_revenue"), "master_sku", "platform", "product_name", "category", "brand")
        .limit(k)
    )


def product_trend(mart: DataFrame, as_of, calendar_days: bool = False) -> DataFrame:
    """Rolling week of units and revenue per unified SKU and platform, over seven rows (or calendar days)."""
    measures = {
        "units_7d_rolling": ("sum", "units_sold"),
        "revenue_7d_rolling": ("sum", "net_revenue"),
    }
    recent = mart.where(since_day("date", as_of, 60)).select(
        "date", "master_sku", "platform", "product_name", "variation", "units_sold", "net_revenue"
    )
    keys = ["master_sku", "platform"]
    rolled = (
        rolling_days(recent, keys, "date", measures)
        if calendar_days
        else rolling_rows(recent, keys, "date", ["product_name", "variation"], measures)
    )
    return rolled.drop("variation").orderBy(F.desc("date"), "master_sku", "platform")


def category_performance(mart: DataFrame) -> DataFrame:
    return (
        latest_day(mart)
        .where(F.col("category").isNotNull())
        .groupBy("category", "platform")
        .agg(
            F.count_distinct("master_sku").alias("product_count"),
            F.sum("units_30d").alias("total_units_30d"),
            F.sum("revenue_30d").alias("total_revenue_30d"),
            F.avg("avg_unit_price").alias("avg_price"),
            F.avg("discount_rate").alias("avg_discount_rate"),
            F.avg("completion_rate").alias("avg_completion_rate"),
            F.avg("units_growth_mom").alias("avg_growth_mom"),
        )
        .orderBy(F.desc("total_revenue_30d"), "category", "platform")
    )
