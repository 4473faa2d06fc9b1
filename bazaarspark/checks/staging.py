"""The given tables seen as staging tables, so that marts run over all of their rows."""

from __future__ import annotations

import datetime as dt
import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarspark.functions.labels import channel_grouping
from bazaarspark.session import configure

AS_OF = dt.date(2001, 8, 1)
WEB_SHIFT = 8217  # days between the events' calendar and the orders' calendar
MASTERS = 500
PROPERTY = "properties/1"
# Rows for a task; a part becomes three products, each of them two records or more.
LINES, ORDERS, PARTS = 100_000, 25_000, 20_000


def code(key, names):
    """Value of `names` picked by key modulo their number."""
    return F.get(F.array(*[F.lit(n) for n in names]), F.pmod(key, F.lit(len(names))).cast("int"))


def shop(key):
    return code(key, ("shopee", "lazada", "tiktok_shop"))


def shop_sku(platform, part):
    return F.concat(F.upper(F.substring(platform, 1, 3)), F.lit("-"), part.cast("string"))


class Staging:
    """Staging frames over one folder of given tables. Frames are lazy and built on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = configure(spark)
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, df: DataFrame, key: str, table: str, rows: int) -> DataFrame:
        """Rows over all cores, and over so many tasks that each has about `rows` rows of `table`.

        The given tables are single files, which are read by a task or two; work per record that follows
        (building, parsing and sorting payloads) would otherwise stay there, or grow with the input in as
        many tasks as there are cores. Rows are counted from the files' footers.
        """
        tasks = -(-self.table(table).count() // rows)
        return df.repartition(max(self.spark.sparkContext.defaultParallelism, tasks), key)

    @functools.cached_property
    def order_keys(self) -> DataFrame:
        """Order key, shop platform, order id and date: what items take from their order."""
        o = self.table("orders")
        platform = shop(F.col("o_custkey"))
        return o.select(
            "o_orderkey",
            platform.alias("platform"),
            F.concat_ws("_", platform, F.col("o_orderkey").cast("string")).alias("order_id"),
            F.col("o_orderdate").cast("timestamp").alias("order_date"),
        )

    @functools.cached_property
    def orders(self) -> DataFrame:
        o = self.table("orders")
        counts = self.table("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("item_count"))
        platform = shop(F.col("o_custkey"))
        key = F.col("o_orderkey")
        status = {"F": "completed", "O": "pending", "P": "cancelled"}
        return o.join(counts, F.col("l_orderkey") == key, "left").select(
            F.concat_ws("_", platform, key.cast("string")).alias("order_id"),
            platform.alias("platform"),
            key.cast("string").alias("platform_order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.element_at(F.create_map(*[F.lit(x) for i in status.items() for x in i]), F.col("o_orderstatus")).alias(
                "status"
            ),
            F.col("o_orderdate").cast("timestamp").alias("order_date"),
            F.col("o_totalprice").alias("total"),
            (F.col("o_totalprice") * (key % 10).cast("double") * F.lit(0.01)).alias("discount"),
            (F.col("o_custkey") % 50).cast("double").alias("shipping_fee"),
            F.coalesce("item_count", F.lit(0)).alias("item_count"),
        )

    @functools.cached_property
    def items(self) -> DataFrame:
        i, p = self.table("lineitem"), self.table("part")
        text = {c: F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")}
        return (
            i.join(self.order_keys, F.col("l_orderkey") == F.col("o_orderkey"), "inner")
            .join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
            .select(
                F.concat_ws("_", *text.values()).alias("item_id"),
                "order_id",
                "platform",
                "order_date",
                text["l_partkey"].alias("product_id"),
                shop_sku(F.col("platform"), F.col("l_partkey")).alias("sku"),
                F.col("p_name").alias("name"),
                F.lit(None).cast("string").alias("variation"),
                F.col("l_quantity").cast("long").alias("quantity"),
                (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
                F.col("l_extendedprice").alias("total_price"),
                (F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
            )
        )

    @functools.cached_property
    def products(self) -> DataFrame:
        p = self.spread(self.table("part"), "p_partkey", "part", PARTS)
        each = F.explode(F.array(F.lit("shopee"), F.lit("lazada"), F.lit("tiktok_shop"))).alias("platform")
        return p.select("*", each).select(
            F.concat_ws("_", "platform", F.col("p_partkey").cast("string")).alias("product_id"),
            "platform",
            F.col("p_partkey").cast("string").alias("platform_product_id"),
            shop_sku(F.col("platform"), F.col("p_partkey")).alias("sku"),
            F.col("p_name").alias("name"),
            F.lit(None).cast("string").alias("variation"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("unit_price"),
            (F.col("p_size") != 1).alias("is_active"),
            F.timestamp_seconds(F.lit(996_000_000) + F.col("p_partkey")).alias("last_seen_at"),
        )

    @functools.cached_property
    def sku_map(self) -> DataFrame:
        mapped = self.products.where(F.col("platform_product_id").cast("long") % 20 != 0)
        return mapped.select(
            F.concat(F.lit("M-"), (F.col("platform_product_id").cast("long") % MASTERS).cast("string")).alias("master_sku"),
            "platform",
            F.col("sku").alias("platform_sku"),
            F.col("name").alias("product_name"),
            "variation",
        )

    @functools.cached_property
    def ads(self) -> DataFrame:
        i = self.table("lineitem")
        day = F.to_date("l_shipdate")
        supplier = F.col("l_suppkey")
        names = ("facebook_ads", "google_ads", "tiktok_ads", "line_ads", "shopee_ads", "lazada_ads")
        shown = F.floor(F.col("l_quantity") * 100).cast("long")
        clicks = F.floor(F.col("l_quantity") * F.col("l_tax") * 10).cast("long")
        conversions = F.floor(F.col("l_quantity") * F.col("l_tax")).cast("long")
        spend = F.col("l_extendedprice") * F.lit(0.01)
        return i.select(
            F.concat_ws(
                "_", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
            ).alias("record_id"),
            code(supplier, names).alias("platform"),
            F.concat(F.lit("a_"), (supplier % 7).cast("string")).alias("account_id"),
            F.concat(F.lit("c_"), supplier.cast("string")).alias("campaign_id"),
            F.concat(F.lit("Campaign "), supplier.cast("string")).alias("campaign_name"),
            (F.col("l_partkey") % 4).cast("string").alias("adgroup_id"),
            (F.col("l_partkey") % 12).cast("string").alias("ad_id"),
            F.lit("conversions").alias("campaign_type"),
            F.lit("CONVERSIONS").alias("objective"),
            F.when(supplier % 4 == 0, "paused").otherwise("active").alias("status"),
            F.lit("ad").alias("level"),
            day.alias("date"),
            spend.alias("spend"),
            shown.alias("impressions"),
            clicks.alias("clicks"),
            F.floor(F.col("l_quantity") * 60).cast("long").alias("reach"),
            conversions.alias("conversions"),
            (conversions * F.col("l_extendedprice") * F.lit(0.02)).alias("conversion_value"),
            F.floor(F.col("l_quantity") * 7).cast("long").alias("video_views"),
            F.when(F.col("l_linenumber") != 7, F.col("l_quantity").cast("long")).alias("likes"),
            F.col("l_linenumber").cast("long").alias("comments"),
            (F.col("l_partkey") % 3).alias("shares"),
            F.try_divide(clicks.cast("double"), shown.cast("double")).alias("ctr"),
            F.try_divide(spend, clicks.cast("double")).alias("cpc"),
            F.try_divide(spend * 1000, shown.cast("double")).alias("cpm"),
        )

    @functools.cached_property
    def visits(self) -> DataFrame:
        """Events with the shifted day, source and medium."""
        e = self.table("events")
        sources = ("facebook", "google", "tiktok", "line", "shopee", "lazada", "(direct)")
        return e.select(
            F.date_sub(F.to_date("ts"), WEB_SHIFT).alias("date"),
            code(F.col("user_id"), sources).alias("source"),
            code(F.col("event_id"), ("cpc", "organic", "paid_social", "(none)")).alias("medium"),
            *["event_id", "user_id", "event_type", "value"],
        )

    @functools.cached_property
    def sessions(self) -> DataFrame:
        kind = F.col("event_type")
        return (
            self.visits.groupBy("date", "source", "medium")
            .agg(
                F.count(F.lit(1)).alias("sessions"),
                F.count_if(kind != "error").alias("engaged_sessions"),
                F.count_distinct("user_id").alias("total_users"),
                F.count_distinct(F.when(kind == "signup", F.col("user_id"))).alias("new_users"),
                F.avg(F.when(kind == "error", 1.0).otherwise(0.0)).alias("bounce_rate"),
                F.avg("value").alias("avg_session_duration"),
                F.count_if(kind == "view").alias("screen_page_views"),
                F.count_if(kind == "purchase").alias("transactions"),
                F.sum(F.when(kind == "purchase", F.col("value")).otherwise(0.0)).alias("revenue"),
            )
            .withColumn("property_id", F.lit(PROPERTY))
            .withColumn("campaign", F.lit(None).cast("string"))
            .withColumn("engagement_rate", 1.0 - F.col("bounce_rate"))
            .withColumn("channel_grouping", channel_grouping("source", "medium"))
        )

    @property
    def traffic(self) -> DataFrame:
        return self.sessions

    @functools.cached_property
    def pages(self) -> DataFrame:
        path = F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), (F.col("user_id") % 10).cast("string"))
        return (
            self.visits.groupBy("date", path.alias("page_path"))
            .agg(
                F.count(F.lit(1)).alias("page_views"),
                F.count_distinct("user_id").alias("sessions"),
                F.count_if(F.col("event_id") % 3 == 0).alias("entrances"),
                F.count_if(F.col("event_id") % 5 == 0).alias("exits"),
                F.avg((F.col("event_id") % 2).cast("double")).alias("bounce_rate"),
                F.avg("value").alias("avg_time_on_page"),
            )
            .withColumn("property_id", F.lit(PROPERTY))
            .withColumn("page_title", F.concat(F.lit("Page "), F.col("page_path")))
            .withColumn("unique_page_views", F.col("sessions"))
            .withColumn("exit_rate", F.try_divide(F.col("exits").cast("double"), F.col("page_views")) * 100)
        )
