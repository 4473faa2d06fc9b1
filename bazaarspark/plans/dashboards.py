"""Report queries over the marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarspark.functions.dates import as_date, between_days, since_day
from bazaarspark.functions.labels import guarded, roas_grade
from bazaarspark.functions.scalars import col, ratio
from bazaarspark.operators.periods import period_sum
from bazaarspark.operators.ranking import top_per_group
from bazaarspark.operators.shares import with_share


def change_percent(now: Column, before: Column) -> Column:
    """Change in percent; 100 when something follows nothing, 0 when nothing follows nothing."""
    return F.when(before == 0, F.when(now > 0, 100.0).otherwise(0.0)).otherwise(ratio(now - before, before) * 100)


def scorecard(daily: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Revenue, orders, spend and ROAS of the last `days` full days and of as many before, one row per figure.

    `daily` must be the additive daily mart.
    """
    sums = {"revenue": "net_revenue", "orders": "total_orders", "ad_spend": "total_ad_spend"}
    one = daily.agg(
        *[period_sum(c, "date", as_of, days, 0).cast("double").alias(f"{n}_now") for n, c in sums.items()],
        *[period_sum(c, "date", as_of, 2 * days, days).cast("double").alias(f"{n}_before") for n, c in sums.items()],
    )
    figures = [F.struct(F.lit(n).alias("figure"), F.col(f"{n}_now").alias("current"), F.col(f"{n}_before").alias("previous")) for n in sums]
    figures.append(
        F.struct(
            F.lit("roas").alias("figure"),
            ratio("revenue_now", "ad_spend_now").alias("current"),
            ratio("revenue_before", "ad_spend_before").alias("previous"),
        )
    )
    return one.select(F.inline(F.array(*figures))).withColumn(
        "change_pct", change_percent(F.col("current"), F.col("previous"))
    )


def share_breakdown(mart: DataFrame, dimension: str, measure: str, as_of, days: int = 30) -> DataFrame:
    """Sum and percentage of the total of `measure` per value of `dimension`."""
    sums = mart.where(since_day("date", as_of, days)).groupBy(dimension).agg(F.sum(measure).alias("amount"))
    return with_share(sums, "amount", [], "share_pct", 100.0)


def calculated_fields(daily: DataFrame) -> DataFrame:
    """Zero-guarded report fields per row of the daily mart."""
    return daily.select(
        "date",
        "platform",
        guarded("net_revenue", "total_ad_spend").alias("roas"),
        guarded("total_ad_spend", "total_conversions").alias("cpa"),
        guarded("total_clicks", "total_impressions", 100.0).alias("ctr_pct"),
        guarded("total_conversions", "total_clicks", 100.0).alias("cvr_pct"),
        guarded("net_revenue", "total_orders").alias("aov"),
    )


def growth_rates(orders: DataFrame, as_of) -> DataFrame:
    """Week, month and year growth of revenue per platform: last 7/30/365 days against those before."""
    dated = orders.select("platform", F.to_date("order_date").alias("date"), "total").where(
        between_days("date", as_of, 0, 730)
    )
    spans = {"wow": 7, "mom": 30, "yoy": 365}
    sums = dated.groupBy("platform").agg(
        *[period_sum("total", "date", as_of, n, 0).alias(f"{k}_now") for k, n in spans.items()],
        *[period_sum("total", "date", as_of, 2 * n, n).alias(f"{k}_before") for k, n in spans.items()],
    )
    return sums.select(
        "platform",
        *[(ratio(F.col(f"{k}_now") - F.col(f"{k}_before"), f"{k}_before") * 100).alias(f"{k}_growth_pct") for k in spans],
    )


def top_and_other(df: DataFrame, dimension: str, measure: str, k: int = 5) -> DataFrame:
    """The k largest values of `dimension` and the rest summed as Other.

    The k names are found by a top-k over the reduced sums; everything else keeps being aggregated in
    parallel, so any number of values works.
    """
    sums = df.groupBy(F.coalesce(F.col(dimension), F.lit("(none)")).alias(dimension)).agg(F.sum(measure).alias(measure))
    # k rows, by the limit: safe to broadcast.
    largest = F.broadcast(
        sums.orderBy(F.desc(measure), dimension).limit(k).select(F.col(dimension).alias("_top"))
    )
    named = sums.join(largest, F.col(dimension) == F.col("_top"), "left")
    slice_name = F.when(F.col("_top").isNull(), "Other").otherwise(F.col(dimension))
    return named.groupBy(slice_name.alias("slice")).agg(F.sum(measure).alias(measure))


def top_products_table(products: DataFrame, as_of, k: int = 10) -> DataFrame:
    """The k best-selling unified SKUs of 30 days with their share of all revenue."""
    sums = (
        products.where(since_day("date", as_of, 30))
        .groupBy("master_sku")
        .agg(
            F.min("product_name").alias("product_name"),
            F.sum("net_revenue").alias("sales"),
            F.sum("units_sold").alias("units"),
        )
    )
    shared = with_share(sums, "sales", [], "revenue_pct", 100.0)
    first = shared.orderBy(F.desc(F.round("sales", 4)), "master_sku").limit(k)
    return top_per_group(first, [], [F.desc(F.round("sales", 4)), F.col("master_sku")], k, "rank")


def top_pages_table(pages: DataFrame, k: int = 10) -> DataFrame:
    sums = pages.groupBy("page_path").agg(
        F.sum("page_views").alias("views"), F.avg("avg_time_on_page").alias("avg_time")
    )
    first = sums.orderBy(F.desc("views"), "page_path").limit(k)
    return top_per_group(first, [], [F.desc("views"), F.col("page_path")], k, "rank")


def platform_top_products(products: DataFrame, as_of, k: int = 5) -> DataFrame:
    """The k best-selling unified SKUs per platform."""
    sums = (
        products.where(since_day("date", as_of, 30))
        .groupBy("platform", "master_sku")
        .agg(F.sum("net_revenue").alias("sales"))
    )
    return top_per_group(sums, ["platform"], [F.desc(F.round("sales", 4)), F.col("master_sku")], k, "rank")


def conversion_goals(events: DataFrame, goals: Sequence[str]) -> DataFrame:
    """Completions, rate over all sessions (users by day) and value per event type of `goals`."""
    base = events.groupBy(F.to_date("ts").alias("_day"), "user_id").agg(F.lit(1).alias("_one"))
    visits = base.agg(F.count(F.lit(1)).alias("n")).scalar()
    done = events.where(F.col("event_type").isin(*goals)).groupBy(F.col("event_type").alias("goal")).agg(
        F.count(F.lit(1)).alias("completions"), F.sum("value").alias("value")
    )
    return done.withColumns(
        {"rate_pct": ratio("completions", visits) * 100, "value_per_completion": ratio("value", "completions")}
    )


def shop_trend(orders: DataFrame, as_of, days: int = 30, series: int = 5) -> DataFrame:
    """Daily revenue of the shops with the most revenue in the window, at most `series` of them."""
    daily = (
        orders.select("platform", F.to_date("order_date").alias("date"), "total")
        .where(since_day("date", as_of, days))
        .groupBy("date", "platform")
        .agg(F.sum("total").alias("revenue"))
    )
    largest = (
        daily.groupBy(F.col("platform").alias("_p"))
        .agg(F.sum("revenue").alias("_r"))
        .orderBy(F.desc(F.round("_r", 4)), "_p")
        .limit(series)
    )
    return daily.join(F.broadcast(largest), F.col("platform") == F.col("_p"), "left_semi")


def headline_flags(daily_total: DataFrame, as_of) -> DataFrame:
    """Report flags per day: ROAS below 2, revenue more than 10 % under the day seven days earlier."""
    rows = daily_total.where(since_day("date", as_of, 30)).select("date", "net_revenue", "total_ad_spend")
    earlier = daily_total.select(F.date_add("date", 7).alias("date"), F.col("net_revenue").alias("revenue_before"))
    joined = rows.join(earlier, "date", "left")
    change = ratio(F.col("net_revenue") - F.col("revenue_before"), "revenue_before")
    return joined.select(
        "date",
        ratio("net_revenue", "total_ad_spend").alias("roas"),
        F.when(ratio("net_revenue", "total_ad_spend") < 2, "ROAS Below Target").otherwise("").alias("roas_flag"),
        F.when(change < -0.1, "Revenue Dropped >10%").otherwise("").alias("revenue_flag"),
        roas_grade(ratio("net_revenue", "total_ad_spend")).alias("roas_grade"),
    )


def device_summary(visits: DataFrame) -> DataFrame:
    """Sessions, users, bounces and purchases per day and device."""
    kind = F.col("event_type")
    sums = visits.groupBy("date", "device_category").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_distinct("user_id").alias("users"),
        (F.avg(F.when(kind == "error", 100.0).otherwise(0.0))).alias("bounce_rate"),
        F.count_if(kind == "view").alias("pageviews"),
        F.avg("value").alias("avg_session_duration"),
        F.count_if(kind == "purchase").alias("conversions"),
        F.sum(F.when(kind == "purchase", F.col("value")).otherwise(0.0)).alias("revenue"),
    )
    return sums.withColumn("pages_per_session", ratio("pageviews", "sessions"))


def daily_overview(visits: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    sums = visits.groupBy("date").agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct(F.when(kind == "signup", F.col("user_id"))).alias("new_users"),
        F.count_if(kind == "view").alias("pageviews"),
        F.avg("value").alias("avg_session_duration"),
        F.avg(F.when(kind == "error", 100.0).otherwise(0.0)).alias("bounce_rate"),
        F.count_if(kind == "purchase").alias("conversions"),
        F.sum(F.when(kind == "purchase", F.col("value")).otherwise(0.0)).alias("revenue"),
    )
    return sums.withColumns(
        {
            "pages_per_session": ratio("pageviews", "sessions"),
            "conversion_rate": ratio("conversions", "sessions") * 100,
        }
    )


def apply_filters(
    df: DataFrame,
    start: dt.date | str | None = None,
    end: dt.date | str | None = None,
    date_column: str = "date",
    **values: str | Sequence[str] | None,
) -> DataFrame:
    """Optional report filters: a date range and any number of `column=value` or `column=[values]`.

    Values become literals of column predicates, so they reach the scan and cannot change the query.
    """
    if start is not None:
        df = df.where(col(date_column) >= F.lit(as_date(start)))
    if end is not None:
        df = df.where(col(date_column) <= F.lit(as_date(end)))
    for column, wanted in values.items():
        if wanted is None:
            continue
        if column not in df.columns:
            raise ValueError(f"no column {column} to filter by")
        df = df.where(F.col(column) == F.lit(wanted) if isinstance(wanted, str) else F.col(column).isin(*wanted))
    return df
