"""Alert mart from the daily and campaign marts, and the views over it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarspark.functions.dates import as_date, as_instant, between_days, day, since_day
from bazaarspark.functions.fixed_values import SEVERITIES
from bazaarspark.functions.scalars import number_text, ratio, severity_order, stable_id
from bazaarspark.operators.periods import period_sum
from bazaarspark.session import checkpointed

ALERT_COLUMNS = (
    *("alert_id", "alert_type", "severity", "title", "message", "metric_name", "metric_value", "threshold"),
    *("platform", "entity_type", "entity_id", "entity_name", "alert_date", "status", "context", "created_at"),
)


def _level(metric: str, critical: float, warning: float, below: bool) -> tuple[Column, Column]:
    """Severity and crossed threshold of a metric with a critical and a warning limit."""

    def crossed(limit: float) -> Column:
        return F.col(metric) < limit if below else F.col(metric) > limit

    severity = F.when(crossed(critical), "critical").when(crossed(warning), "warning")
    threshold = F.when(crossed(critical), F.lit(critical)).when(crossed(warning), F.lit(warning))
    return severity, threshold


def _alert(
    alert_type: str,
    severity: Column,
    threshold: Column,
    title: Column,
    message: Column,
    metric: str,
    entity: tuple[Column, Column, Column],
    date: Column,
    context: tuple[Column, Column, Column],
) -> Column:
    entity_type, entity_id, entity_name = entity
    revenue, spend, cpa = [c.cast("double") for c in context]
    return F.struct(
        F.lit(alert_type).alias("alert_type"),
        severity.alias("severity"),
        title.alias("title"),
        message.alias("message"),
        F.lit(metric).alias("metric_name"),
        F.col(metric).alias("metric_value"),
        threshold.cast("double").alias("threshold"),
        F.col("platform"),
        entity_type.alias("entity_type"),
        entity_id.alias("entity_id"),
        entity_name.alias("entity_name"),
        date.alias("alert_date"),
        F.struct(revenue.alias("net_revenue"), spend.alias("total_ad_spend"), cpa.alias("cpa")).alias("context"),
    )


def daily_alerts(daily: DataFrame, as_of) -> DataFrame:
    """Low ROAS and high CPA of yesterday: both rules read the row once and emit what applies."""
    here = F.col("platform")
    entity = (
        F.lit("daily"),
        F.concat_ws("_", here, F.col("date").cast("string")),
        F.concat_ws(" - ", here, F.col("date").cast("string")),
    )
    context = (F.col("net_revenue"), F.col("total_ad_spend"), F.col("cpa"))

    def word(severity: Column, critical, warning) -> Column:
        return F.when(severity == "critical", critical).otherwise(warning)

    roas_level, roas_limit = _level("roas", 1.5, 2.0, below=True)
    low_roas = F.when(
        (F.col("total_ad_spend") > 0) & roas_level.isNotNull(),
        _alert(
            "low_roas",
            roas_level,
            roas_limit,
            F.concat(F.lit("Low ROAS"), word(roas_level, F.lit(": "), F.lit(" Warning: ")), here),
            F.concat(
                F.lit("ROAS is "),
                number_text("roas"),
                F.lit(", below "),
                word(roas_level, F.lit("critical threshold of 1.5"), F.lit("warning threshold of 2.0")),
            ),
            "roas",
            entity,
            F.col("date"),
            context,
        ),
    )
    cpa_level, cpa_limit = _level("cpa", 500.0, 300.0, below=False)
    high_cpa = F.when(
        cpa_level.isNotNull(),
        _alert(
            "high_cpa",
            cpa_level,
            cpa_limit,
            F.concat(F.lit("High CPA"), word(cpa_level, F.lit(": "), F.lit(" Warning: ")), here),
            F.concat(
                F.lit("CPA is "),
                number_text("cpa"),
                F.lit(" THB, above "),
                word(cpa_level, F.lit("critical threshold of 500 THB"), F.lit("warning threshold of 300 THB")),
            ),
            "cpa",
            entity,
            F.col("date"),
            context,
        ),
    )
    return daily.where(F.col("date") == day(as_of, 1)).select(F.inline(F.array_compact(F.array(low_roas, high_cpa))))


def revenue_alerts(daily: DataFrame, as_of) -> DataFrame:
    """Week-over-week revenue drops per platform; the current day is not part of either week."""
    weeks = (
        daily.where(between_days("date", as_of, 0, 14))
        .groupBy("platform")
        .agg(
            period_sum("net_revenue", "date", as_of, 7, 0).alias("now"),
            period_sum("net_revenue", "date", as_of, 14, 7).alias("before"),
        )
        .where(F.col("before") > 0)
        .withColumn("revenue_change_pct", ratio(F.col("now") - F.col("before"), "before"))
    )
    level, limit = _level("revenue_change_pct", -0.30, -0.20, below=True)
    here = F.col("platform")
    alert = _alert(
        "revenue_drop",
        level,
        limit,
        F.concat(
            F.lit("Revenue Drop "), F.when(level == "critical", "Critical").otherwise("Warning"), F.lit(": "), here
        ),
        F.concat(
            F.lit("Revenue dropped by "),
            number_text(F.abs("revenue_change_pct") * 100, 1),
            F.lit("% WoW (from "),
            number_text("before"),
            F.lit(" to "),
            number_text("now"),
            F.lit(")"),
        ),
        "revenue_change_pct",
        (
            F.lit("weekly"),
            F.concat(here, F.lit("_week_"), day(as_of, 7).cast("string")),
            F.concat(here, F.lit(" Weekly Revenue")),
        ),
        day(as_of, 1),
        (F.col("now"), F.lit(None), F.lit(None)),
    )
    return weeks.where(level.isNotNull()).select(F.inline(F.array(alert)))


def campaign_alerts(campaigns: DataFrame, as_of) -> DataFrame:
    """Underperforming campaigns of yesterday with more than 100 spent."""
    alert = _alert(
        "campaign_underperforming",
        F.lit("warning"),
        F.lit(None),
        F.concat(F.lit("Underperforming Campaign: "), F.col("campaign_name")),
        F.concat(F.lit("Campaign ROAS ("), number_text("roas"), F.lit(") is significantly below platform benchmark")),
        "roas",
        (F.lit("campaign"), F.col("campaign_id"), F.col("campaign_name")),
        F.col("date"),
        (F.col("conversion_value"), F.col("spend"), F.col("cost_per_conversion")),
    )
    return campaigns.where(
        (F.col("date") == day(as_of, 1)) & (F.col("performance_status") == "underperforming") & (F.col("spend") > 100)
    ).select(F.inline(F.array(alert)))


def finish(alerts: DataFrame, as_of) -> DataFrame:
    """Identifier, state and creation moment. The identifier is derived, so a rerun gives the same."""
    return (
        alerts.withColumn("alert_id", stable_id("alert_type", "platform", "entity_type", "entity_id", "alert_date"))
        .withColumn("status", F.lit("active"))
        .withColumn("created_at", as_instant(as_of))
        .select(*ALERT_COLUMNS)
    )


def simple_alerts(daily: DataFrame, campaigns: DataFrame, as_of, materialize: bool = False) -> DataFrame:
    """All alerts. Two branches read the daily mart: `materialize=True` checkpoints one that is still a plan."""
    if materialize:
        daily = checkpointed(daily)
    branches = daily_alerts(daily, as_of).unionByName(revenue_alerts(daily, as_of))
    return finish(branches.unionByName(campaign_alerts(campaigns, as_of)), as_of)


def active_alerts(
    alerts: DataFrame,
    severity: str | None = None,
    alert_type: str | None = None,
    platform: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Open alerts, worst first, with optional filters. With `limit` the sort becomes a top-k."""
    out = alerts.where(F.col("status") == "active")
    for column, value in (("severity", severity), ("alert_type", alert_type), ("platform", platform)):
        if value is not None:
            out = out.where(F.col(column) == F.lit(value))
    out = out.withColumn("metric_value", F.round("metric_value", 2)).drop("context")
    out = out.orderBy(severity_order("severity"), F.desc("created_at"), "alert_id")
    return out if limit is None else out.limit(limit)


def alert_summary(alerts: DataFrame, as_of) -> DataFrame:
    return (
        alerts.where((F.col("status") == "active") & since_day("alert_date", as_of, 7))
        .groupBy("alert_type", "severity")
        .agg(
            F.count(F.lit(1)).alias("alert_count"),
            F.count_distinct("platform").alias("platforms_affected"),
            F.count_distinct("entity_id").alias("entities_affected"),
            F.min("alert_date").alias("earliest_alert"),
            F.max("alert_date").alias("latest_alert"),
        )
        .orderBy(severity_order("severity"), F.desc("alert_count"), "alert_type")
    )


def platform_alert_health(alerts: DataFrame, as_of) -> DataFrame:
    """Score from 100 down: 20 per critical, 5 per warning, 1 per info alert, never below zero."""
    counted = (
        alerts.where((F.col("status") == "active") & since_day("alert_date", as_of, 7))
        .groupBy("platform")
        .agg(
            *[F.count_if(F.col("severity") == s).alias(f"{s}_alerts") for s in SEVERITIES],
            F.count(F.lit(1)).alias("total_alerts"),
        )
    )
    penalty = F.col("critical_alerts") * 20 + F.col("warning_alerts") * 5 + F.col("info_alerts")
    return counted.withColumn("health_score", F.greatest(F.lit(0), F.lit(100) - penalty)).orderBy(
        "health_score", "platform"
    )


def alert_trend(alerts: DataFrame, as_of) -> DataFrame:
    return (
        alerts.where(since_day("alert_date", as_of, 30))
        .groupBy("alert_date", "alert_type", "severity")
        .agg(F.count(F.lit(1)).alias("alert_count"))
        .orderBy(F.desc("alert_date"), "alert_type", "severity")
    )


def alert_counts(alerts: DataFrame, as_of) -> DataFrame:
    """Open alerts since yesterday by severity, one row."""
    recent = alerts.where((F.col("status") == "active") & since_day("alert_date", as_of, 1))
    return recent.agg(
        *[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITIES], F.count(F.lit(1)).alias("total")
    ).withColumn("as_of", F.lit(as_date(as_of)))
