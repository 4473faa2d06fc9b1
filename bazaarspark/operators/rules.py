"""Threshold rules evaluated as columns: one narrow projection, whatever the number of rows."""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarspark.functions import fixed_values as fixed
from bazaarspark.functions.scalars import compare, stable_id

# Alert type -> metric column it watches.
WATCHED = {
    "low_roas": "roas",
    "high_cpa": "cpa",
    "revenue_drop": "revenue_change_pct",
    "low_conversion_rate": "conversion_rate",
    "high_cancellation_rate": "cancellation_rate",
    # The next two have rules but no published evaluation; the metrics are this package's definition.
    "spend_anomaly": "spend_vs_average",
    "campaign_underperforming": "roas_vs_benchmark_ratio",
}
STANDARD = ("low_roas", "high_cpa", "revenue_drop", "low_conversion_rate", "high_cancellation_rate")


@dataclasses.dataclass(frozen=True)
class Rule:
    name: str
    alert_type: str
    condition: str
    comparison: str
    threshold: float
    severity: str
    enabled: bool = True
    platforms: tuple[str, ...] = ()


def default_rules() -> list[Rule]:
    return [Rule(*values) for values in fixed.DEFAULT_RULES]


def add_rule(rules: Sequence[Rule], rule: Rule) -> list[Rule]:
    return [*rules, rule]


def remove_rule(rules: Sequence[Rule], name: str) -> list[Rule]:
    """The list without the first rule of that name."""
    at = next((i for i, r in enumerate(rules) if r.name == name), None)
    return list(rules) if at is None else [*rules[:at], *rules[at + 1 :]]


def rules_of_type(rules: Sequence[Rule], alert_type: str) -> list[Rule]:
    """Enabled rules of a type, in list order."""
    return [r for r in rules if r.enabled and r.alert_type == alert_type]


def rules_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """The rule list as a table, in order."""
    rows = [
        (i, r.name, r.alert_type, r.condition, r.comparison, float(r.threshold), r.severity, r.enabled, list(r.platforms))
        for i, r in enumerate(rules)
    ]
    return spark.createDataFrame(
        rows,
        "position int, name string, alert_type string, condition string, comparison string, threshold double,"
        " severity string, enabled boolean, platforms array<string>",
    )


def rules_from_frame(df: DataFrame) -> list[Rule]:
    """Rule list from a rules table. Rules are configuration, which the driver holds anyway."""
    rows = df.orderBy("position").collect()
    return [
        Rule(
            r.name, r.alert_type, r.condition, r.comparison, r.threshold, r.severity, r.enabled, tuple(r.platforms or ())
        )
        for r in rows
    ]


def _wording(alert_type: str, metric: Column, threshold: float) -> tuple[str, Column]:
    percent = metric * 100
    if alert_type == "low_roas":
        return "Low ROAS", F.format_string(f"ROAS is %.2f, below threshold of {threshold}", metric)
    if alert_type == "high_cpa":
        return "High CPA", F.format_string(f"CPA is %.2f THB, above threshold of {threshold} THB", metric)
    if alert_type == "revenue_drop":
        return "Revenue Drop", F.format_string("Revenue dropped by %.1f%% compared to previous period", F.abs(percent))
    if alert_type == "low_conversion_rate":
        limit = f"{threshold * 100:.1f}%%"
        return "Low Conversion Rate", F.format_string(f"Conversion rate is %.2f%%, below threshold of {limit}", percent)
    if alert_type == "high_cancellation_rate":
        limit = f"{threshold * 100:.1f}%%"
        return (
            "High Cancellation Rate",
            F.format_string(f"Cancellation rate is %.1f%%, above threshold of {limit}", percent),
        )
    if alert_type == "spend_anomaly":
        return "Spend Anomaly", F.format_string("Spend is %.1f%% above its average", percent)
    return "Campaign Underperforming", F.format_string("ROAS is %.1f%% of the platform benchmark", percent)


def _first_match(rules: Sequence[Rule], alert_type: str) -> Column:
    """Struct of the first rule in list order that applies to the row, NULL when none does."""
    metric = F.col(WATCHED[alert_type]).cast("double")
    found = F.lit(None)
    for rule in reversed(rules_of_type(rules, alert_type)):
        applies = compare(metric, rule.comparison, F.lit(float(rule.threshold)))
        if rule.platforms:
            applies = applies & F.col("platform").isin(*rule.platforms)
        title, message = _wording(alert_type, metric, rule.threshold)
        alert = F.struct(
            F.lit(alert_type).alias("alert_type"),
            F.lit(rule.severity).alias("severity"),
            F.concat(F.lit(f"{title}: "), F.col("entity_name")).alias("title"),
            message.alias("message"),
            F.lit(WATCHED[alert_type]).alias("metric_name"),
            metric.alias("metric_value"),
            F.lit(float(rule.threshold)).alias("threshold"),
            F.lit(rule.name).alias("rule_name"),
        )
        found = F.when(applies, alert).otherwise(found)
    return found


def evaluate(
    metrics: DataFrame, rules: Sequence[Rule] | None = None, alert_types: Sequence[str] = STANDARD
) -> DataFrame:
    """Alerts of every metric row: per alert type the first enabled rule in list order that triggers.

    `metrics` has platform, entity_type, entity_id, entity_name, date and any of the metric columns; a
    missing column or a NULL value raises nothing. Rules become part of the expression, so evaluation is
    a map over the rows and needs neither a join nor a shuffle.
    """
    rules = default_rules() if rules is None else rules
    present = [t for t in alert_types if WATCHED[t] in metrics.columns and rules_of_type(rules, t)]
    entity = [F.col(c) for c in ("platform", "entity_type", "entity_id", "entity_name", "date")]
    if not present:
        found = F.array().cast(
            "array<struct<alert_type:string,severity:string,title:string,message:string,metric_name:string,"
            "metric_value:double,threshold:double,rule_name:string>>"
        )
    else:
        found = F.array_compact(F.array(*[_first_match(rules, t) for t in present]))
    return metrics.select(*entity, F.inline(found)).withColumns(
        {
            "alert_id": stable_id("alert_type", "platform", "entity_type", "entity_id", "date"),
            "status": F.lit("active"),
        }
    )
