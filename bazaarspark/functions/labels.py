"""Classification columns: channels, performance classes, flags, suggested SKUs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarspark.functions import fixed_values as fixed
from bazaarspark.functions.scalars import col, lookup


def shop_of_ads(platform) -> Column:
    """Shop platform behind an advertising platform; 'all' when not tied to one shop."""
    return lookup(platform, fixed.ADS_TO_SHOP)


def ads_channel(source, medium) -> Column:
    """Advertising platform a web visit came through, by source and medium. Order matters."""
    source, medium = F.lower(col(source)), F.lower(col(medium))

    def named(part: str) -> Column:
        return source.contains(part)

    return (
        F.when(named("facebook") | (medium == "paid_social"), "facebook_ads")
        .when(named("google") & medium.isin("cpc", "ppc"), "google_ads")
        .when(named("tiktok"), "tiktok_ads")
        .when(named("line"), "line_ads")
        .when(named("shopee"), "shopee_ads")
        .when(named("lazada"), "lazada_ads")
        .otherwise("organic_and_other")
    )


def channel_grouping(source, medium) -> Column:
    """Default channel group of a source/medium pair; exact match on trimmed lower-case text."""
    source = F.trim(F.lower(F.coalesce(col(source), F.lit(""))))
    medium = F.trim(F.lower(F.coalesce(col(medium), F.lit(""))))
    group = F.when(source.isin(*fixed.DIRECT_SOURCES) & medium.isin(*fixed.DIRECT_MEDIUMS), "Direct")
    for name, mediums, sources in fixed.CHANNELS:
        here = medium.isin(*mediums)
        group = group.when(here | source.isin(*sources) if sources else here, name)
    return group.otherwise("Other")


def trend_class(change) -> Column:
    """growing / declining / stable by a relative change of 10 %; unknown change counts as stable."""
    change = col(change)
    return F.when(change > 0.1, "growing").when(change < -0.1, "declining").otherwise("stable")


def campaign_class(roas, benchmark, spend, days_active, status) -> Column:
    roas, benchmark = col(roas), col(benchmark)
    spends = col(spend) > 0
    return (
        F.when(spends & (roas > benchmark * 1.5), "top_performer")
        .when(spends & (roas > benchmark), "good")
        .when(spends & (roas < benchmark * 0.5), "underperforming")
        .when(col(days_active) < 7, "learning")
        .when(col(status) == "paused", "paused")
        .otherwise("average")
    )


def optimization_flag(ctr, benchmark_ctr, cpc, benchmark_cpc, conversion_rate) -> Column:
    return (
        F.when(col(ctr) < col(benchmark_ctr) * 0.7, "low_ctr")
        .when(col(cpc) > col(benchmark_cpc) * 1.3, "high_cpc")
        .when(col(conversion_rate) < 0.01, "low_cvr")
    )


def roas_grade(roas) -> Column:
    """Report flag: Good from 4, OK from 2, otherwise Poor (also when unknown)."""
    return F.when(col(roas) >= 4, "Good").when(col(roas) >= 2, "OK").otherwise("Poor")


def guarded(top, bottom, scale: float = 1.0) -> Column:
    """Report field: scaled quotient, 0 unless the denominator is positive."""
    return F.when(col(bottom) > 0, F.try_divide(col(top).cast("double"), col(bottom)) * scale).otherwise(0.0)


def suggested_master_sku(platform_sku, product_name) -> Column:
    """Proposal for a unified SKU: the platform's own if it looks like one, else built from the name."""
    sku = F.coalesce(col(platform_sku), F.lit(""))
    name = F.trim(F.coalesce(col(product_name), F.lit("")))
    words = F.slice(F.filter(F.split(name, r"\s+"), lambda w: w != ""), 1, 3)
    prefix = F.array_join(F.transform(words, lambda w: F.upper(F.substring(w, 1, 2))), "")
    from_name = F.when(
        F.length(sku) > 0, F.concat(prefix, F.lit("-"), F.upper(F.substring(sku, 1, 8)))
    ).otherwise(prefix)
    return (
        F.when((F.length(sku) > 0) & (F.length(sku) <= 20) & sku.contains("-"), F.upper(sku))
        .when(F.length(F.coalesce(col(product_name), F.lit(""))) > 0, from_name)
        .when(F.length(sku) > 0, F.upper(sku))
        .otherwise("UNKNOWN")
    )


def rfm_segment(recency, frequency, monetary) -> Column:
    """Customer segment from 1-5 scores (own definition, five is best)."""
    r, f, m = col(recency), col(frequency), col(monetary)
    return (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
        .when((r >= 3) & (f >= 3), "Loyal")
        .when((r >= 4) & (f <= 2), "New")
        .when((r <= 2) & (f >= 3), "At Risk")
        .when((r <= 2) & (f <= 2), "Hibernating")
        .otherwise("Potential")
    )
