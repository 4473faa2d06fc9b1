"""Landed payloads: envelopes, response pages, header/detail files, reports and CSV exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarspark.operators.once import computed_once
from bazaarspark.operators.quality import Split, problem, split

ENVELOPE = (
    "type string, platform string, data_type string, level string, shop_id string, region string,"
    " ad_account_id string, customer_id string, advertiser_id string, property_id string, date string,"
    " batch_id string, extracted_at string, data string"
)
ENVELOPE_FIELDS = [part.split()[0] for part in ENVELOPE.split(",")]
CORRUPT = {"columnNameOfCorruptRecord": "_corrupt"}


def from_text(df: DataFrame, column: str = "value", more: tuple[str, ...] = ()) -> DataFrame:
    """Envelope columns, `payload` and `record` from JSON text.

    Records may be bare, wrapped once, or wrapped twice by a later stage; the innermost `data` is the
    payload and the inner envelope's fields fill those the outer one lacks. A text that is no JSON
    object has `malformed` set. `more` names columns of `df` to keep.
    """
    outer = F.from_json("record", ENVELOPE + ", _corrupt string", CORRUPT)
    inner = F.from_json(F.col("_outer.data"), ENVELOPE)
    # Parsed once per record: filters on envelope fields stay above the parse.
    parsed = computed_once(df.select(*more, F.col(column).alias("record")), {"_outer": outer})
    # A payload is read for an inner envelope only if its text has the key, plainly or with an escape.
    within = F.col("_outer.data")
    named = within.contains('data') | within.contains("\\")
    nested = F.when(named & F.get_json_object("_outer.data", "$.data").isNotNull(), inner)
    parsed = computed_once(parsed, {"_nested": nested})
    fields = [c for c in ENVELOPE_FIELDS if c != "data"]
    return parsed.select(
        *more,
        "record",
        (F.col("_outer._corrupt").isNotNull() | F.col("_outer").isNull()).alias("malformed"),
        *[
            # The kind of record is the innermost one; everything else is taken from the outside in.
            F.coalesce(f"_nested.{c}", f"_outer.{c}").alias(c)
            if c == "type"
            else F.coalesce(f"_outer.{c}", f"_nested.{c}").alias(c)
            for c in fields
        ],
        F.col("_outer.data").isNotNull().alias("wrapped"),
        F.coalesce("_nested.data", "_outer.data", "record").alias("payload"),
    )


def landed(
    spark: SparkSession,
    path: str,
    platform: str | None = None,
    first_day: str | None = None,
    last_day: str | None = None,
) -> DataFrame:
    """Records of JSON-lines files, optionally of one platform and a range of extraction days."""
    out = from_text(spark.read.text(path))
    if platform is not None:
        out = out.where(F.col("platform") == platform)
    day = F.substring("extracted_at", 1, 10)
    if first_day is not None:
        out = out.where(day >= first_day)
    if last_day is not None:
        out = out.where(day <= last_day)
    return out


def page_items(pages: DataFrame, body: str, path: tuple[str, ...], keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per item of landed response pages; `path` leads to the list inside the response.

    Items come out as JSON text in `item`, with their position on the page. Pages without the list give
    no rows.
    """
    schema = "array<string>"
    for name in reversed(path):
        schema = f"struct<`{name}`: {schema}>"
    inner = "_page" + "".join(f".`{name}`" for name in path)
    return (
        pages.withColumn("_page", F.from_json(F.col(body), schema))
        .select(*keep, F.posexplode(F.col(inner)).alias("position", "item"))
    )


def stitch_details(
    orders: DataFrame, details: DataFrame, order_key: str, detail_key: str, item: str, name: str = "items"
) -> DataFrame:
    """Attach the item rows of each order as an array; an order without items gets an empty one.

    The array is ordered by content, so reruns agree. Its size is bounded by what one order can hold.
    """
    named = details.where(F.col(detail_key).isNotNull())  # orphans join nothing
    lists = named.groupBy(F.col(detail_key).alias("_key")).agg(F.sort_array(F.collect_list(item)).alias(name))
    empty = F.array().cast(T.ArrayType(details.schema[item].dataType))
    return (
        orders.join(lists, F.col(order_key) == F.col("_key"), "left")
        .withColumn(name, F.coalesce(F.col(name), empty))
        .drop("_key")
    )


def report_rows(reports: DataFrame, dimensions: str, metrics: str, rows: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a report whose header names and positional values are separate arrays.

    Gives one row per report row with the maps `dimensions` and `metrics` from name to value.
    `rows` is array<struct<dimension_values: array<string>, metric_values: array<string>>>.
    """
    return reports.select(*keep, dimensions, metrics, F.explode(rows).alias("_row")).select(
        *keep,
        F.map_from_arrays(F.col(dimensions), F.col("_row.dimension_values")).alias("dimensions"),
        F.map_from_arrays(F.col(metrics), F.col("_row.metric_values")).alias("metrics"),
    )


def realtime_rows(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Active users by country and city out of realtime report rows with dimension and metric maps; a stream or not."""
    return rows.select(
        *keep,
        F.col("property_id"),
        F.try_element_at("dimensions", F.lit("country")).alias("country"),
        F.try_element_at("dimensions", F.lit("city")).alias("city"),
        F.coalesce(F.try_element_at("metrics", F.lit("activeUsers")).try_cast("long"), F.lit(0)).alias("active_users"),
    )


# Entity records (no metrics) per kind: campaign, ad set or ad group, ad, product ad, shop ad.
ENTITY = (
    "id string, campaign_id string, adset_id string, adgroup_id string, ad_id string, name string,"
    " campaign_name string, status string, objective string, budget variant, daily_budget variant,"
    " product_id string, item_id string"
)
ENTITY_KINDS = ("campaign", "adset", "adgroup", "ad", "product_ad", "shop_ad", "sponsored_product")


def entities(raw: DataFrame, kind: str | None = None) -> DataFrame:
    """Campaign structure records: their ids, name and state."""
    out = raw.where(F.col("type").isin(*([kind] if kind else ENTITY_KINDS)) & ~F.col("malformed"))
    parsed = out.withColumn("_e", F.from_json("payload", ENTITY))
    own = F.coalesce(
        *[
            F.when(F.col("type") == k, F.col(f"_e.{c}"))
            for k, c in (
                ("campaign", "campaign_id"),
                ("adset", "adset_id"),
                ("adgroup", "adgroup_id"),
                ("ad", "ad_id"),
                ("product_ad", "product_id"),
                ("sponsored_product", "product_id"),
            )
        ],
        F.col("_e.id"),
        F.col("_e.item_id"),
    )
    return parsed.select(
        "platform",
        F.col("type").alias("entity_kind"),
        own.alias("entity_id"),
        F.col("_e.campaign_id").alias("campaign_id"),
        F.coalesce("_e.name", "_e.campaign_name").alias("name"),
        F.lower("_e.status").alias("status"),
        F.col("_e.objective").alias("objective"),
        F.coalesce(
            F.try_variant_get("_e.budget", "$", "double"), F.try_variant_get("_e.daily_budget", "$", "double")
        ).alias("budget"),
    )


GOOGLE_LEVELS = {
    "campaign": ("campaign",),
    "adgroup": ("campaign", "adGroup"),
    "ad": ("campaign", "adGroup", "adGroupAd"),
    "keyword": ("campaign", "adGroup", "adGroupCriterion"),
}


def google_reports(raw: DataFrame, first_day: str, last_day: str) -> DataFrame:
    """Report rows of all levels between two days in one pass: the level (`type`), all resources and the metrics."""
    schema = (
        "campaign struct<id: string, name: string, status: string, advertisingChannelType: string>,"
        " adGroup struct<id: string, name: string, status: string>,"
        " adGroupAd struct<ad: struct<id: string, name: string>, status: string>,"
        " adGroupCriterion struct<criterionId: string, keyword: struct<text: string, matchType: string>>,"
        " metrics map<string, string>, date string"
    )
    resources = ("campaign", "adGroup", "adGroupAd", "adGroupCriterion")
    day = F.to_date("_g.date")
    parsed = computed_once(raw.where(~F.col("malformed")), {"_g": F.from_json("payload", schema)}, keep=["type", "customer_id"])
    return parsed.where(day.between(F.lit(first_day).cast("date"), F.lit(last_day).cast("date"))).select(
        "type", "customer_id", *[F.col(f"_g.{p}").alias(p) for p in resources], F.col("_g.metrics").alias("metrics"), day.alias("date")
    )


def google_rows(raw: DataFrame, level: str, first_day: str, last_day: str) -> DataFrame:
    """Report rows of one level between two days: ids and names of the level's resources and its metrics."""
    parts = GOOGLE_LEVELS.get(level, tuple(GOOGLE_LEVELS["ad"]))
    return google_reports(raw.where(F.col("type") == level), first_day, last_day).select("customer_id", *parts, "metrics", "date")


def csv_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV export with a header, read with a given schema."""
    return spark.read.csv(path, header=True, schema=schema)


def csv_rows(lines: DataFrame, schema: str, platform: str, at: Column, column: str = "value") -> Split:
    """Rows of CSV lines with the columns of `schema` in order, and dead letters: lines with other cells or too few of them.

    The header line of each file is left out. Works on streams too; a quoted cell cannot hold a line feed.
    """
    names = T.StructType.fromDDL(schema).fieldNames()
    plain = F.lower(F.regexp_replace(column, r'[" \r\x{feff}]', ""))
    text = lines.where((F.trim(column) != "") & (plain != ",".join(names).lower())).select(F.col(column).alias("record"))
    options = {"mode": "PERMISSIVE", **CORRUPT}
    parsed = computed_once(text, {"_row": F.from_csv("record", f"{schema}, _corrupt string", options)})
    whole = problem((F.col("_row._corrupt").isNotNull() | F.col("_row").isNull(), "CSVDecodeError", "a line does not fit the columns"))
    cells = [F.col(f"_row.`{n}`").alias(n) for n in names]
    out = parsed.select("record", *cells, whole.alias("_problem"), F.lit(platform).alias("_platform"))
    parts = split(out, "_problem", "record", "_platform", at)
    return Split(parts.good.drop("_platform"), parts.dead)


def breakdowns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Select the breakdown columns that exist, silently leaving out unknown names."""
    return df.select(*[c for c in wanted if c in df.columns])


def with_status(df: DataFrame, statuses: list[str], column: str = "status") -> DataFrame:
    return df.where(F.col(column).isin(*statuses))


def campaign_rollup(metrics: DataFrame, key: str = "campaign_id") -> DataFrame:
    """Totals per campaign with click rate and cost per click where they are defined."""
    totals = metrics.groupBy(key).agg(
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "spend", "conversions")]
    )

    def positive(top: str, bottom: str) -> Column:
        return F.when(F.col(bottom) > 0, F.try_divide(F.col(top).cast("double"), F.col(bottom)))

    return totals.withColumns({"ctr": positive("clicks", "impressions"), "cpc": positive("spend", "clicks")})
