"""Landed records derived from the given tables: every row becomes a platform payload in JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarspark.checks.staging import LINES, ORDERS, PROPERTY, Staging, code
from bazaarspark.sources.landing import from_text, stitch_details


def json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def text(c) -> Column:
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def envelope(payload: Column, **fields: Column) -> Column:
    """Payload text inside an envelope."""
    outer = json(**fields)
    return F.concat(F.rtrim(outer, F.lit("}")), F.lit(',"data":'), payload, F.lit("}"))


def iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def priced_orders(s: Staging) -> DataFrame:
    """Orders with their line items as an array."""
    line = s.table("lineitem").select(
        "l_orderkey",
        F.struct(
            *["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"]
        ).alias("line"),
    )
    orders = s.table("orders").withColumn("placed", F.col("o_orderdate").cast("timestamp"))
    return stitch_details(orders, line, "o_orderkey", "l_orderkey", "line", "lines")


def key() -> Column:
    return F.col("o_orderkey")


STATES = {
    "shopee": {"F": "COMPLETED", "O": "UNPAID", "P": "CANCELLED"},
    "lazada": {"F": "delivered", "O": "pending", "P": "cancelled"},
    "tiktok_shop": {"F": "DELIVERED", "O": "UNPAID", "P": "ON_HOLD"},
}


def state(platform: str) -> Column:
    pairs = [F.lit(x) for i in STATES[platform].items() for x in i]
    return F.element_at(F.create_map(*pairs), F.col("o_orderstatus"))


def lines(build) -> Column:
    return F.transform("lines", lambda i: F.struct(*[c.alias(n) for n, c in build(i).items()]))


def shopee_payload() -> Column:
    return json(
        # Without a number the record cannot be identified: it becomes a dead letter.
        order_sn=F.when(key() % 11 != 0, text(key())),
        order_status=state("shopee"),
        buyer_user_id=F.col("o_custkey"),
        create_time=F.unix_timestamp("placed"),
        update_time=F.unix_timestamp("placed") + 86400,
        total_amount=F.col("o_totalprice"),
        actual_shipping_fee=(F.col("o_custkey") % 3).cast("double"),
        estimated_shipping_fee=F.lit(7.5),
        seller_discount=(key() % 3).cast("double"),
        voucher_seller=F.lit(2.5),
        currency=F.when(key() % 4 == 0, "USD").when(key() % 4 == 1, "THB"),
        recipient_address=F.struct(
            F.concat(F.lit("Buyer "), text("o_custkey")).alias("name"),
            F.when(key() % 2 == 0, F.concat(text("o_custkey"), F.lit(" Main St"))).otherwise("").alias("full_address"),
            F.lit("Bangkok").alias("city"),
        ),
        item_list=lines(
            lambda i: {
                "item_id": i["l_partkey"],
                "item_name": F.concat(F.lit("Item "), i["l_partkey"].cast("string")),
                "item_sku": F.concat(F.lit("SHO-"), i["l_partkey"].cast("string")),
                "model_quantity_purchased": i["l_quantity"].cast("long"),
                "model_discounted_price": F.when(i["l_linenumber"] != 1, F.floor(i["l_extendedprice"])),
                "item_price": F.floor(i["l_extendedprice"]) + 1,
            }
        ),
    )


def lazada_payload() -> Column:
    return json(
        order_id=key(),
        statuses=F.array(state("lazada")),
        buyer_id=F.col("o_custkey"),
        customer_first_name=F.concat(F.lit("C"), text("o_custkey")),
        created_at=iso(F.col("placed")),
        updated_at=iso(F.col("placed") + F.expr("interval 1 day")),
        price=F.when(key() % 5 == 0, 0.0).when(key() % 5 != 1, F.col("o_totalprice")),
        shipping_fee=(F.col("o_custkey") % 50).cast("double"),
        voucher_seller=F.lit(5.0),
        voucher_platform=F.when(key() % 2 == 0, 2.0),
        address_shipping=F.struct(F.lit("1 Second St").alias("address1"), F.lit("11000").alias("post_code")),
        order_items=lines(
            lambda i: {
                "order_item_id": F.concat_ws("-", i["l_linenumber"].cast("string"), i["l_partkey"].cast("string"), i["l_suppkey"].cast("string")),
                "sku_id": i["l_partkey"],
                "seller_sku": F.concat(F.lit("LAZ-"), i["l_partkey"].cast("string")),
                "name": F.concat(F.lit("Item "), i["l_partkey"].cast("string")),
                "quantity": i["l_quantity"].cast("long"),
                "paid_price": F.floor(i["l_extendedprice"]),
                "voucher_seller": F.lit(1.0),
            }
        ),
    )


def tiktok_payload() -> Column:
    return json(
        # Both generations of field names.
        order_id=F.when(key() % 2 == 0, text(key())),
        id=F.when(key() % 2 == 1, text(key())),
        order_status=F.when(key() % 2 == 0, state("tiktok_shop")),
        status=F.when(key() % 2 == 1, state("tiktok_shop")),
        buyer_uid=F.concat(F.lit("u"), text("o_custkey")),
        create_time=F.unix_timestamp("placed"),
        payment_info=F.struct(
            text(F.floor("o_totalprice")).alias("sub_total"),
            F.lit("0").alias("shipping_fee"),
            F.lit(40.0).alias("original_shipping_fee"),
            F.lit("10").alias("seller_discount"),
            (key() % 3).alias("platform_discount"),
            F.when(key() % 4 == 0, 0).otherwise(F.floor("o_totalprice") + 1).alias("total_amount"),
            F.lit("THB").alias("currency"),
        ),
        line_items=lines(
            lambda i: {
                "id": F.concat_ws("-", i["l_linenumber"].cast("string"), i["l_partkey"].cast("string"), i["l_suppkey"].cast("string")),
                "product_id": i["l_partkey"],
                "sku_id": F.concat(F.lit("TIK-"), i["l_partkey"].cast("string")),
                "product_name": F.concat(F.lit("Item "), i["l_partkey"].cast("string")),
                "quantity": i["l_quantity"].cast("long"),
                "sale_price": F.floor(i["l_extendedprice"]),
                "platform_discount": F.lit(2.0),
            }
        ),
    )


def order_lines(s: Staging, named: bool = True) -> DataFrame:
    """(platform, value): one record per order, every 13th cut off in the middle; `named=False` leaves platforms to be detected."""
    shop = F.pmod(F.col("o_custkey"), F.lit(3))
    payload = (
        F.when(shop == 0, shopee_payload()).when(shop == 1, lazada_payload()).otherwise(tiktok_payload())
    )
    name = code(F.col("o_custkey"), ("shopee", "lazada", "tiktok_shop"))
    wrapped = envelope(
        F.col("payload"),
        type=F.lit("order"),
        platform=name if named else F.lit(None).cast("string"),
        extracted_at=F.lit("2001-08-01T00:00:00Z"),
    )
    whole = s.spread(priced_orders(s), "o_orderkey", "orders", ORDERS).withColumn("payload", payload)
    whole = whole.select("o_orderkey", name.alias("platform"), wrapped.alias("value"))
    cut = F.when(key() % 13 == 0, F.expr("substring(value, 1, length(value) - 5)")).otherwise(F.col("value"))
    return whole.select("platform", cut.alias("value"))


def landed_orders(s: Staging, named: bool = True) -> DataFrame:
    """`order_lines` as landed records."""
    return from_text(order_lines(s, named).select("value"))


def landed_ads(s: Staging) -> DataFrame:
    """One report record per line item, in the shape of its platform."""
    sup, part = F.col("l_suppkey"), F.col("l_partkey")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    number = F.concat_ws("-", text("l_orderkey"), text("l_linenumber"), text(part), text(sup))
    shown, clicks = F.floor(F.col("l_quantity") * 100), F.floor(F.col("l_quantity") * F.col("l_tax") * 10)
    spend = F.floor("l_extendedprice")

    def action(kind: str, count: Column) -> Column:
        return F.struct(F.lit(kind).alias("action_type"), text(count).alias("value"))

    facebook = envelope(
        json(
            campaign_id=text(sup),
            adset_id=text(part % 4),
            ad_id=number,
            impressions=text(shown),
            clicks=text(clicks),
            reach=F.when(part % 2 == 0, text(F.floor(F.col("l_quantity") * 60))).otherwise(""),
            spend=text(F.col("l_quantity") + 0.25),
            date_start=day,
            actions=F.array(action("offsite.purchase", F.col("l_linenumber")), action("link_click", F.lit(99)), action("lead", F.lit(2))),
            cost_per_action_type=F.array(action("link_click", F.lit(1)), action("purchase", F.col("l_linenumber"))),
            objective=F.when(part % 3 == 0, "OUTCOME_SALES").when(part % 3 == 1, "NEW_KIND"),
        ),
        type=F.lit("insight"), platform=F.lit("facebook_ads"), ad_account_id=F.lit("act"), level=F.lit("ad"),
    )
    google = envelope(
        json(
            campaign=F.struct(text(sup).alias("id"), F.lit("ENABLED").alias("status"), F.lit("SEARCH").alias("advertisingChannelType")),
            adGroup=F.struct(text(part % 4).alias("id")),
            adGroupAd=F.struct(F.struct(number.alias("id")).alias("ad")),
            metrics=F.struct(
                text(shown).alias("impressions"),
                text(clicks).alias("clicks"),
                text(spend * 1_000_000).alias("costMicros"),
                F.concat(text("l_linenumber"), F.lit(".7")).alias("conversions"),
                text(spend * 2).alias("conversionsValue"),
            ),
            date=day,
        ),
        type=F.lit("ad"), customer_id=F.lit("cust"),
    )
    tiktok = envelope(
        json(
            dimensions=F.struct(
                text(sup).alias("campaign_id"), text(part % 4).alias("adgroup_id"), number.alias("ad_id"),
                F.when(part % 7 != 0, F.concat(day, F.lit(" 00:00:00"))).alias("stat_time_day"),
            ),
            metrics=F.struct(
                text(spend).alias("spend"), text(shown).alias("impressions"), text(clicks).alias("clicks"),
                text("l_linenumber").alias("conversion"), (part % 3).alias("likes"), F.lit("0").alias("shares"),
            ),
        ),
        type=F.lit("ad"), platform=F.lit("tiktok_ads"), advertiser_id=F.lit("adv"),
    )
    flat = envelope(
        json(
            campaign_id=F.when(part % 2 == 0, number),
            date=day,
            impressions=shown,
            clicks=clicks,
            cost=F.when(F.pmod(sup, F.lit(6)) != 5, spend),
            spend=F.when(F.pmod(sup, F.lit(6)) == 5, spend),
        ),
        type=F.lit("daily_report"),
        platform=code(sup, ("", "", "", "line_ads", "shopee_ads", "lazada_ads")),
        shop_id=number,
    )
    kind = F.pmod(sup, F.lit(6))
    value = F.when(kind == 0, facebook).when(kind == 1, google).when(kind == 2, tiktok).otherwise(flat)
    rows = s.spread(s.table("lineitem"), "l_orderkey", "lineitem", LINES)
    return from_text(rows.select(value.alias("value")))


def landed_web(s: Staging) -> DataFrame:
    """Report rows as name-to-text maps: traffic rows, page rows and undeclared session rows."""
    day = F.date_format("date", "yyyyMMdd")

    def record(kind, dimensions: dict[str, Column], metrics: dict[str, Column]) -> Column:
        pairs = lambda d: F.create_map(*[x for k, v in d.items() for x in (F.lit(k), v.cast("string"))])
        return envelope(
            json(dimensions=pairs(dimensions), metrics=pairs(metrics)),
            type=kind, platform=F.lit("ga4"), property_id=F.lit(PROPERTY), extracted_at=F.lit("2001-08-01T00:00:00Z"),
        )

    visit = {
        "sessions": F.col("sessions"),
        "totalUsers": F.col("total_users"),
        "newUsers": F.col("new_users"),
        "bounceRate": F.col("bounce_rate"),
        "averageSessionDuration": F.col("avg_session_duration"),
        "transactions": F.col("transactions"),
        "purchaseRevenue": F.col("revenue"),
        "engagedSessions": F.concat(text("engaged_sessions"), F.lit(".0")),
        "screenPageViews": F.lit("many"),
    }
    medium = F.when(F.col("medium") == "organic", "(not set)").otherwise(F.col("medium"))
    traffic = s.sessions.select(
        record(F.lit("ecommerce"), {"date": day, "sessionSource": F.col("source"), "sessionMedium": medium}, visit).alias("value")
    )
    sessions = s.sessions.select(
        record(F.lit("custom"), {"date": F.col("date"), "source": F.col("source"), "medium": medium}, visit).alias("value")
    )
    views = {
        "screenPageViews": F.col("page_views"),
        "sessions": F.col("sessions"),
        "entrances": F.col("entrances"),
        "exits": F.col("exits"),
        "averageSessionDuration": F.col("avg_time_on_page"),
    }
    dated = F.when(F.col("exits") % 4 == 0, F.lit("soon")).otherwise(day)
    pages = s.pages.select(
        record(F.lit("pages"), {"date": dated, "pagePath": F.col("page_path"), "pageTitle": F.col("page_title")}, views).alias("value")
    )
    return from_text(traffic.union(sessions).union(pages))


def landed_products(s: Staging, named: bool = True) -> DataFrame:
    """Product records of the three shops, each landed twice on different days; `named=False` leaves platforms to be detected."""
    shop = F.col("platform")
    number, price = F.col("platform_product_id"), F.col("unit_price") + F.col("copy")
    payload = (
        F.when(
            shop == "shopee",
            json(item_id=number, item_name=F.col("name"), item_sku=F.col("sku"), item_price=price + 50, model_discounted_price=price,
                 category_path=F.col("category"), brand=F.col("brand")),
        )
        .when(
            shop == "lazada",
            json(item_id=number, name=F.col("name"), seller_sku=F.col("sku"), item_price=price, category=F.col("category"), brand=F.col("brand")),
        )
        .otherwise(
            json(id=number, title=F.col("name"), sku_id=F.col("sku"), sku_sale_price=price, category_name=F.col("category"), brand_name=F.col("brand"))
        )
    )
    copies = s.products.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    value = envelope(
        payload,
        type=F.lit("product"),
        platform=shop if named else F.lit(None).cast("string"),
        extracted_at=F.when(F.col("copy") == 0, "2001-07-01T00:00:00Z").otherwise("2001-07-02T00:00:00Z"),
    )
    return from_text(copies.select(value.alias("value")))
