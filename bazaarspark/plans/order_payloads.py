"""Landed shop orders to staging orders and order items, in one pass over the landed records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarspark.functions import fixed_values as fixed
from bazaarspark.functions.dates import parse_instant
from bazaarspark.functions.money import to_home, to_home_usd_only
from bazaarspark.functions.payload import Sql, counts, first_number, tokens, unreadable
from bazaarspark.functions.scalars import col, first_text, join_parts, map_text
from bazaarspark.operators.once import computed_once
from bazaarspark.operators.quality import Split, problem, split

SHOPEE_ITEM = (
    "item_id: string, item_name: string, model_sku: string, item_sku: string, model_name: string,"
    " model_quantity_purchased: variant, quantity: variant, model_discounted_price: variant, item_price: variant,"
    " weight: variant"
)
SHOPEE = (
    "order_sn string, ordersn string, order_status string, buyer_user_id string, buyer_username string,"
    " create_time string, pay_time string, ship_by_date string, update_time string, total_amount variant,"
    " actual_shipping_fee variant, estimated_shipping_fee variant, seller_discount variant, voucher_seller variant,"
    " currency string, shipping_carrier string, tracking_no string, extracted_at string,"
    " recipient_address struct<name: string, phone: string, full_address: string, district: string, city: string,"
    " state: string, zipcode: string>,"
    f" item_list array<struct<{SHOPEE_ITEM}>>, items array<struct<{SHOPEE_ITEM}>>"
)
LAZADA_ITEM = (
    "order_item_id: string, product_id: string, sku_id: string, sku: string, seller_sku: string, name: string,"
    " quantity: variant, item_price: variant, paid_price: variant, voucher_seller: variant,"
    " voucher_platform: variant, variation: string, weight: variant"
)
LAZADA = (
    "order_id string, order_number string, statuses string, status string, customer_id string, buyer_id string,"
    " customer_first_name string, customer_last_name string, created_at string, payment_method_paid_date string,"
    " shipped_at string, updated_at string, price variant, shipping_fee variant, voucher_seller variant,"
    " voucher_platform variant, currency string, shipping_provider string, tracking_code string, extracted_at string,"
    f" address_shipping string, order_items array<struct<{LAZADA_ITEM}>>, items array<struct<{LAZADA_ITEM}>>"
)
LAZADA_ADDRESS = (
    "phone string, address1 string, address2 string, address3 string, city string, ward string, region string,"
    " post_code string"
)
TIKTOK_ITEM = (
    "id: string, product_id: string, seller_sku: string, sku_id: string, product_name: string, quantity: variant,"
    " sale_price: variant, sku_sale_price: variant, platform_discount: variant, seller_discount: variant,"
    " sku_name: string, weight: variant"
)
TIKTOK = (
    "order_id string, id string, order_status string, status string, buyer_uid string, create_time string,"
    " paid_time string, shipping_due_time string, complete_time string, payment_method_amount variant,"
    " payment_info struct<sub_total: variant, original_total_product_price: variant, shipping_fee: variant,"
    " original_shipping_fee: variant, seller_discount: variant, platform_discount: variant, total_amount: variant,"
    " currency: string>,"
    " shipping_provider string, tracking_number string, extracted_at string,"
    " recipient_address struct<full_name: string, name: string, phone_number: string, phone: string,"
    " address_detail: string, full_address: string, district: string, city: string, state: string, region: string,"
    " zipcode: string, postal_code: string>,"
    f" item_list array<struct<{TIKTOK_ITEM}>>, line_items array<struct<{TIKTOK_ITEM}>>"
)

ORDER_FIELDS = (
    *("order_id", "platform", "platform_order_id", "customer_id", "customer_name", "customer_phone"),
    *("status", "status_raw", "order_date", "paid_date", "shipped_date", "completed_date"),
    *("subtotal", "shipping_fee", "discount", "total", "currency", "currency_raw"),
    *("shipping_address", "shipping_method", "tracking_number", "items", "item_count", "extracted_at"),
)


def has_key(payload, name: str) -> Column:
    return F.array_contains(F.json_object_keys(payload), name)


def order_platform(platform, payload, lenient: bool = False) -> Column:
    """Named platform, else by the keys of the payload, else 'unknown'.

    `lenient` is the rule of the raw index: order lines alone are enough for Lazada.
    """
    keys = F.json_object_keys(payload)

    def has(name: str) -> Column:
        return F.array_contains(keys, name)

    lines = has("order_items") if lenient else has("order_items") & has("order_id")
    return F.coalesce(
        F.nullif(F.nullif(F.col(platform), F.lit("")), F.lit("unknown")) if lenient else F.nullif(F.col(platform), F.lit("")),
        F.when(has("order_sn") | has("ordersn"), "shopee")
        .when(has("statuses") | lines, "lazada")
        .when(has("buyer_uid") | has("payment_info"), "tiktok_shop"),
        F.lit("unknown"),
    )


# Lists of items, of which the first that is not empty counts, their schema, and the numbers items need to have.
LISTS = {
    "_shopee": (("item_list", "items"), SHOPEE_ITEM, ("model_quantity_purchased", "model_discounted_price")),
    "_lazada": (
        *(("order_items", "items"), LAZADA_ITEM),
        ("quantity", "item_price", "voucher_seller", "voucher_platform"),
    ),
    "_tiktok": (
        *(("item_list", "line_items"), TIKTOK_ITEM),
        ("quantity", "sale_price", "platform_discount", "seller_discount"),
    ),
}


def _list(shape: str) -> str:
    arrays, schema, _ = LISTS[shape]
    empty = f"from_json('[]', 'array<struct<{schema.replace('variant', 'string')}>>')"
    return f"coalesce({', '.join(f'case when size({shape}.{a}) > 0 then {shape}.{a} end' for a in arrays)}, {empty})"


def _unreadable_item(shape: str) -> Column:
    wrong = Sql.unreadable(*[f"i.{c}" for c in LISTS[shape][2]])
    return F.expr(f"exists({_list(shape)}, i -> {wrong})")


def _items(platform: str, shape: str, **fields: str) -> Column:
    """Unified items out of the first non-empty list; `fields` are SQL texts over a list element `i`."""
    cells = {
        "item_id": f"coalesce({fields['item_id']}, '')",
        "product_id": f"coalesce({fields['product_id']}, '')",
        "sku": fields["sku"],
        "name": f"coalesce({fields['name']}, '')",
        "quantity": fields["quantity"],
        "unit_price": fields["unit_price"],
        "total_price": f"{fields['unit_price']} * {fields['quantity']}",
        "discount": fields["discount"],
        "platform": f"'{platform}'",
        "variation": fields["variation"],
        "weight": Sql.number("i.weight"),
    }
    return F.expr(f"transform({_list(shape)}, i -> named_struct({', '.join(f"'{n}', {c}" for n, c in cells.items())}))")


def _shopee_items() -> Column:
    return _items(
        "shopee",
        "_shopee",
        item_id="i.item_id",
        product_id="i.item_id",
        sku=Sql.first_text("i.model_sku", "i.item_sku"),
        name="i.item_name",
        quantity=Sql.first_whole("i.model_quantity_purchased", "i.quantity", default="1L"),
        unit_price=Sql.first_number("i.model_discounted_price", "i.item_price"),
        discount="0D",
        variation="i.model_name",
    )


def _lazada_items() -> Column:
    return _items(
        "lazada",
        "_lazada",
        item_id="i.order_item_id",
        product_id=Sql.first_text("i.product_id", "i.sku_id"),
        sku=Sql.first_text("i.sku", "i.seller_sku"),
        name="i.name",
        quantity=Sql.first_whole("i.quantity", default="1L"),
        unit_price=Sql.first_number("i.item_price", "i.paid_price"),
        discount=f"{Sql.first_number('i.voucher_seller')} + {Sql.first_number('i.voucher_platform')}",
        variation="i.variation",
    )


def _tiktok_items() -> Column:
    return _items(
        "tiktok_shop",
        "_tiktok",
        item_id="i.id",
        product_id="i.product_id",
        sku=Sql.first_text("i.seller_sku", "i.sku_id"),
        name="i.product_name",
        quantity=Sql.first_whole("i.quantity", default="1L"),
        unit_price=Sql.first_number("i.sale_price", "i.sku_sale_price"),
        discount=f"{Sql.first_number('i.platform_discount')} + {Sql.first_number('i.seller_discount')}",
        variation="i.sku_name",
    )


def _order(**values: Column) -> Column:
    values["item_count"] = F.size(values["items"]).cast("long")
    fields = [c for c in ORDER_FIELDS if c not in ("currency", "status")]
    return F.struct(*[col(values[c]).alias(c) for c in fields])


NUMBERS = {
    "shopee": ("_shopee.order_sn", "_shopee.ordersn"),
    "lazada": ("_lazada.order_id", "_lazada.order_number"),
    "tiktok_shop": ("_tiktok.order_id", "_tiktok.id"),
}
# Amounts that have to be numbers, by shape.
AMOUNTS = {
    "_shopee": ("total_amount", "actual_shipping_fee", "seller_discount", "voucher_seller"),
    "_lazada": ("price", "shipping_fee", "voucher_seller", "voucher_platform"),
    "_tiktok.payment_info": ("sub_total", "shipping_fee", "seller_discount", "platform_discount", "total_amount"),
}


def _order_number(shop: str) -> Column:
    return first_text(*NUMBERS[shop])


def _by_shop(shopee, lazada, tiktok) -> Column:
    shop = F.col("_shop")
    return F.when(shop == "shopee", shopee).when(shop == "lazada", lazada).when(shop == "tiktok_shop", tiktok)


def _problem() -> Column:
    shop = F.col("_shop")
    number = _by_shop(*[_order_number(s) for s in fixed.SHOP_PLATFORMS])
    is_list = F.col("_lazada.statuses").startswith("[")
    no_state = F.coalesce(is_list, F.lit(False)) & F.get("_states", F.lit(0)).isNull()
    whole = problem(
        (F.col("malformed"), "JSONDecodeError", "record is not a JSON object"),
        (~F.col("malformed") & ~shop.isin(*fixed.SHOP_PLATFORMS), "UnknownPlatform", "platform is unknown"),
    )
    order = problem(
        (number.isNull() & (shop == "shopee"), "MappingError", "Missing order_sn"),
        (number.isNull() & (shop != "shopee"), "MappingError", "Missing order_id"),
        ((shop == "lazada") & no_state, "IndexError", "statuses is empty"),
        (F.col("_ordered").isNull(), "ValidationError", "order_date is missing or unreadable"),
        (F.col("_wrong_amount"), "ValidationError", "an amount is not a number"),
        (F.col("_wrong_item"), "ValidationError", "an item has an unreadable number"),
    )
    return F.coalesce(whole, order)


def _shopee(fix_discount: bool) -> Column:
    p = lambda name: f"_shopee.{name}"
    address = lambda name: p(f"recipient_address.{name}")
    order_number = _order_number("shopee")
    voucher = first_number(p("voucher_seller"))
    seller = first_number(p("seller_discount"))
    # Published rule: the voucher only counts when the seller gave no discount of its own.
    discount = seller + voucher if fix_discount else F.when(counts(p("seller_discount")), seller).otherwise(voucher)
    return _order(
        order_id=F.concat(F.lit("shopee_"), order_number),
        platform=F.lit("shopee"),
        platform_order_id=order_number,
        customer_id=F.coalesce(p("buyer_user_id"), F.lit("")),
        customer_name=first_text(p("buyer_username"), address("name")),
        customer_phone=address("phone"),
        status_raw=F.coalesce(p("order_status"), F.lit("")),
        order_date=F.col("_ordered"),
        paid_date=parse_instant(p("pay_time")),
        shipped_date=parse_instant(p("ship_by_date")),
        completed_date=F.when(F.col(p("order_status")) == "COMPLETED", parse_instant(p("update_time"))),
        subtotal=first_number(p("total_amount"), p("actual_shipping_fee")),
        shipping_fee=first_number(p("actual_shipping_fee"), p("estimated_shipping_fee")),
        discount=discount,
        total=first_number(p("total_amount")),
        currency_raw=p("currency"),
        shipping_address=join_parts(*[address(c) for c in ("full_address", "district", "city", "state", "zipcode")]),
        shipping_method=p("shipping_carrier"),
        tracking_number=p("tracking_no"),
        items=F.col("_shopee_items"),
        extracted_at=p("extracted_at"),
    )


def _lazada() -> Column:
    p = lambda name: f"_lazada.{name}"
    order_number = _order_number("lazada")
    is_list = F.col(p("statuses")).startswith("[")
    first_state = F.get("_states", F.lit(0))
    of_items = F.aggregate("_lazada_items", F.lit(0.0), lambda total, i: total + i["total_price"])
    price = p("price")
    subtotal = F.when(counts(price), first_number(price)).otherwise(of_items)
    shipping = first_number(p("shipping_fee"))
    discount = first_number(p("voucher_seller")) + first_number(p("voucher_platform"))
    address = F.col("_address")
    is_address = F.col(p("address_shipping")).startswith("{")
    parts = ("address1", "address2", "address3", "city", "ward", "region", "post_code")
    name = F.trim(F.concat_ws(" ", p("customer_first_name"), p("customer_last_name")))
    return _order(
        order_id=F.concat(F.lit("lazada_"), order_number),
        platform=F.lit("lazada"),
        platform_order_id=order_number,
        customer_id=F.coalesce(first_text(p("customer_id"), p("buyer_id")), F.lit("")),
        customer_name=F.nullif(name, F.lit("")),
        customer_phone=F.when(is_address, address["phone"]),
        status_raw=F.coalesce(F.when(is_list, first_state).otherwise(F.col(p("status"))), F.lit("")),
        order_date=F.col("_ordered"),
        paid_date=parse_instant(p("payment_method_paid_date")),
        shipped_date=parse_instant(p("shipped_at")),
        completed_date=F.when(F.lower(p("statuses")).contains("delivered"), parse_instant(p("updated_at"))),
        subtotal=subtotal,
        shipping_fee=shipping,
        discount=discount,
        total=F.when(F.col(price).isNotNull(), first_number(price)).otherwise(subtotal - discount + shipping),
        currency_raw=p("currency"),
        shipping_address=F.when(is_address, join_parts(*[address[c] for c in parts])).otherwise(
            F.nullif(p("address_shipping"), F.lit(""))
        ),
        shipping_method=p("shipping_provider"),
        tracking_number=p("tracking_code"),
        items=F.col("_lazada_items"),
        extracted_at=p("extracted_at"),
    )


def _tiktok() -> Column:
    p = lambda name: f"_tiktok.{name}"
    paid = lambda name: p(f"payment_info.{name}")
    address = lambda name: p(f"recipient_address.{name}")
    # Two generations of the order payload name the id and the state differently.
    order_number = _order_number("tiktok_shop")
    state = first_text(p("order_status"), p("status"))
    subtotal = first_number(paid("sub_total"), paid("original_total_product_price"))
    shipping = first_number(paid("shipping_fee"), paid("original_shipping_fee"))
    discount = first_number(paid("seller_discount")) + first_number(paid("platform_discount"))
    total = first_number(paid("total_amount"), p("payment_method_amount"))
    return _order(
        order_id=F.concat(F.lit("tiktok_"), order_number),
        platform=F.lit("tiktok_shop"),
        platform_order_id=order_number,
        customer_id=F.coalesce(p("buyer_uid"), F.lit("")),
        customer_name=first_text(address("full_name"), address("name")),
        customer_phone=first_text(address("phone_number"), address("phone")),
        status_raw=F.coalesce(state, F.lit("")),
        order_date=F.col("_ordered"),
        paid_date=parse_instant(p("paid_time")),
        shipped_date=parse_instant(p("shipping_due_time")),
        completed_date=parse_instant(p("complete_time")),
        subtotal=subtotal,
        shipping_fee=shipping,
        discount=discount,
        total=F.when(total != 0, total).otherwise(subtotal + shipping - discount),
        currency_raw=paid("currency"),
        shipping_address=join_parts(
            first_text(address("address_detail"), address("full_address")),
            *[address(c) for c in ("district", "city", "state", "region")],
            first_text(address("zipcode"), address("postal_code")),
        ),
        shipping_method=p("shipping_provider"),
        tracking_number=p("tracking_number"),
        items=F.col("_tiktok_items"),
        extracted_at=p("extracted_at"),
    )


def normalize_orders(
    raw: DataFrame,
    run_at: dt.datetime | Column | None = None,
    fix_discount: bool = False,
    compatible_currency: bool = False,
) -> Split:
    """Staging orders, with their items as an array, and dead letters.

    `raw` comes from `sources.landing`. Each record is parsed with the schema of its own platform only
    and mapped by a conditional expression, so the landed data is read once for all platforms.
    `fix_discount` adds the seller voucher to the seller discount. `compatible_currency` converts only
    USD and leaves the currency code, instead of using the whole rate table.
    """
    checked = checked_orders(raw)
    good = _orders(checked.where(F.col("_problem").isNull()), fix_discount, compatible_currency)
    return Split(orders_split(good, run_at).good, split(checked, "_problem", "record", "_shop", _moment(run_at)).dead)


def _moment(run_at: dt.datetime | Column | None) -> Column:
    return F.current_timestamp() if run_at is None else (run_at if isinstance(run_at, Column) else F.lit(run_at))


def orders_split(mapped: DataFrame, run_at: dt.datetime | Column | None = None) -> Split:
    """Good orders and dead letters of `mapped_orders`."""
    at = _moment(run_at)
    parts = split(mapped, "_problem", "record", "_shop", at)
    return Split(parts.good.drop("_shop").withColumn("transformed_at", at), parts.dead)


def mapped_orders(
    raw: DataFrame, fix_discount: bool = False, compatible_currency: bool = False, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Every record with its order's fields, `_shop`, `_problem` (NULL if there is none) and the columns to `carry`."""
    return _orders(checked_orders(raw, carry), fix_discount, compatible_currency, carry)


def checked_orders(raw: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Every record parsed, with `_shop`, `_ordered`, `_states` and `_problem` (NULL if there is none)."""
    shop = F.col("_shop")
    kept = ["record", "malformed", "extracted_at", "_shop", *carry]
    schemas = {"_shopee": SHOPEE, "_lazada": LAZADA, "_tiktok": TIKTOK}
    parsed = computed_once(
        computed_once(raw, {"_shop": order_platform("platform", F.col("payload"))}),
        {
            "_shopee": F.when(shop == "shopee", F.from_json("payload", SHOPEE)),
            "_lazada": F.when(shop == "lazada", F.from_json("payload", LAZADA)),
            "_tiktok": F.when(shop == "tiktok_shop", F.from_json("payload", TIKTOK)),
        },
        keep=kept,
    )
    on = (
        "case _shop when 'shopee' then _shopee.create_time when 'lazada' then _lazada.created_at"
        " when 'tiktok_shop' then _tiktok.create_time end"
    )
    parsed = computed_once(
        parsed,
        {
            **{c: tokens(c, schema) for c, schema in schemas.items()},
            "_ordered": parse_instant(on),
            "_states": F.from_json("_lazada.statuses", "array<string>"),
        },
        keep=kept,
    )
    kept += [*schemas, "_ordered", "_states"]
    wrong = {
        "_wrong_amount": _by_shop(*[unreadable(*[f"{at}.{c}" for c in names]) for at, names in AMOUNTS.items()]),
        "_wrong_item": _by_shop(*[_unreadable_item(shape) for shape in LISTS]),
    }
    return computed_once(computed_once(parsed, wrong, kept), {"_problem": _problem()}, kept)


def _orders(
    checked: DataFrame, fix_discount: bool, compatible_currency: bool, carry: tuple[str, ...] = ()
) -> DataFrame:
    shop = F.col("_shop")
    parsed = computed_once(
        checked,
        {
            "_address": F.from_json("_lazada.address_shipping", LAZADA_ADDRESS),
            "_shopee_items": _shopee_items(),
            "_lazada_items": _lazada_items(),
            "_tiktok_items": _tiktok_items(),
        },
    )
    order = _by_shop(_shopee(fix_discount), _lazada(), _tiktok())
    mapped = computed_once(parsed, {"_o": order}, keep=["record", "extracted_at", "_shop", "_problem", *carry])
    raw_currency = F.coalesce(F.nullif("_o.currency_raw", F.lit("")), F.lit(fixed.HOME_CURRENCY))
    money = to_home_usd_only if compatible_currency else to_home
    status = F.lit("unknown")
    for name, codes in fixed.ORDER_STATUS.items():
        status = F.when(shop == name, map_text("_o.status_raw", codes, "unknown")).otherwise(status)
    derived = {
        "status": status,
        "currency": raw_currency if compatible_currency else F.lit(fixed.HOME_CURRENCY),
        "currency_raw": raw_currency,
        "extracted_at": parse_instant("coalesce(_o.extracted_at, extracted_at)"),
        **{c: money(f"_o.{c}", raw_currency) for c in ("subtotal", "shipping_fee", "discount", "total")},
    }
    return mapped.select(
        "record",
        *carry,
        shop.alias("_shop"),
        *[derived.get(c, F.col(f"_o.{c}")).alias(c) for c in ORDER_FIELDS],
        "_problem",
    )


def order_items(orders: DataFrame) -> DataFrame:
    """One row per item of staging orders; orders without items give none."""
    return orders.select(
        "order_id", F.col("platform"), "order_date", F.explode("items").alias("_i"), "transformed_at"
    ).select(
        "_i.item_id",
        "order_id",
        "platform",
        *[f"_i.{c}" for c in ("product_id", "sku", "name", "variation", "quantity", "unit_price", "total_price")],
        *["_i.discount", "_i.weight", "order_date", "transformed_at"],
    )
