"""Order payloads, field by field: which key wins, what an amount means, and what becomes a dead letter."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from bazaarspark.plans.order_payloads import normalize_orders, order_items
from bazaarspark.sources.landing import from_text

MAY = 1_620_000_000  # 2021-05-03 00:00:00 UTC


def shopee(number, **more):
    return {"order_sn": number, "create_time": MAY, "total_amount": 840, "item_list": [], **more}


def lazada(number, **more):
    return {"order_id": number, "statuses": ["shipped"], "created_at": "2021-05-03 07:30:00", "order_items": [], **more}


def tiktok(number, **more):
    return {"order_id": number, "buyer_uid": "u-7", "create_time": str(MAY), "payment_info": {}, "item_list": [], **more}


CASES = {
    # Who bought, when and where to.
    "shopee_who": shopee(
        "who", buyer_user_id=4711, buyer_username="mali", order_status="COMPLETED", update_time=MAY + 90_000,
        pay_time=MAY + 60, shipping_carrier="bike", tracking_no="trk-9",
        recipient_address={"name": "Mali W.", "phone": "02-555", "full_address": "Soi 8", "city": "Korat", "zipcode": "30000"},
    ),
    "shopee_unnamed": shopee("unnamed", buyer_username="", recipient_address={"name": "Somchai"}, order_status="TO_RETURN"),
    "lazada_named": lazada(
        "named", customer_first_name="Arun", customer_last_name="Dee",
        address_shipping={"phone": "076-1", "address1": "Pier 3", "city": "Phuket", "post_code": "83000"},
    ),
    "lazada_written": lazada("written", address_shipping="Pier 3, Phuket", statuses=["delivered"]),
    "tiktok_named": tiktok("named", order_status="DELIVERED", recipient_address={"full_name": "Nok", "phone_number": "9"}),
    # Amounts: the first that counts. A number 0 falls through, a text "0" is an amount.
    "shopee_fees": shopee("fees", total_amount=0, actual_shipping_fee=0, estimated_shipping_fee=31.25),
    "shopee_voucher": shopee("voucher", seller_discount=0, voucher_seller=17),
    "shopee_both": shopee("both", seller_discount=23, voucher_seller=17),
    "lazada_sum": lazada(
        "sum", shipping_fee=45, voucher_seller=11, voucher_platform=6,
        order_items=[{"order_item_id": "x", "item_price": 130, "quantity": 3}, {"order_item_id": "y", "item_price": 75}],
    ),
    "lazada_nothing": lazada("nothing", price=0, order_items=[{"order_item_id": "z", "item_price": 90}]),
    "tiktok_text": tiktok(
        "text", payment_info={"sub_total": "410", "shipping_fee": "0", "original_shipping_fee": 35, "seller_discount": "12"}
    ),
    # Currencies: the whole rate table, half-up to two decimals.
    "shopee_dollar": shopee("dollar", currency="USD", total_amount="12.345"),
    "shopee_euro": shopee("euro", currency="EUR", total_amount=10),
    # Other names of the same things.
    "shopee_old": {**shopee("x", ordersn="old", items=[{"item_id": 3, "item_sku": "A3", "item_price": 8}]), "order_sn": None},
    "lazada_number": {k: v for k, v in lazada("x", order_number="number").items() if k != "order_id"},
    "tiktok_alias": {k: v for k, v in tiktok("x", id="alias", status="IN_TRANSIT").items() if k != "order_id"},
    # Epochs of any length are instants: the first day of 1970.
    "shopee_early": shopee("early", create_time=86_399),
}
BAD = {
    ("shopee", "MappingError", "Missing order_sn"): [{"platform": "shopee", "data": {"create_time": MAY}}],
    ("lazada", "IndexError", "statuses is empty"): [lazada("bare", statuses=[])],
    ("unknown", "UnknownPlatform", "platform is unknown"): [{"colour": "blue"}],
    ("unknown", "JSONDecodeError", "record is not a JSON object"): ["{]", "17"],
    ("shopee", "ValidationError", "order_date is missing or unreadable"): [
        shopee("undated", create_time=None),
        shopee("milli", create_time=MAY * 1000),
        shopee("micro", create_time=str(MAY * 1_000_000)),
    ],
    ("shopee", "ValidationError", "an amount is not a number"): [
        shopee("words", total_amount="a lot"),
        shopee("vast", total_amount="1e30"),
        shopee("endless", total_amount="Infinity"),
        shopee("nan", total_amount="NaN"),
        shopee("fee", actual_shipping_fee=-1e25),
    ],
}


@pytest.fixture(scope="module")
def parts(spark):
    records = [*CASES.values(), *(r for rs in BAD.values() for r in rs)]
    lines = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    found = normalize_orders(from_text(spark.createDataFrame(lines, "value string")), dt.datetime(2021, 6, 1))
    return {r.order_id: r for r in found.good.collect()}, order_items(found.good).collect(), found.dead.collect()


def test_every_record_is_accounted_for(parts):
    good, _, dead = parts
    assert set(good) == set(CASES)
    wanted = sorted((*key, len(rs)) for key, rs in BAD.items())
    kinds = [(d.source_platform, d.error_type, d.error) for d in dead]
    assert sorted((*k, kinds.count(k)) for k in set(kinds)) == wanted
    assert all(d.timestamp == dt.datetime(2021, 6, 1) and d.record for d in dead)


def test_people_and_places(parts):
    who = parts[0]["shopee_who"]
    assert (who.customer_id, who.customer_name, who.customer_phone) == ("4711", "mali", "02-555")
    assert (who.shipping_address, who.shipping_method, who.tracking_number) == ("Soi 8, Korat, 30000", "bike", "trk-9")
    assert parts[0]["shopee_unnamed"].customer_name == "Somchai"
    arun = parts[0]["lazada_named"]
    assert (arun.customer_name, arun.customer_phone, arun.shipping_address) == ("Arun Dee", "076-1", "Pier 3, Phuket, 83000")
    assert parts[0]["lazada_written"].shipping_address == "Pier 3, Phuket"
    assert (parts[0]["tiktok_named"].customer_name, parts[0]["tiktok_named"].customer_phone) == ("Nok", "9")


def test_dates(parts):
    start = dt.datetime(2021, 5, 3)
    who = parts[0]["shopee_who"]
    assert (who.order_date, who.paid_date, who.completed_date) == (start, start.replace(minute=1), dt.datetime(2021, 5, 4, 1))
    assert parts[0]["shopee_unnamed"].completed_date is None
    assert parts[0]["lazada_named"].order_date == dt.datetime(2021, 5, 3, 7, 30)
    assert parts[0]["tiktok_text"].order_date == start
    assert parts[0]["shopee_early"].order_date == dt.datetime(1970, 1, 1, 23, 59, 59)


@pytest.mark.parametrize(
    ("order", "status"),
    [
        ("shopee_who", "completed"), ("shopee_unnamed", "return_pending"), ("shopee_fees", "unknown"),
        ("lazada_written", "completed"), ("lazada_named", "shipped"), ("tiktok_named", "completed"), ("tiktok_alias", "shipped"),
    ],
)
def test_status(parts, order, status):
    assert parts[0][order].status == status


@pytest.mark.parametrize(
    ("order", "subtotal", "fee", "discount", "total"),
    [
        ("shopee_fees", 0.0, 31.25, 0.0, 0.0),
        ("shopee_voucher", 840.0, 0.0, 17.0, 840.0),
        ("shopee_both", 840.0, 0.0, 23.0, 840.0),
        ("lazada_sum", 465.0, 45.0, 17.0, 493.0),
        ("lazada_nothing", 90.0, 0.0, 0.0, 0.0),
        ("tiktok_text", 410.0, 0.0, 12.0, 398.0),
        ("shopee_dollar", 432.08, 0.0, 0.0, 432.08),
        ("shopee_euro", 380.0, 0.0, 0.0, 380.0),
    ],
)
def test_amounts(parts, order, subtotal, fee, discount, total):
    o = parts[0][order]
    assert (o.subtotal, o.shipping_fee, o.discount, o.total, o.currency) == (subtotal, fee, discount, total, "THB")


def test_items(parts):
    by = {(i.order_id, i.item_id): i for i in parts[1]}
    assert len(by) == 4
    x, y = by["lazada_sum", "x"], by["lazada_sum", "y"]
    assert (x.quantity, x.unit_price, x.total_price) == (3, 130.0, 390.0) and (y.quantity, y.total_price) == (1, 75.0)
    old = by["shopee_old", "3"]
    assert (old.sku, old.quantity, old.total_price) == ("A3", 1, 8.0)


def test_both_discounts_on_request(land):
    found = normalize_orders(land(CASES["shopee_both"]), fix_discount=True).good.collect()[0]
    assert found.discount == 40.0


def test_only_dollars_on_request(land):
    found = normalize_orders(land(CASES["shopee_euro"], CASES["shopee_dollar"]), compatible_currency=True).good.collect()
    assert {(r.order_id, r.total, r.currency) for r in found} == {("shopee_euro", 10.0, "EUR"), ("shopee_dollar", 432.08, "USD")}


def test_envelopes(land):
    twice = {"platform": "tiktok_shop", "data": {"type": "order", "platform": "tiktok_shop", "data": tiktok("twice")}}
    once = {"type": "order", "platform": "lazada", "data": lazada("once"), "extracted_at": "2021-05-20T10:00:00+07:00"}
    found = {r.order_id: r for r in normalize_orders(land(twice, once)).good.collect()}
    assert set(found) == {"tiktok_twice", "lazada_once"}
    assert found["lazada_once"].extracted_at == dt.datetime(2021, 5, 20, 3)
