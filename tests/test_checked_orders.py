"""Orders are checked before they are mapped."""

from __future__ import annotations

import pytest

from bazaarspark.plans.order_payloads import mapped_orders, normalize_orders

ORDERS = [
    {"platform": "shopee", "data": {"order_sn": "1", "create_time": 1700000000, "item_list": [{"item_id": "1", "quantity": "2"}]}},
    {"platform": "shopee", "data": {"total_amount": "x", "item_list": [], "items": [{"model_discounted_price": "y"}]}},
    {"platform": "lazada", "data": {"order_id": 7, "statuses": [], "created_at": "2024-01-02"}},
    {"platform": "tiktok_shop", "data": {"id": "9", "create_time": "never", "payment_info": {"sub_total": "Infinity"}}},
]


@pytest.fixture
def long_plans(spark):
    name = "spark.sql.debug.maxToStringFields"
    before = spark.conf.get(name)
    spark.conf.set(name, "1000")
    yield lambda df: df._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(name, before)


def test_dead_orders_are_not_mapped(land, long_plans):
    parts = normalize_orders(land(*ORDERS))
    assert "shipping_method" in long_plans(parts.good)
    assert "shipping_method" not in long_plans(parts.dead)


def test_checked_and_mapped_orders_add_up(land):
    raw = land(*ORDERS)
    parts, every = normalize_orders(raw), mapped_orders(raw).collect()
    dead = sorted((r.record, r.error_type, r.error) for r in parts.dead.collect())
    assert len(every) == len(ORDERS)
    assert dead == sorted((r.record, r._problem.error_type, r._problem.error) for r in every if r._problem is not None)
    assert [(r.order_id, r.item_count) for r in parts.good.collect()] == [("shopee_1", 1)]


def test_problems_of_orders(land):
    orders = {r.source_platform: (r.error_type, r.error) for r in normalize_orders(land(*ORDERS)).dead.collect()}
    day, amount = "order_date is missing or unreadable", "an amount is not a number"
    assert orders == {
        "shopee": ("MappingError", f"Missing order_sn; {day}; {amount}; an item has an unreadable number"),
        "lazada": ("IndexError", "statuses is empty"),
        "tiktok_shop": ("ValidationError", f"{day}; {amount}"),
    }
