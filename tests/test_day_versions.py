"""Rebuilds of changed days: what is written, what stays, who reads what, and two writers."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from bazaarspark.plans.daily import orders_by_day
from bazaarspark.sources import day_versions as dv
from bazaarspark.sources import store

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


def builder(spark, values, seen=None):
    def build(days):
        if seen is not None:
            seen.append(list(days))
        rows = [(dt.date.fromisoformat(d), v) for d, vs in values.items() for v in vs if d in days]
        return spark.createDataFrame(rows, "date date, v int")

    return build


def content(spark, place, version=None):
    return sorted((str(r["date"]), r["v"]) for r in dv.read(spark, place, version).collect())


def test_only_changed_days_are_written(spark, tmp_path):
    place, seen = str(tmp_path), []
    values = {d: [i, i + 10] for i, d in enumerate(DAYS)}
    assert dv.rebuild(spark, place, "date", {d: "a" for d in DAYS}, builder(spark, values, seen), ["v"]) == DAYS
    before = dv.read(spark, place)
    values[DAYS[1]] = [7]
    inputs = {DAYS[0]: "a", DAYS[1]: "b", DAYS[2]: "a"}
    assert dv.rebuild(spark, place, "date", inputs, builder(spark, values, seen), ["v"]) == [DAYS[1]]
    assert seen == [DAYS, [DAYS[1]]]
    old, new = (dv.manifest(spark, place, n)["days"] for n in dv.versions(spark, place))
    assert [d for d in DAYS if old[d] != new[d]] == [DAYS[1]]
    assert content(spark, place) == [(DAYS[0], 0), (DAYS[0], 10), (DAYS[1], 7), (DAYS[2], 2), (DAYS[2], 12)]
    # A reader of the version before finishes on it.
    assert before.count() == 6 and len(content(spark, place, 1)) == 6
    assert dv.rebuild(spark, place, "date", inputs, builder(spark, values, seen)) == [] and len(seen) == 2


def test_days_that_go_and_days_without_rows(spark, tmp_path):
    place = str(tmp_path)
    values = {d: [1] for d in DAYS}
    dv.rebuild(spark, place, "date", {d: "a" for d in DAYS}, builder(spark, values))
    values[DAYS[0]] = []
    assert dv.rebuild(spark, place, "date", {DAYS[0]: "b", DAYS[1]: "a"}, builder(spark, values)) == [DAYS[0]]
    assert content(spark, place) == [(DAYS[1], 1)]


def test_the_second_of_two_writers_starts_from_the_first(spark, tmp_path):
    place = str(tmp_path)
    values = {d: [1] for d in DAYS}
    dv.rebuild(spark, place, "date", {d: "a" for d in DAYS}, builder(spark, values))
    calls = []

    def slow(days):
        calls.append(list(days))
        if len(calls) == 1:  # while this one builds, another writer brings day 0 up to date
            dv.rebuild(spark, place, "date", {DAYS[0]: "b", DAYS[1]: "a", DAYS[2]: "a"}, builder(spark, {**values, DAYS[0]: [5]}))
        return builder(spark, {**values, DAYS[0]: [5], DAYS[2]: [9]})(days)

    assert dv.rebuild(spark, place, "date", {DAYS[0]: "b", DAYS[1]: "a", DAYS[2]: "b"}, slow) == [DAYS[2]]
    assert calls == [[DAYS[0], DAYS[2]], [DAYS[2]]]
    assert content(spark, place) == [(DAYS[0], 5), (DAYS[1], 1), (DAYS[2], 9)]
    assert len(dv.clean(spark, place, keep=1)) >= 2 and content(spark, place) == [(DAYS[0], 5), (DAYS[1], 1), (DAYS[2], 9)]


def test_a_failed_build_changes_nothing(spark, tmp_path):
    place = str(tmp_path)
    dv.rebuild(spark, place, "date", {DAYS[0]: "a"}, builder(spark, {DAYS[0]: [1]}))

    def fails(_):
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        dv.rebuild(spark, place, "date", {DAYS[0]: "b"}, fails)
    assert content(spark, place) == [(DAYS[0], 1)]
    assert dv.rebuild(spark, place, "date", {DAYS[0]: "b"}, builder(spark, {DAYS[0]: [2]})) == [DAYS[0]]
    assert content(spark, place) == [(DAYS[0], 2)]
    with pytest.raises(ValueError):
        dv.read(spark, f"{place}/nothing")


def test_days_follow_the_loads_of_a_staging_table(spark, tmp_path):
    """Order measures by day, rebuilt after an upsert that touches one day."""
    table, mart = f"o_{uuid.uuid4().hex[:8]}", f"{tmp_path}/mart"
    schema = "order_id string, platform string, status string, order_date timestamp, total double, discount double, shipping_fee double, item_count long, customer_id string"

    def put(*rows):
        df = spark.createDataFrame([(i, "shopee", "completed", dt.datetime.fromisoformat(d), t, 0.0, 0.0, 1, "c") for i, d, t in rows], schema)
        store.upsert(spark, table, df, ["order_id"], "order_date", f"{tmp_path}/{table}")

    def bring_up():
        spark.catalog.refreshTable(table)
        orders = spark.table(table)
        build = lambda days: orders_by_day(orders.where(F.col(store.PARTITION).isin(*days)), dt.date(2024, 1, 5))
        return dv.rebuild(spark, mart, "date", dv.loads_by_day(orders, store.PARTITION), build, ["platform"])

    put(("a", "2024-01-01", 1.0), ("b", "2024-01-02", 2.0), ("c", "2024-01-03", 3.0))
    assert bring_up() == DAYS
    put(("b", "2024-01-02", 5.0))
    assert bring_up() == [DAYS[1]]
    put(("a", "2024-01-03", 1.0))  # it leaves its day
    assert bring_up() == [DAYS[2]]
    found = {str(r["date"]): r["gross_revenue"] for r in dv.read(spark, mart).collect()}
    assert found == {DAYS[1]: 5.0, DAYS[2]: 4.0}
