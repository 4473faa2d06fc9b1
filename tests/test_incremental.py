"""Aggregates of streams: late rows, retried batches, folded parts, restarts."""

from __future__ import annotations

import datetime as dt

import pytest

from bazaarspark.streaming import incremental as inc

SCHEMA = "user string, ts timestamp, value double"
START = dt.datetime(2024, 1, 1)


def events(spark, *rows):
    return spark.createDataFrame([(u, START + dt.timedelta(minutes=m), float(v)) for u, m, v in rows], SCHEMA)


SUMS = inc.grouped(
    {"user": "user", "day": "to_date(ts)"},
    {"rows": inc.rows_where(), "big": inc.rows_where("value > 5"), "value": inc.total("value"), "low": inc.least("value"), "last": inc.newest("ts", "value")},
)


def found(spark, place):
    return sorted(
        (r.user, r.day.isoformat(), r.rows, r.big, r.value, r.low, r["last"].value) for r in inc.state(spark, place, SUMS).collect()
    )


def test_late_rows_and_retried_batches(spark, tmp_path):
    place = str(tmp_path)
    inc.add(events(spark, ("a", 0, 1), ("a", 5000, 9)), 0, place, SUMS)
    for _ in range(2):  # the second one is a retry
        inc.add(events(spark, ("a", 1, 7), ("b", 2, 2)), 1, place, SUMS)
    assert found(spark, place) == [("a", "2024-01-01", 2, 1, 8.0, 1.0, 7.0), ("a", "2024-01-04", 1, 1, 9.0, 9.0, 9.0), ("b", "2024-01-01", 1, 0, 2.0, 2.0, 2.0)]


@pytest.mark.parametrize("fold", [1, 2, 100])
def test_folding_changes_nothing(spark, tmp_path, fold):
    place = str(tmp_path)
    for n in range(7):
        inc.add(events(spark, ("a", n, n), ("b", 2000 - n, 1)), n, place, SUMS, fold)
        if n == 4:  # batches that the base or a part holds already
            for again in (0, 3, 4):
                inc.add(events(spark, ("a", again, again), ("b", 2000 - again, 1)), again, place, SUMS, fold)
    assert found(spark, place) == [("a", "2024-01-01", 7, 1, 21.0, 0.0, 6.0), ("b", "2024-01-02", 7, 0, 7.0, 1.0, 1.0)]
    kept = list((tmp_path / "parts").glob("batch-*"))
    assert len(kept) <= 2 * fold + 2


def test_a_reader_of_an_older_state_can_finish(spark, tmp_path):
    place = str(tmp_path)
    for n in range(3):
        inc.add(events(spark, ("a", n, 1)), n, place, SUMS)
    before = inc.state(spark, place, SUMS)
    inc.folded(spark, place, SUMS)
    assert before.collect()[0]["rows"] == 3 and found(spark, place)[0][2] == 3


def test_sessions_join_over_batches(spark, tmp_path):
    place, gap = str(tmp_path), inc.sessions("user", "ts", "30 minutes", "value")

    def spans():
        rows = inc.state(spark, place, gap).collect()
        minutes = lambda t: int((t - START).total_seconds() // 60)
        return sorted((r.user, minutes(r["first"]), minutes(r["last"]), r.events, r.value) for r in rows)

    inc.add(events(spark, ("a", 0, 1), ("a", 0, 1), ("a", 10, 1), ("a", 60, 1), ("b", 5, 1)), 0, place, gap)
    assert spans() == [("a", 0, 10, 3, 3.0), ("a", 60, 60, 1, 1.0), ("b", 5, 5, 1, 1.0)]
    # Late: it joins the two sessions. An event exactly the gap away begins a new one. Midnight parts nothing.
    inc.add(events(spark, ("a", 35, 1), ("b", 35, 2), ("c", 1435, 1), ("c", 1445, 1)), 1, place, gap)
    assert spans() == [("a", 0, 60, 5, 5.0), ("b", 5, 5, 1, 1.0), ("b", 35, 35, 1, 2.0), ("c", 1435, 1445, 2, 2.0)]
    inc.folded(spark, place, gap)
    inc.add(events(spark, ("b", 20, 1)), 2, place, gap)
    assert ("b", 5, 35, 3, 4.0) in spans()


def test_stream_goes_on_where_it_stopped(spark, tmp_path):
    place, source = str(tmp_path / "state"), str(tmp_path / "in")
    run = lambda: inc.maintained(
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source), place, str(tmp_path / "checkpoint"), SUMS
    ).awaitTermination()
    events(spark, ("a", 0, 1), ("a", 1, 2)).repartition(2).write.parquet(source)
    run()
    events(spark, ("a", 2, 6)).write.mode("append").parquet(source)
    run()
    run()
    assert found(spark, place) == [("a", "2024-01-01", 3, 1, 9.0, 1.0, 6.0)]


def test_distinct_customers_are_counted_once_over_days(spark, tmp_path):
    place = str(tmp_path)
    daily = inc.daily_orders()
    for n in range(2):
        rows = [("shopee", f"c{i}", START + dt.timedelta(days=n), "completed", 1.0) for i in range(2000)]
        inc.add(spark.createDataFrame(rows, "platform string, customer_id string, order_date timestamp, status string, total double"), n, place, daily)
    over_days = inc.state(spark, place, daily).selectExpr("hll_sketch_estimate(hll_union_agg(customers)) AS n", "sum(orders) AS orders").first()
    assert over_days["orders"] == 4000 and abs(over_days["n"] - 2000) <= 100


def test_no_batch_yet(spark, tmp_path):
    with pytest.raises(ValueError):
        inc.state(spark, str(tmp_path), SUMS)
