"""A load lists folders in few tasks, looks up nothing in a table without rows, and keeps no shuffle files."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from bazaarspark.session import RELEASE, configure, shuffles_released
from bazaarspark.sources import key_index, store


def days(spark, numbers, value):
    day = F.date_add(F.lit(dt.date(2001, 1, 1)), F.col("id").cast("int"))
    return spark.range(0).union(spark.createDataFrame([(n,) for n in numbers], "id long")).select(
        F.col("id").cast("string").alias("k"), day.alias("day"), F.lit(value).alias("v")
    )


@pytest.fixture
def table(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:8]}"
    yield name, f"{tmp_path}/t"
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_folders_are_listed_in_few_tasks(spark):
    assert int(configure(spark).conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) <= 64


def test_only_a_table_with_rows_is_looked_up(spark, table, monkeypatch):
    asked, read = [], []
    find, write = key_index.days_of, store.write_days
    monkeypatch.setattr(key_index, "days_of", lambda *a: asked.append(1) or find(*a))

    def watched(df, *more):
        read.append(df._jdf.queryExecution().optimizedPlan().toString())
        write(df, *more)

    monkeypatch.setattr(store, "write_days", watched)
    store.upsert(spark, table[0], days(spark, [1, 2, 3], "a"), ["k"], "day", table[1])
    assert not asked and "Join" not in read[0]
    store.upsert(spark, table[0], days(spark, [3, 4], "b"), ["k"], "day", table[1])
    assert len(asked) == 1 and "Join" in read[1]
    assert sorted((r.k, r.v) for r in spark.table(table[0]).collect()) == [("1", "a"), ("2", "a"), ("3", "b"), ("4", "b")]


def test_keys_of_a_first_load_are_indexed(spark, table):
    store.upsert(spark, table[0], days(spark, [1, 2], "a"), ["k"], "day", table[1])
    moved = days(spark, [1], "b").withColumn("day", F.lit(dt.date(2002, 1, 1)))
    store.upsert(spark, table[0], moved, ["k"], "day", table[1])
    found = sorted((r.k, str(r.day), r.v) for r in spark.table(table[0]).collect())
    assert found == [("1", "2002-01-01", "b"), ("2", "2001-01-03", "a")]


def test_shuffles_are_released_by_loads_only(spark, table, monkeypatch):
    before, seen, write = spark.conf.get(RELEASE), [], store.write_days

    def watched(*a):
        seen.append(spark.conf.get(RELEASE))
        write(*a)

    monkeypatch.setattr(store, "write_days", watched)
    store.upsert(spark, table[0], days(spark, [1], "a"), ["k"], "day", table[1])
    assert seen == ["true"] and spark.conf.get(RELEASE) == before
    with pytest.raises(ZeroDivisionError), shuffles_released(spark):
        1 / 0
    assert spark.conf.get(RELEASE) == before
    with shuffles_released(spark):
        twice = spark.range(100).groupBy((F.col("id") % 7).alias("k")).count()
        assert sorted(twice.collect()) == sorted(twice.collect())
