"""Work is dealt over tasks by the number of rows, not by files, cores or the groups rows belong to."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from bazaarspark.checks import staging
from bazaarspark.operators import ranking


@pytest.fixture
def no_automatic_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_products_of_one_file_are_dealt_over_tasks_by_their_number(spark, tmp_path, monkeypatch):
    parts = spark.range(3000).select(
        *[F.col("id").alias("p_partkey"), F.lit("n").alias("p_name"), F.lit("t").alias("p_type"), F.lit("b").alias("p_brand")],
        *[F.lit(1.5).alias("p_retailprice"), F.lit(2).alias("p_size")],
    )
    parts.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    monkeypatch.setattr(staging, "PARTS", 50, raising=False)
    products = staging.Staging(spark, str(tmp_path)).products
    sizes = [r["count"] for r in products.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(sizes) == 9000 and len(sizes) > 40 and max(sizes) < 600


def test_rows_of_a_large_group_do_not_meet_their_cuts_in_one_task(spark, no_automatic_broadcast):
    df = spark.range(4000).select(
        F.when(F.col("id") % 50 == 0, "rare").otherwise("hot").alias("g"), (F.col("id") % 90).alias("v"), F.col("id").cast("string").alias("t")
    )
    plan = ranking.in_ranges(df, ["g"], "v", "t", True, 100)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(g" not in plan and "SortMergeJoin" not in plan
