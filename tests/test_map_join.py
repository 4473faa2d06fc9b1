"""The SKU map grows with the catalogue: no task holds it whole, however small Spark estimates it."""

from __future__ import annotations

from pyspark.sql import functions as F

from bazaarspark.plans.product import with_master_sku


def test_a_derived_map_is_not_broadcast(spark, tmp_path):
    # Few bytes in a file that become many rows: the estimate stays far below the broadcast threshold.
    spark.range(40).write.parquet(f"{tmp_path}/few")
    many = spark.read.parquet(f"{tmp_path}/few").select(F.col("id"), F.explode(F.sequence(F.lit(0), F.lit(49))).alias("n"))
    number = (F.col("id") * 50 + F.col("n")).cast("string")
    sku_map = many.select(F.lit("shopee").alias("platform"), number.alias("platform_sku"), F.concat(F.lit("M"), number).alias("master_sku"))
    sold = spark.createDataFrame([("shopee", "7"), ("shopee", "1999"), ("lazada", "7"), ("shopee", None)], "platform string, sku string")
    found = with_master_sku(sold, sku_map)
    rows = {(r.platform, r.sku): r.master_sku for r in found.collect()}
    assert rows == {("shopee", "7"): "M7", ("shopee", "1999"): "M1999", ("lazada", "7"): "7", ("shopee", None): None}
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()
