"""What a sale costs is paid once, not again for every product it is repeated for."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bazaarspark.checks.framework import shaped
from bazaarspark.checks.marts import CHECKS
from bazaarspark.checks.staging import AS_OF, Staging
from bazaarspark.plans import product


def tables(spark, folder):
    day = dt.datetime(AS_OF.year, AS_OF.month, AS_OF.day) - dt.timedelta(days=3)
    orders = [(i, i, "FOP"[i % 3], 10.0 + i, day - dt.timedelta(days=i % 20)) for i in range(60)]
    lines = [(i, i * 500 % 4000 + 1, 1, 1, 2.0, 7.77 * i, 0.05, 0.01, day) for i, *_ in orders]
    parts = [(k, f"n{k}", "B", "T", 1 + k % 3, 1.005 * k) for k in range(1, 4001, 250)]
    for name, rows, schema in (
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp"),
        (
            "lineitem",
            lines,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
            " l_discount double, l_tax double, l_shipdate timestamp",
        ),
        ("part", parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def test_sales_are_rounded_before_they_are_repeated(spark, tmp_path):
    tables(spark, tmp_path)
    check = next(c for c in CHECKS if c.name == "m5b_product_performance_fan_out")
    found = check.run(spark, str(tmp_path))
    s = Staging(spark, str(tmp_path))
    plain = product.product_performance(s.items, s.orders, s.products, s.sku_map, AS_OF, fan_out=True)
    expected = shaped(plain, check.fields())
    assert found.dtypes == expected.dtypes
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert found.count() > found.where(F.col("canonical_name").isNotNull()).select("date", "master_sku", "platform", "product_name").distinct().count()
    above = found._jdf.queryExecution().optimizedPlan().toString().partition("Join ")[0]
    assert "round(" not in above
    assert "round(" in expected._jdf.queryExecution().optimizedPlan().toString().partition("Join ")[0]
