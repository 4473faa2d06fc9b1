"""Clustered files: what filters on each column have to read."""

from __future__ import annotations

import datetime as dt
import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bazaarspark.sources import clustering

SCHEMA = "platform string, day date, amount double, id string"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    start = dt.date(2024, 1, 1)
    out = [(f"p{rng.randrange(64):02d}", start + dt.timedelta(days=rng.randrange(64)), rng.random() * 100, f"id{i}") for i in range(20_000)]
    return out + [(None, None, None, "none"), ("p00", start, float("nan"), "nan")]


def touched(path, column, value):
    """Files whose statistics do not rule the value out."""
    found = 0
    files = sorted(glob.glob(f"{path}/*.parquet"))
    for name in files:
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.to_arrow_schema().names.index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        found += any(s is None or not s.has_min_max or s.min <= value <= s.max for s in stats)
    return found, len(files)


def test_filters_on_every_column_leave_most_files_out(spark, rows, tmp_path):
    df = spark.createDataFrame(rows, SCHEMA)
    clustering.write_clustered(df, f"{tmp_path}/z", ["platform", "day"], files=64)
    df.repartitionByRange(64, "platform", "day").sortWithinPartitions("platform", "day").write.parquet(f"{tmp_path}/sorted")
    day = dt.date(2024, 2, 2)
    for column, value in (("platform", "p31"), ("day", day)):
        found, files = touched(f"{tmp_path}/z", column, value)
        assert 0 < found <= files // 3, (column, found, files)
    found, files = touched(f"{tmp_path}/sorted", "day", day)
    assert found > files // 2  # sorted in order, the second column helps little
    back = spark.read.parquet(f"{tmp_path}/z")
    assert back.columns == df.columns and back.count() == len(rows)
    want = sum(r[0] == "p31" and r[1] == day for r in rows)
    assert back.where((F.col("platform") == "p31") & (F.col("day") == F.lit(day))).count() == want
    assert back.where("id = 'none'").count() == back.where("id = 'nan'").count() == 1


def test_one_frequent_value_is_spread(spark, tmp_path):
    df = spark.range(8000).select(F.lit("same").alias("platform"), (F.col("id") % 2).alias("n"), F.col("id").cast("string").alias("id"))
    clustering.write_clustered(df, str(tmp_path / "x"), ["platform", "n"], files=8, ids=["id"])
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in glob.glob(f"{tmp_path}/x/*.parquet")]
    assert sum(sizes) == 8000 and max(sizes) < 2500
    assert spark.read.parquet(str(tmp_path / "x")).where("id = '77'").count() == 1


def test_interleaved_bits(spark):
    z = clustering.interleaved([F.lit(0b101), F.lit(0b010)], 3)
    assert spark.range(1).select(z).first()[0] == 0b100110


def test_empty_tables_and_wrong_columns(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    clustering.write_clustered(df, str(tmp_path / "e"), ["platform", "amount"])
    assert spark.read.schema(SCHEMA).parquet(str(tmp_path / "e")).count() == 0
    with pytest.raises(ValueError):
        clustering.write_clustered(df, str(tmp_path / "f"), [])
