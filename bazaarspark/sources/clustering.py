"""Files in which a filter on any of several columns finds its rows together.

Sorting by columns in order helps a filter on the first one only. Here every column is cut into ranges at its quantiles, the
bits of the range numbers are interleaved, and rows are parted and sorted by the result, so each file and row group covers a
small range of all columns and the statistics of Parquet leave out most of them. Identifiers, whose ranges tell nothing, can
have Bloom filters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarspark.operators.ranking import cuts_below

BITS = 6  # of a column's range number; at most 63 cut points come to the driver for each column
SAMPLE = 64  # texts looked at for each range


def cut_points(df: DataFrame, column: str, bits: int = BITS) -> list:
    """At most 2^bits - 1 values that cut the column into ranges of about equal size; of texts their beginnings are looked at."""
    ranges = 1 << bits
    known = df.where(F.col(column).isNotNull())
    if isinstance(df.schema[column].dataType, T.StringType):
        rows = known.agg(F.count(F.lit(1))).first()[0]
        share = F.rand(23) * rows < ranges * SAMPLE
        texts = known.where(share).agg(F.sort_array(F.collect_list(F.substring(column, 1, 256))).alias("t")).first()["t"]
        found = [texts[i * len(texts) // ranges] for i in range(1, ranges)] if texts else []
    else:
        points = F.lit([i / ranges for i in range(1, ranges)])
        found = known.agg(F.percentile_approx(column, points, F.lit(16 * ranges)).alias("p")).first()["p"] or []
    return sorted(set(found))


def range_number(column: str, kind: T.DataType, points: list, bits: int = BITS) -> Column:
    """Cut points below the value; NULL goes with the least values."""
    if not points:
        return F.lit(0)
    cuts = F.array(*(F.lit(p).cast(kind) for p in points))
    return F.coalesce(cuts_below(F.col(column), cuts, 1 << bits), F.lit(0))


def interleaved(numbers: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the numbers by turns, the highest ones first."""
    z = F.lit(0).cast("bigint")
    for i in range(bits):
        for k, n in enumerate(numbers):
            bit = F.shiftright(n, i).bitwiseAND(F.lit(1)).cast("bigint")
            z = z.bitwiseOR(F.shiftleft(bit, i * len(numbers) + len(numbers) - 1 - k))
    return z


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], files: int | None = None, ids: Sequence[str] = (), bits: int = BITS
) -> None:
    """Write `df` clustered by all of `columns`, with Bloom filters on `ids`. `files` parts, by default those of a shuffle.

    The bits of all columns together must fit 63.
    """
    if not columns or bits * len(columns) > 63:
        raise ValueError("give one column at least, and fewer bits for so many columns")
    numbers = [range_number(c, df.schema[c].dataType, cut_points(df, c, bits), bits) for c in columns]
    z = interleaved(numbers, bits)
    placed = df.withColumn("_z", z)
    # Rows of one place differ in a digest: however frequent their values, no file takes all of them.
    digest = F.xxhash64(*(F.col(f"`{c}`") for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)))
    order = [F.col("_z"), digest]
    placed = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    out = placed.sortWithinPartitions("_z", *columns).drop("_z").write
    for c in ids:
        out = out.option(f"parquet.bloom.filter.enabled#{c}", "true")
    out.parquet(path)
