"""Columns computed once per row, however often later steps refer to them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, columns: dict[str, Column], keep: list[str] | None = None) -> DataFrame:
    """Add `columns`, fixed behind a one-row generator.

    Filters on parsed fields are otherwise pushed below the projection that parses, with the parse copied
    into every reference. The generator is a streaming operator: one row in, one row out. The row itself
    is built in the projection before it, where code is generated for it; the outer form keeps the
    optimizer from testing the array's size, which would compute it twice.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [c for c in (df.columns if keep is None else keep) if c not in columns]
    return df.select(*kept, F.array(row).alias("_once")).select(*kept, F.inline_outer("_once"))
