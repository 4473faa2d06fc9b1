"""Sums and counts restricted to periods before the as-of date, all in one pass over the data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bazaarspark.functions.dates import between_days
from bazaarspark.functions.scalars import col


def period_sum(value, date, as_of, oldest: int, newest: int | None = None) -> Column:
    """Sum of `value` over days in [as_of - oldest, as_of - newest); zero outside."""
    return F.sum(F.when(between_days(date, as_of, newest, oldest), col(value)).otherwise(0))


def period_count(date, as_of, oldest: int, newest: int | None = None, only: Column | None = None) -> Column:
    inside = between_days(date, as_of, newest, oldest)
    return F.count_if(inside if only is None else inside & only)
