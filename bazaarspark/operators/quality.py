"""Good rows and dead letters out of one parsed frame."""

from __future__ import annotations

import dataclasses
import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEAD_COLUMNS = ("record", "error", "error_type", "timestamp", "source_platform")


@dataclasses.dataclass(frozen=True)
class Split:
    """Rows that passed and rows that did not. Both read the same input; persist it to read it once."""

    good: DataFrame
    dead: DataFrame


def problem(*checks: tuple[Column, str, str]) -> Column:
    """struct(error_type, error) of the checks that fail, NULL if none: (fails, error type, message)."""
    failed = [(F.coalesce(fails, F.lit(False)), kind, message) for fails, kind, message in checks]
    # Conditions, not an array of failures that is filtered: no code is generated for what a higher-order function holds.
    kind = F.coalesce(*[F.when(fails, F.lit(kind)) for fails, kind, _ in failed])
    error = F.concat_ws("; ", *[F.when(fails, F.lit(message)) for fails, _, message in failed])
    return F.when(
        functools.reduce(Column.__or__, [fails for fails, _, _ in failed]),
        F.struct(kind.alias("error_type"), error.alias("error")),
    )


def split(df: DataFrame, problem_column: str, record: str, platform: str, at: Column) -> Split:
    """Part `df` by `problem_column`. `at` is the moment of the run, the same on every row."""
    good = df.where(F.col(problem_column).isNull()).drop(problem_column, record)
    dead = df.where(F.col(problem_column).isNotNull()).select(
        F.col(record).alias("record"),
        F.col(f"{problem_column}.error").alias("error"),
        F.col(f"{problem_column}.error_type").alias("error_type"),
        at.alias("timestamp"),
        F.col(platform).alias("source_platform"),
    )
    return Split(good, dead)
