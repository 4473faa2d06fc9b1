"""The queries of this package by name: what the driver runs, and SQL where SQL can express the result."""

from __future__ import annotations

import dataclasses
import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

MODULES = ("queries",)


@dataclasses.dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def llm_queries() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in MODULES:
        found |= importlib.import_module(f"bazaarspark.llm.{module}").QUERIES
    return found
