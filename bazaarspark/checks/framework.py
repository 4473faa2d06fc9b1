"""One description of a result's columns, applied the same way to the Spark query and its SQL.

Column kinds: s text, l whole number, d date (shown as ISO text in both engines), b boolean, m money
(4 decimals), r ratio (6 decimals).

Doubles are rounded in both engines. Quotients of money often end in an exact half of the last decimal,
which the engines round by different rules, so both add the same tiny amount first.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarspark.checks.staging import Staging

SPARK_TYPES = {"s": "string", "l": "bigint", "d": "date", "b": "boolean", "m": "double", "r": "double"}
SQL_TYPES = {"s": "VARCHAR", "l": "BIGINT", "d": "DATE", "b": "BOOLEAN", "m": "DOUBLE", "r": "DOUBLE"}
DECIMALS = {"m": 4, "r": 6}
NUDGE = {"m": "0.0000001", "r": "0.000000001"}


def fields_of(columns: str) -> list[tuple[str, str]]:
    """(name, kind) pairs of a text such as 'd date; s platform; m spend cost'."""
    out = []
    for part in columns.split(";"):
        kind, *names = part.split()
        out += [(n, kind) for n in names]
    return out


@dataclasses.dataclass(frozen=True)
class Check:
    name: str
    columns: str
    build: Callable[[Staging], DataFrame]
    sql: str | None = None
    formed: bool = False  # `build` gives columns that are shaped already

    def fields(self) -> list[tuple[str, str]]:
        return fields_of(self.columns)

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        built = self.build(Staging(spark, folder))
        return built.select(*[n for n, _ in self.fields()]) if self.formed else shaped(built, self.fields())

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        body = self.sql.strip()
        cells = []
        for name, kind in self.fields():
            cell = f'CAST("{name}" AS {SQL_TYPES[kind]})'
            if kind == "d":
                cell = f"CAST({cell} AS VARCHAR)"
            if kind in DECIMALS:
                cell = f"round({cell} + CAST({NUDGE[kind]} AS DOUBLE), {DECIMALS[kind]}) + CAST(0 AS DOUBLE)"
            cells.append(f'{cell} AS "{name}"')
        return f"SELECT {', '.join(cells)}\nFROM (\n{body}\n) AS checked"


def shaped(df: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    cells = []
    for name, kind in fields:
        cell = F.col(f"`{name}`").cast(SPARK_TYPES[kind])
        if kind == "d":
            cell = cell.cast("string")
        if kind in DECIMALS:
            cell = F.round(cell + F.lit(float(NUDGE[kind])), DECIMALS[kind]) + F.lit(0.0)
        cells.append(cell.alias(name))
    return df.select(*cells)
