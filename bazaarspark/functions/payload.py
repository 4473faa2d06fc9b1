"""Values inside landed payloads.

Fields whose type varies between sources are declared VARIANT in the payload schemas, so that a number,
the same number as text, an explicit null and a missing key stay distinguishable. `tokens` turns them into
their JSON text once per record; everything else here works on such tokens, named by their path. A value
"counts" when it is neither missing nor null, zero, false or the empty text; a text "0" counts.

The expressions are put together as SQL text and handed to Spark whole: a payload has dozens of fields, and
building them column by column costs thousands of calls into the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Beyond this, converted amounts would not fit their decimals.
LARGEST = "1e18D"


class Sql:
    """SQL text of the functions below, for use inside larger expressions."""

    @staticmethod
    def number(t: str) -> str:
        return f"try_cast(replace(btrim({t}, '\"'), ',', '') as double)"

    @staticmethod
    def whole(t: str) -> str:
        n = Sql.number(t)
        return f"cast(case when abs({n}) <= 9e18 then {n} end as bigint)"

    @staticmethod
    def counts(t: str) -> str:
        return (
            f"coalesce(case when startswith({t}, '\"') then {t} <> '\"\"' when {t} = 'true' then true"
            f" else try_cast({t} as double) <> 0D end, false)"
        )

    @staticmethod
    def first(*ts: str) -> str:
        *head, last = ts
        return f"coalesce({', '.join([*(f'case when {Sql.counts(t)} then {t} end' for t in head), last])})"

    @staticmethod
    def first_number(*ts: str, default: str = "0D") -> str:
        return f"coalesce({Sql.number(Sql.first(*ts))}, {default})"

    @staticmethod
    def first_whole(*ts: str, default: str = "0L") -> str:
        return f"coalesce({Sql.whole(Sql.first(*ts))}, {default})"

    @staticmethod
    def first_text(*ts: str) -> str:
        return f"coalesce({', '.join(f"nullif({t}, '')" for t in ts)})"

    @staticmethod
    def unreadable(*ts: str) -> str:
        """Any value that counts and is no number, or one that no amount column can hold (NaN, infinities, 1e30)."""
        n = Sql.number
        return " or ".join(
            f"({Sql.counts(t)} and not coalesce(abs({n(t)}) <= {LARGEST}, false))" for t in ts
        )


def tokens(path: str, schema: str) -> Column:
    """The parsed struct at `path` with every VARIANT field as its JSON text, nested structs and lists too."""

    def convert(at: str, kind: T.DataType) -> str:
        if isinstance(kind, T.VariantType):
            return f"to_json({at})"
        if isinstance(kind, T.StructType):
            return f"named_struct({', '.join(f"'{f.name}', {convert(f'{at}.{f.name}', f.dataType)}" for f in kind)})"
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            return f"transform({at}, x -> {convert('x', kind.elementType)})"
        return at

    return F.expr(f"case when {path} is not null then {convert(path, T.StructType.fromDDL(schema))} end")


def number(t: str) -> Column:
    return F.expr(Sql.number(t))


def counts(t: str) -> Column:
    """Whether a chain of alternatives stops at this value."""
    return F.expr(Sql.counts(t))


def first_number(*ts: str) -> Column:
    """Number of the first value that counts, else of the last one; 0 when that is missing."""
    return F.expr(Sql.first_number(*ts))


def first_whole(*ts: str) -> Column:
    return F.expr(Sql.first_whole(*ts))


def optional_number(t: str) -> Column:
    """Number if the value counts, else NULL."""
    return F.expr(f"case when {Sql.counts(t)} then {Sql.number(t)} end")


def optional_whole(t: str) -> Column:
    return F.expr(f"case when {Sql.counts(t)} then {Sql.whole(t)} end")


def unreadable(*ts: str) -> Column:
    """Whether any value counts but is not a number."""
    return F.expr(Sql.unreadable(*ts))
