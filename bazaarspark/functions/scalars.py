"""Null-safe arithmetic, first-non-empty chains, lenient number parsing and text helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(top, bottom) -> Column:
    """`top / bottom`, NULL when the denominator is zero or either side is NULL."""
    return F.try_divide(col(top).cast("double"), col(bottom).cast("double"))


def growth(current, previous) -> Column:
    """Relative change against `previous`; NULL when there was nothing before."""
    return ratio(col(current) - col(previous), previous)


def zero(c) -> Column:
    """NULL becomes zero."""
    return F.coalesce(col(c), F.lit(0))


def first_text(*cols) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cols])


def first_number(*cols) -> Column:
    """First value that is neither NULL nor zero; the last argument counts as it is."""
    *head, last = [col(c) for c in cols]
    return F.coalesce(*[F.nullif(c, F.lit(0).cast("double")) for c in head], last)


def as_double(c) -> Column:
    """Text to double, thousands separators allowed; NULL when it is not a number."""
    return F.replace(col(c), F.lit(","), F.lit("")).try_cast("double")


def as_long(c) -> Column:
    """Text to whole number, cutting decimals; NULL when it is not a finite number."""
    number = as_double(c)
    finite = F.when(F.isnan(number) | (F.abs(number) > F.lit(9.0e18)), None).otherwise(number)
    return finite.cast("long")


def lenient_long(c) -> Column:
    """Whole number with zero standing in for anything unreadable."""
    return F.coalesce(as_long(c), F.lit(0).cast("long"))


def map_text(c, mapping: Mapping[str, str], default: str) -> Column:
    """Case-insensitive code translation; empty, NULL and unknown codes give `default`."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(col(c))), F.lit(default))


def lookup(c, mapping: Mapping[str, str]) -> Column:
    """Exact translation through a small constant mapping; NULL when the code is not in it."""
    pairs = [F.lit(part) for item in mapping.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), col(c))


def number_text(c, places: int = 2) -> Column:
    """Rounded number as plain text without trailing zeros: 1.50 -> 1.5, 2.00 -> 2."""
    fixed = F.round(col(c), places).cast(f"decimal(38,{places})").cast("string")
    return F.regexp_replace(fixed, r"\.0*$|(\.[0-9]*?)0+$", "$1") if places else fixed


def stable_id(*cols) -> Column:
    """Identifier that is the same for the same inputs in every run."""
    return F.sha2(F.concat_ws("|", *[col(c).cast("string") for c in cols]), 256)


def join_parts(*cols) -> Column:
    """Comma-joined non-empty parts, NULL when nothing is left."""
    return F.nullif(F.concat_ws(", ", *[F.nullif(col(c), F.lit("")) for c in cols]), F.lit(""))


def compare(left, operator: str, right) -> Column:
    """Comparison named by a rule: lt, gt, lte, gte or eq."""
    left, right = col(left), col(right)
    return {
        "lt": left < right,
        "gt": left > right,
        "lte": left <= right,
        "gte": left >= right,
        "eq": left == right,
    }[operator]


def severity_order(c) -> Column:
    return F.when(col(c) == "critical", 1).when(col(c) == "warning", 2).otherwise(3)
