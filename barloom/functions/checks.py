"""Bar validity predicates. Three different ones are in use; they are not merged.

Spark orders NaN above every number, so a NaN fails every "below" test. Expressions are
kept small: they run per bar, inside generated code that must stay small enough to compile.
"""
from pyspark.sql import Column
from pyspark.sql import functions as F

PRICES = ("open", "high", "low", "close")


def _col(name, row: Column | None) -> Column:
    return F.col(name) if row is None else row[name]


INFINITY = float("inf")


def is_finite(value: Column) -> Column:
    """A number that is neither missing, NaN nor infinite (NaN is not below infinity here)."""
    return F.coalesce(F.abs(value) < F.lit(INFINITY), F.lit(False))


def _fields(row: Column | None):
    return [_col(p, row) for p in PRICES + ("volume",)]


def is_structural(row: Column | None = None) -> Column:
    """All fields present, prices above zero, volume not negative, high and low enclose."""
    o, h, l, c, v = _fields(row)
    return F.coalesce(
        (F.least(o, h, l, c) > 0) & (v >= 0) & (h >= F.greatest(o, c, l)) & (l <= F.least(o, c))
        & (o + h + l + c + v).isNotNull(), F.lit(False))


def is_row_valid(row: Column | None = None) -> Column:
    """Structural and every field finite (a sum is finite only if its terms are)."""
    o, h, l, c, v = _fields(row)
    return F.coalesce(
        (F.least(o, h, l, c) > 0) & (v >= 0) & (h >= F.greatest(o, c, l)) & (l <= F.least(o, c))
        & (o + h + l + c + v < F.lit(INFINITY)), F.lit(False))


def is_priced(row: Column | None = None) -> Column:
    """All four prices finite and above zero (volume and envelope are not looked at)."""
    o, h, l, c = (_col(p, row) for p in PRICES)
    return F.coalesce((F.least(o, h, l, c) > 0) & (o + h + l + c < F.lit(INFINITY)), F.lit(False))


def ratio_change(now: Column, then: Column) -> Column:
    """now/then - 1, null when the reference value is zero or missing."""
    return now / F.nullif(then, F.lit(0.0)) - 1
