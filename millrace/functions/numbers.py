"""Number helpers: exact sums, safe division, flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact(c: str | Column, scale: int = 2) -> Column:
    """The value as a decimal, so that sums do not depend on the order of the rows."""
    return col(c).cast(f"decimal(18,{scale})")


def exact_sum(c: str | Column, scale: int = 2) -> Column:
    return F.sum(exact(c, scale))


def exact_mean(c: str | Column, scale: int = 2) -> Column:
    """Mean of a fixed-point column: an exact sum and one division at the end."""
    return exact_sum(c, scale).cast("double") / F.count(col(c))


def rounded_mean(c: str | Column, places: int = 2, scale: int = 2) -> Column:
    """Mean in decimal arithmetic, rounded half up to `places`."""
    total = exact_sum(c, scale).cast("decimal(30,4)")
    return F.round(total / F.count(col(c)).cast("decimal(19,0)"), places).cast("double")


def safe_divide(a: str | Column, b: str | Column) -> Column:
    """a / b; null where b is zero."""
    return col(a) / F.nullif(col(b), F.lit(0))


def percent_difference(base: str | Column, other: str | Column, places: int = 2) -> Column:
    """100 * (base - other) / base, null for a zero base."""
    return F.round(safe_divide(col(base) - col(other), base) * F.lit(100), places)


def discount_fraction(base: str | Column, paid: str | Column) -> Column:
    """Share of the list price that was taken off."""
    return safe_divide(col(base) - col(paid), base)


def to_number(c: str | Column, kind: str = "double") -> Column:
    """Text to number; text that is no number becomes null."""
    return F.expr(f"try_cast(`{c}` as {kind})") if isinstance(c, str) else c.try_cast(kind)


def yes_flag(c: str | Column, yes: str = "yes") -> Column:
    """1 for the yes value, 0 for anything else, nulls included."""
    return F.when(col(c) == yes, 1).otherwise(0)


def outcome_flag(c: str | Column, good: str = "success", bad: str = "failure") -> Column:
    """1 / 0 / null for good, bad and neither."""
    return F.when(col(c) == good, 1).when(col(c) == bad, 0)
