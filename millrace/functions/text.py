"""Text helpers for cleaning and features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col


def letters(c: str | Column) -> Column:
    """The first run of ASCII letters, null where there is none."""
    found = F.regexp_extract(col(c), "([A-Za-z]+)", 1)
    return F.when(found != "", found)


def starts_like(c: str | Column, pattern: str) -> Column:
    """Regular expression matched at the start of the text."""
    return col(c).rlike(f"^(?:{pattern})")


def without(c: str | Column, *parts: str) -> Column:
    """The text with every given part removed."""
    out = col(c)
    for part in parts:
        out = F.replace(out, F.lit(part), F.lit(""))
    return out


def swap(c: str | Column, old: str, new: str) -> Column:
    return F.replace(col(c), F.lit(old), F.lit(new))


def sentinel_to_null(c: str | Column, sentinel: str = "unknown") -> Column:
    return F.nullif(col(c), F.lit(sentinel))


def number_before(c: str | Column, suffix: str, kind: str = "int") -> Column:
    """'7/10' to 7: strip the suffix, then cast; bad text becomes null."""
    return without(c, suffix).try_cast(kind)


def feature_text(columns: Sequence[str | Column]) -> Column:
    """Attributes joined by one blank, null read as empty text."""
    return F.concat_ws(" ", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns])


def first_token(c: str | Column) -> Column:
    return F.split(col(c), " ").getItem(0)


def slug(c: str | Column) -> Column:
    """Lower case, dots and commas dropped, blanks as underscores."""
    return F.translate(F.lower(col(c)), " .,", "_")


def prefix(c: str | Column, length: int) -> Column:
    return F.substring(col(c), 1, length)


def path_of(folder: str, c: str | Column, suffix: str = "") -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), col(c).cast("string"), F.lit(suffix))


def text_list(c: str | Column) -> Column:
    """Text such as "['a', 'b']" to an array."""
    return F.from_json(col(c), "array<string>")


def blank(c: str | Column) -> Column:
    """True for null and for text without content."""
    return col(c).isNull() | (F.trim(col(c)) == "")
