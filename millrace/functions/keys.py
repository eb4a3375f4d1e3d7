"""Row hashes and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators and null markers that the stored keys depend on.
ROW_HASH_SEPARATOR = "||"
ROW_HASH_NULL = "null"
SURROGATE_SEPARATOR = "-"
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def _text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def row_hash(columns: Sequence[str | Column], null_text: str | None = ROW_HASH_NULL) -> Column:
    """SHA-256 over the columns as text.

    With `null_text=None` nulls are left out of the text, so that ('a', null) and (null, 'a')
    collide; the default keeps them apart.
    """
    parts = [_text(c) for c in columns]
    if null_text is not None:
        parts = [F.coalesce(p, F.lit(null_text)) for p in parts]
    return F.sha2(F.concat_ws(ROW_HASH_SEPARATOR, *parts), 256)


def surrogate_key(*columns: str | Column) -> Column:
    """MD5 key over one or several natural keys."""
    parts = [F.coalesce(_text(c), F.lit(SURROGATE_NULL)) for c in columns]
    return F.md5(F.concat_ws(SURROGATE_SEPARATOR, *parts))


def packed_hex(column: str) -> Column:
    """A text for the way through a shuffle: lower-case hex digits as bytes, half as long, any other text as it is."""
    text = _text(column)
    pairs = text.rlike(r"^([0-9a-f]{2})*\z")
    return F.struct(F.when(pairs, F.unhex(text)).alias("bytes"), F.when(~pairs, text).alias("text"))


def unpacked_hex(column: str) -> Column:
    """The text that `packed_hex` took; null where a left join found none."""
    return F.coalesce(F.lower(F.hex(f"{column}.bytes")), F.col(f"{column}.text"))


def packed_key(column: str, follows: Sequence[str | Column] | None = None) -> Column:
    """A key for the way through a shuffle, in one value: lower-case hex digits as bytes, any other text as it is.

    A key that is the row hash of columns which travel too (`follows`) takes no bytes.
    """
    text = _text(column)
    packed = F.when(text.rlike(r"^([0-9a-f]{2})*\z"), F.concat(F.lit(b"h"), F.unhex(text))).otherwise(
        F.concat(F.lit(b"t"), text.cast("binary")))
    return packed if follows is None else F.when(text == row_hash(follows), F.lit(b"")).otherwise(packed)


def unpacked_key(column: str, follows: Sequence[str | Column] | None = None) -> Column:
    """The key that `packed_key` took; null where a left join found none."""
    key, rest = F.col(column), F.substring(column, 2, 2**31 - 1)
    packed = F.when(F.substring(column, 1, 1) == F.lit(b"h"), F.lower(F.hex(rest))).otherwise(rest.cast("string"))
    return packed if follows is None else F.when(F.octet_length(key) == 0, row_hash(follows)).otherwise(packed)


def label_id(column: str | Column) -> Column:
    """Identifier of a code-table row: SHA-256 of its label."""
    return F.sha2(_text(column), 256)


def seeded_number(seed: int, *columns: str | Column) -> Column:
    """A repeatable non-negative whole number below 2**32 drawn from the key columns."""
    text = F.concat_ws(ROW_HASH_SEPARATOR, F.lit(str(seed)), *[_text(c) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def seeded_uniform(seed: int, *columns: str | Column) -> Column:
    """A repeatable number in [0, 1) drawn from the key columns."""
    return seeded_number(seed, *columns) / F.lit(4294967296.0)
