"""Two versions of a table, row against row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row: same, changed, missing (only left) and extra (only right), as counts of rows.

    Rows meet by their keys, nulls included, and are compared by a fingerprint of the other columns
    under the left table's names. Repeated rows count as often as they stand. Of rows with the same key,
    equal ones are paired first and the rest count as changed, as far as both sides have them. Without
    keys a row is its own key, so nothing is changed. A key's rows are counted before they are shuffled.
    """
    others = [c for c in left.columns if c not in keys]
    if set(left.columns) != set(right.columns):
        raise ValueError(f"columns {left.columns} against {right.columns}")
    # 32 bytes each, whatever the rows hold.
    mark = F.unhex(F.sha2(F.concat_ws("\x1f", *[_text(c) for c in others]), 256))
    key = F.unhex(F.sha2(F.concat_ws("\x1f", *[_text(c) for c in keys]), 256)) if keys else mark
    sides = [
        df.select(key.alias("key"), mark.alias("mark"), F.lit(a).alias("l"), F.lit(b).alias("r"))
        for df, a, b in ((left, 1, 0), (right, 0, 1))
    ]
    rows = sides[0].unionByName(sides[1]).groupBy("key", "mark").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    by_key = rows.groupBy("key").agg(
        F.sum(F.least("l", "r")).alias("same"), F.sum("l").alias("l"), F.sum("r").alias("r"))
    spare_left, spare_right = F.col("l") - F.col("same"), F.col("r") - F.col("same")
    changed = F.least(spare_left, spare_right)
    counts = {"same": F.col("same"), "changed": changed, "missing": spare_left - changed, "extra": spare_right - changed}
    return by_key.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n) for n, c in counts.items()])


def _text(column: str) -> Column:
    """A column's value as text: null is told from the text, and lengths keep neighbours apart."""
    text = F.col(f"`{column}`").cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))
