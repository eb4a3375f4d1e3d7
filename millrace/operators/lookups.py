"""Joins of facts to dimensions.

No function here forces a broadcast: Spark broadcasts a side whose size it has checked
(`spark.sql.autoBroadcastJoinThreshold`, at run time through AQE) and otherwise shuffles,
with hot keys split by the AQE skew join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shape import MissingColumns


def attach_keys(
    df: DataFrame, lookup: DataFrame, keys: Mapping[str, str], tolerant: bool = False, dedupe: bool = False
) -> DataFrame:
    """Left join that adds surrogate keys: {natural key column: surrogate key column}.

    `dedupe=True` keeps one surrogate key (the smallest) per natural key, so the join cannot
    multiply rows.
    """
    for natural, surrogate in keys.items():
        if natural not in df.columns or natural not in lookup.columns or surrogate not in lookup.columns:
            if tolerant:
                continue
            raise MissingColumns(f"cannot look up {surrogate} by {natural}")
        side = lookup.select(natural, surrogate)
        if dedupe:
            side = side.groupBy(natural).agg(F.min(surrogate).alias(surrogate))
        df = df.join(side, natural, "left")
    return df


def left_lookup(
    df: DataFrame, lookup: DataFrame, on: Mapping[str, str | Column], take: Mapping[str, str | Column]
) -> DataFrame:
    """Left join on {lookup column: column or expression of df}, adding {new name: lookup column}."""
    names = {k: f"_on_{i}" for i, k in enumerate(on)}
    side = lookup.select(
        *[F.col(k).alias(n) for k, n in names.items()],
        *[(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in take.items()],
    )
    condition = None
    for k, v in on.items():
        part = (df[v] if isinstance(v, str) else v) == side[names[k]]
        condition = part if condition is None else condition & part
    return df.join(side, condition, "left").drop(*names.values())


def through_bridge(left: DataFrame, bridge: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Many-to-many join over a table of key pairs."""
    return left.join(bridge.select(left_key, right_key), left_key).join(right, right_key)


def code_of_label(codes: DataFrame, label: str, label_column: str, code_column: str) -> Column:
    """The code of one label, as a scalar subquery."""
    return codes.where(F.col(label_column) == label).agg(F.min(code_column)).scalar()


def changed_rows(old: DataFrame, new: DataFrame, keys: Sequence[str], compare: str) -> DataFrame:
    """Rows of `new` whose key exists in `old` with another value of `compare`."""
    o, n = old.alias("o"), new.alias("n")
    same_key = [F.col(f"o.{k}") == F.col(f"n.{k}") for k in keys]
    differs = ~F.col(f"o.{compare}").eqNullSafe(F.col(f"n.{compare}"))
    return n.join(o, same_key, "inner").where(differs).select("n.*")


def missing_keys(df: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose foreign key is set but has no parent row; `on` is {child column: parent column}."""
    side = parent.select(*[F.col(p).alias(f"_p_{c}") for c, p in on.items()])
    condition = None
    for c in on:
        part = df[c] == side[f"_p_{c}"]
        condition = part if condition is None else condition & part
        df = df.where(F.col(c).isNotNull())
    return df.join(side, condition, "left_anti")
