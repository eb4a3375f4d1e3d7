"""Column and row shaping. Every function chains with `df.transform(fn, ...)`."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import row_hash


class MissingColumns(ValueError):
    """A step names columns that the table does not have."""


def _present(df: DataFrame, names: Sequence[str], tolerant: bool) -> list[str]:
    missing = [n for n in names if n not in df.columns]
    if missing and not tolerant:
        raise MissingColumns(f"missing columns {missing}; the table has {df.columns}")
    return [n for n in names if n in df.columns]


def copy_columns(df: DataFrame, names: Mapping[str, str | Sequence[str]], tolerant: bool = False) -> DataFrame:
    """Copy columns under one or several new names; the old ones stay."""
    new = {}
    for old in _present(df, list(names), tolerant):
        targets = [names[old]] if isinstance(names[old], str) else names[old]
        new.update({t: F.col(old) for t in targets})
    return df.withColumns(new) if new else df


def cast_columns(df: DataFrame, types: Mapping[str, str], tolerant: bool = False, strict: bool = False) -> DataFrame:
    """Cast columns; values that do not convert become null unless `strict`."""
    names = _present(df, list(types), tolerant)
    if not names:
        return df
    if strict:
        return df.withColumns({n: F.col(n).cast(types[n]) for n in names})
    return df.withColumns({n: F.col(n).try_cast(types[n]) for n in names})


def add_literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({n: F.lit(v) for n, v in values.items()}) if values else df


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*names)


def pick_columns(df: DataFrame, names: Sequence[str], tolerant: bool = False) -> DataFrame:
    return df.select(*_present(df, names, tolerant))


def add_row_hash(df: DataFrame, columns: Sequence[str], name: str, tolerant: bool = False) -> DataFrame:
    names = _present(df, columns, tolerant)
    return df.withColumn(name, row_hash(names)) if names else df


def rename_select(df: DataFrame, names: Mapping[str, str | Column]) -> DataFrame:
    """Projection given as {new name: old name or expression}."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in names.items()])


def split_columns(df: DataFrame, groups: Mapping[str, Mapping[str, str | Column]]) -> dict[str, DataFrame]:
    """Several narrow tables from one wide table."""
    return {name: rename_select(df, columns) for name, columns in groups.items()}


def stamp(df: DataFrame, run_time: str | None = None) -> DataFrame:
    """Set created_at and updated_at to the run time (now, if none is given)."""
    at = F.lit(run_time).cast("timestamp_ntz") if run_time else F.localtimestamp()
    return df.withColumns({"created_at": at, "updated_at": at})


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "_rank") -> DataFrame:
    """The first row of every key in the given order.

    Spark limits each map task to one row per key before the shuffle, so a hot key stays small.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) == 1).drop(name)


def first_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    return keep_one(df, keys, [F.col(c).asc() for c in by])


def last_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    return keep_one(df, keys, [F.col(c).desc() for c in by])


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows of an order; every task keeps n rows only."""
    return df.orderBy(*order).limit(n)


def where_maximum(df: DataFrame, column: str, source: DataFrame | None = None) -> DataFrame:
    """Rows whose value equals the largest one of the whole table."""
    largest = (source or df).agg(F.max(column)).scalar()
    return df.where(F.col(column) == largest)


def where_recent_months(df: DataFrame, column: str, months: int, source: DataFrame | None = None) -> DataFrame:
    """Rows from `months` before the latest date of `source` (the table itself by default)."""
    latest = (df if source is None else source).agg(F.max(F.to_date(column)).alias("latest"))
    start = latest.select(F.add_months("latest", -months)).scalar()
    # The bare column is compared, so that the scan can skip row groups.
    return df.where(F.col(column) >= start.cast(df.schema[column].dataType))


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def _distinct_keys(other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """The keys once each: repeats of a hot key are combined before they are shuffled."""
    return other.select(*([on] if isinstance(on, str) else on)).distinct()


def keys_in(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key occurs in `other`."""
    return df.join(_distinct_keys(other, on), on, "left_semi")


def keys_not_in(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in `other`; a null key is kept."""
    return df.join(_distinct_keys(other, on), on, "left_anti")


def stack_tables(tables: Sequence[DataFrame], columns: Sequence[str] = ()) -> DataFrame:
    """Union by name; a column that one table lacks is null there."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out.select(*columns) if columns else out


def insert_rows(df: DataFrame, rows: Sequence[Sequence[object]]) -> DataFrame:
    """The table and some literal rows of the same schema."""
    return df.unionByName(df.sparkSession.createDataFrame(list(rows), df.schema))
