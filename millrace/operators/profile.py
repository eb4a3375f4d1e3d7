"""Column profiles of whole tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path

ORDERED_TYPES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)

# Values that are equally frequent and most frequent in a column: up to this many are looked for as a list.
MOST_TIES = 1000


def _ordered(kind: T.DataType) -> bool:
    return isinstance(kind, ORDERED_TYPES)


def value_frequencies(df: DataFrame) -> DataFrame:
    """column_name, value (as text), n: every distinct value of every column, nulls included.

    This is the table's set of possible values. It stays distributed.
    """
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns
    ]
    long = df.select(F.inline(F.array(*pairs)))
    return long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def _prints(value: Column) -> list[Column]:
    """128 bits for a value, null for null; the second half does not follow from the first."""
    return [F.when(value.isNotNull(), F.xxhash64(value)), F.when(value.isNotNull(), F.xxhash64(F.lit(1), value))]


def _prints_of(field: T.StructField) -> list[Column]:
    """The fingerprint of a column: of its text, or for numbers and times of the value.

    The hash of a value of up to 64 bits is one-to-one, so its second half is left out.
    """
    if _ordered(field.dataType) and not isinstance(field.dataType, T.DecimalType):
        return [F.when(F.col(field.name).isNotNull(), F.xxhash64(field.name)), F.lit(0).cast("long")]
    return _prints(F.col(field.name).cast("string"))


def _cells(df: DataFrame, number: int) -> DataFrame:
    cells = []
    for i, f in enumerate(df.schema.fields):
        high, low = _prints_of(f)
        cells.append(F.struct(F.lit(i).alias("column"), high.alias("high"), low.alias("low")))
    return df.select(F.lit(number).alias("table"), F.inline(F.array(*cells)))


def _ties(stored: DataFrame, tops: Mapping[tuple[int, int], int]) -> dict[tuple[int, int], list]:
    """The fingerprints of the most frequent values of each column, one more than MOST_TIES at most."""
    if not tops:
        return {}
    wanted = reduce(lambda x, y: x | y, [(F.col("table") == t) & (F.col("column") == c) & (F.col("n") == n) for (t, c), n in tops.items()])
    w = Window.partitionBy("table", "column").orderBy("high", "low")
    some = stored.where(wanted).withColumn("place", F.row_number().over(w)).where(F.col("place") <= MOST_TIES + 1)
    out: dict = {at: [] for at in tops}
    for r in some.collect():
        out[r["table"], r["column"]].append((r["high"], r["low"]))
    return out


def _mode(df: DataFrame, column: str, stored: DataFrame, at: tuple[int, int], top: int, ties: list) -> Column:
    """The smallest of the values that occur `top` times, as an aggregate or a scalar subquery."""
    value = F.col(column).cast("string")
    high, low = _prints(value)
    if len(ties) <= MOST_TIES:
        return F.min(F.when(high.isin([h for h, _ in ties]) & low.isin([x for _, x in ties]), value))
    tied = stored.where((F.col("table") == at[0]) & (F.col("column") == at[1]) & (F.col("n") == top)).select("high", "low")
    rows = df.select(value.alias("value"), high.alias("high"), low.alias("low"))
    return rows.join(tied, ["high", "low"], "left_semi").agg(F.min("value")).scalar()


def profile_table(df: DataFrame, table: str, approximate: bool = False) -> DataFrame:
    """One row per column: type, null share, duplicates, smallest, largest, most frequent value.

    Duplicates are rows minus distinct non-null values. Numbers and dates get limits, the rest a mode; equally
    frequent values are decided by the smaller one, null first. `approximate=True` needs one scan and no shuffle
    of values: the distinct values are estimated and there is no mode.
    """
    return _estimate(df, table) if approximate else profile_tables({table: df})


def profile_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """The exact profiles of several tables in one result.

    Values are counted by 128-bit fingerprints, all tables and columns in one job, so texts of any
    length move as 16 bytes. How often the most frequent value of a column occurs follows from these
    counts; a second scan of each table finds the limits and, among values of that count, the smallest.
    """
    spark = next(iter(tables.values())).sparkSession
    cells = reduce(DataFrame.unionByName, [_cells(df, i) for i, df in enumerate(tables.values())])
    path = scratch_path(spark, "values")
    cells.groupBy("table", "column", "high", "low").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    stored = spark.read.parquet(path)
    # One row for each column of the tables.
    found = stored.groupBy("table", "column").agg(
        F.count("high").alias("distinct"), F.max("n").alias("top"), F.max(F.when(F.col("high").isNull(), F.col("n"))).alias("nulls"))
    counts = {(r["table"], r["column"]): r for r in found.collect()}
    tops = {
        (i, j): counts[i, j]["top"] for i, df in enumerate(tables.values()) for j, f in enumerate(df.schema.fields)
        if not _ordered(f.dataType) and (i, j) in counts and counts[i, j]["top"] > 1 and counts[i, j]["nulls"] != counts[i, j]["top"]
    }
    ties = _ties(stored, tops)
    return reduce(DataFrame.unionByName, [_profile(df, name, i, counts, stored, ties) for i, (name, df) in enumerate(tables.items())])


def _profile(df: DataFrame, table: str, number: int, counts: Mapping, stored: DataFrame, ties: Mapping) -> DataFrame:
    fields, aggs, rows = df.schema.fields, [F.count(F.lit(1)).alias("rows")], []
    nothing = F.lit(None).cast("string")
    for i, f in enumerate(fields):
        count = counts.get((number, i))
        aggs.append(F.count_if(_empty(f)).alias(f"e{i}"))
        low = high = mode = nothing
        if _ordered(f.dataType):
            aggs += [F.min(f.name).cast("string").alias(f"lo{i}"), F.max(f.name).cast("string").alias(f"hi{i}")]
            low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        elif count and count["nulls"] != count["top"]:
            # Where every value occurs once, the smallest is the mode.
            at = (number, i)
            smallest = F.min(F.col(f.name).cast("string"))
            aggs.append((_mode(df, f.name, stored, at, count["top"], ties[at]) if at in ties else smallest).alias(f"m{i}"))
            mode = F.col(f"m{i}")
        distinct = F.lit(count["distinct"] if count else 0).cast("bigint")
        rows.append(_row(table, f, len(fields), F.col(f"e{i}"), distinct, low, high, mode))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def _empty(field: T.StructField) -> Column:
    missing = F.col(field.name).isNull()
    return missing | (F.col(field.name) == "") if isinstance(field.dataType, T.StringType) else missing


def _row(table, field, width, empty, distinct, low, high, mode) -> Column:
    share = F.when(F.col("rows") > 0, empty * 100.0 / F.col("rows")).otherwise(0.0)
    return F.struct(
        F.lit(table).alias("table_name"), F.lit(field.name).alias("column_name"), F.col("rows").alias("num_rows"),
        F.lit(width).alias("num_columns"), F.lit(field.dataType.simpleString()).alias("data_type"), share.alias("null_percentage"),
        distinct.alias("distinct_values"), (F.col("rows") - distinct).alias("duplicate_count"), low.alias("min"), high.alias("max"), mode.alias("mode"),
    )


def _estimate(df: DataFrame, table: str) -> DataFrame:
    fields, aggs, rows = df.schema.fields, [F.count(F.lit(1)).alias("rows")], []
    nothing = F.lit(None).cast("string")
    for i, f in enumerate(fields):
        aggs += [F.count_if(_empty(f)).alias(f"e{i}"), F.approx_count_distinct(f.name).alias(f"d{i}")]
        low = high = nothing
        if _ordered(f.dataType):
            aggs += [F.min(f.name).cast("string").alias(f"lo{i}"), F.max(f.name).cast("string").alias(f"hi{i}")]
            low, high = F.col(f"lo{i}"), F.col(f"hi{i}")
        rows.append(_row(table, f, len(fields), F.col(f"e{i}"), F.least(F.col(f"d{i}"), F.col("rows")), low, high, nothing))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
