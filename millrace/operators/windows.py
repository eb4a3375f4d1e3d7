"""Analytics over ordered rows, written so that no entity has to fit one task.

Ranks are limited before the shuffle. Gaps and running values are worked out on rows that were
first grouped by entity and date, whose number per entity is bounded by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_and_next(df: DataFrame, entity: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """First and second row of each entity side by side: first_<c> and next_<c>."""
    w = Window.partitionBy(*entity).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= 2)
    return ranked.groupBy(*entity).agg(
        *[F.max(F.when(F.col("_rank") == 1, F.col(c))).alias(f"first_{c}") for c in values],
        *[F.max(F.when(F.col("_rank") == 2, F.col(c))).alias(f"next_{c}") for c in values],
    )


def dates_with_previous(df: DataFrame, entity: Sequence[str], date: str, tie: str | None = None) -> DataFrame:
    """One row per entity and date: rows on it (`n`), the date before (`previous_date`).

    With `tie`, also the smallest value of that column on the date (`first_row`).
    """
    extra = [F.min(tie).alias("first_row")] if tie else []
    days = df.groupBy(*entity, F.to_date(date).alias("date")).agg(F.count(F.lit(1)).alias("n"), *extra)
    w = Window.partitionBy(*entity).orderBy("date")
    return days.withColumn("previous_date", F.lag("date").over(w))


def previous_date(df: DataFrame, entity: Sequence[str], date: str, tie: str) -> DataFrame:
    """Adds the date of the preceding row of the same entity, in (date, tie) order.

    `tie` has to be unique within entity and date. Rows after the first one of a date are
    preceded by a row of that date; only the first one looks further back.
    """
    days = dates_with_previous(df, entity, date, tie)
    side = days.select(
        *[F.col(c).alias(f"_{c}") for c in entity], F.col("date").alias("_date"), "first_row",
        F.col("previous_date").alias("_previous"),
    )
    condition = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in entity] + [F.to_date(date) == F.col("_date")]
    joined = df.join(side, condition, "left")
    before = F.when(F.col(tie) == F.col("first_row"), F.col("_previous")).otherwise(F.to_date(date))
    return joined.withColumn("previous_date", before).drop(
        *[f"_{c}" for c in entity], "_date", "first_row", "_previous"
    )


def running_mean_newest_first(df: DataFrame, period: Column, total: Column, rows: Column) -> DataFrame:
    """Per period: the mean of all rows of this and every later period, its rank, and the newest period.

    The window runs over one row per period, so its size is the calendar's.
    """
    periods = df.groupBy(period.alias("period")).agg(total.alias("total"), rows.alias("rows"))
    w = Window.orderBy(F.desc("period"))
    upto = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return periods.select(
        "period",
        F.first("period").over(upto).alias("newest"),
        (F.sum("total").over(upto).cast("double") / F.sum("rows").over(upto)).alias("running_mean"),
        F.dense_rank().over(w).alias("place"),
    )


def moving_mean(df: DataFrame, series: Sequence[str], order: str, value: str, size: int, forecast: bool) -> Column:
    """Mean of `size` periods: the ones before the row (forecast) or up to the row (smoothing).

    Null until `size` periods are there.
    """
    w = Window.partitionBy(*series).orderBy(order)
    frame = w.rowsBetween(-size, -1) if forecast else w.rowsBetween(-(size - 1), 0)
    return F.when(F.count(value).over(frame) == size, F.sum(value).over(frame).cast("double") / size)


def add_lags(df: DataFrame, series: Sequence[str], order: str, value: str, offsets: Sequence[int]) -> DataFrame:
    """Columns <value>_lag<k>: the value k periods earlier in the same series."""
    w = Window.partitionBy(*series).orderBy(order)
    return df.withColumns({f"{value}_lag{k}": F.lag(value, k).over(w) for k in offsets})
