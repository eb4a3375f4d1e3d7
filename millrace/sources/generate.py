"""Repeatable related test tables: every value is a hash of its key and a seed.

Nothing depends on partitioning, so a table can be made in any number of tasks and made again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import seeded_number

_TASKS_PER_CORE = 4


def pick_key(seed: int, first: int | Column, count: int | Column, *key: str | Column) -> Column:
    """A foreign key between `first` and `first + count - 1`."""
    start = F.lit(first) if isinstance(first, int) else first
    size = F.lit(count) if isinstance(count, int) else count
    return (start + F.pmod(seeded_number(seed, *key), size)).cast("bigint")


def later_date(seed: int, date: str | Column, most_days: int, *key: str | Column) -> Column:
    """The date moved by 0 to `most_days` days."""
    start = F.to_date(F.col(date) if isinstance(date, str) else date)
    return F.date_add(start, F.pmod(seeded_number(seed, *key), F.lit(most_days + 1)).cast("int"))


def children(
    parents: DataFrame, parent_key: str, parent_date: str, per_parent: int, other_first: int, other_count: int,
    seed: int = 0, most_days: int = 365,
) -> DataFrame:
    """child_id, the parent key, another random foreign key and a date after the parent's date."""
    rows = parents.select(parent_key, parent_date, F.explode(F.sequence(F.lit(0), F.lit(per_parent - 1))).alias("no"))
    return rows.select(
        F.concat_ws("-", parent_key, "no").alias("child_id"),
        parent_key,
        pick_key(seed, other_first, other_count, parent_key, "no").alias("other_key"),
        later_date(seed + 1, parent_date, most_days, parent_key, "no").alias("date_created"),
    )


def weekly_stock(products: DataFrame, spark: SparkSession, years: list[int], weeks: int = 52, seed: int = 0) -> DataFrame:
    """One row per product, year and week: stock, promotion flag and quantity sold.

    `products` has product_id. `week_no` counts the weeks in calendar order. A small file of products makes
    very many rows, so products are dealt to all cores before they multiply.
    """
    slots = F.sequence(F.lit(0), F.lit(len(years) * weeks - 1))
    spread = products.select("product_id").repartition(_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)
    rows = spread.select("product_id", F.explode(slots).alias("week_no"))
    key = ("product_id", "week_no")
    promoted = F.pmod(seeded_number(seed, *key), F.lit(4)) == 0
    return rows.select(
        "product_id", "week_no",
        (F.lit(years[0]) + F.floor(F.col("week_no") / weeks)).cast("int").alias("year"),
        (F.col("week_no") % weeks + 1).alias("week"),
        F.pmod(seeded_number(seed + 1, *key), F.lit(101)).cast("int").alias("stock"),
        promoted.cast("int").alias("promotion"),
        F.when(promoted, F.pmod(seeded_number(seed + 2, *key), F.lit(9)) * 4 + 4)
        .otherwise(F.pmod(seeded_number(seed + 2, *key), F.lit(20)) + 1).cast("int").alias("qty_sold"),
    )
