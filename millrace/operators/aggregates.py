"""Grouped summaries. All of them combine partial results before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import col


def child_counts(parents: DataFrame, children: DataFrame, key: str, child_key: str, name: str = "n") -> DataFrame:
    """Number of children per parent, zero for parents without any.

    The children are counted before the join, so a parent with very many of them costs nothing.
    """
    counts = children.groupBy(F.col(child_key).alias(key)).agg(F.count(F.lit(1)).alias(name))
    return parents.select(key).join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def two_level(df: DataFrame, inner: Sequence[str], outer: Sequence[str], total: Column, **outer_aggs: Column) -> DataFrame:
    """Sum per inner key (column `total`), then aggregates over these sums per outer key."""
    per_inner = df.groupBy(*dict.fromkeys([*outer, *inner])).agg(total.alias("total"))
    return per_inner.groupBy(*outer).agg(*[c.alias(n) for n, c in outer_aggs.items()])


def pick_by_label(label: str, value: str | Column, labels: Mapping[str, str], how=F.max) -> list[Column]:
    """One aggregate per label: {label value: output name}."""
    return [how(F.when(F.col(label) == lab, col(value))).alias(name) for lab, name in labels.items()]


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination of values, nulls included."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def distinct_count(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.countDistinct(c).alias(c) for c in columns])


def histogram(df: DataFrame, column: str, bins: int, by: Sequence[str] = (), own_limits: bool = False) -> DataFrame:
    """Rows per bin of equal width between the smallest and the largest value.

    With `own_limits` each group's bins lie between its own smallest and largest value.
    """
    value = F.col(column).cast("double")
    rows, also = df.where(value.isNotNull()), []
    if own_limits:
        held = [f"_limit_of_{c}" for c in by]
        limits = rows.groupBy(*[F.col(c).alias(h) for c, h in zip(by, held)]).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
        rows = rows.join(limits, reduce(and_, [F.col(c).eqNullSafe(F.col(h)) for c, h in zip(by, held)], F.lit(True)))
        low, high, also = F.col("_low"), F.col("_high"), ["_low", "_high"]
    else:
        limits = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()  # one scan
        low, high = limits.getField("low"), limits.getField("high")
    width = (high - low) / bins
    place = F.when(width == 0, 0).otherwise(F.least(F.floor((value - low) / width), F.lit(bins - 1)))
    counts = rows.groupBy(*by, *also, place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumns({"bin_start": low + F.col("bin") * width}).drop("_low", "_high")


def shares(df: DataFrame, within: Sequence[str], item: Sequence[str], measure: Column) -> DataFrame:
    """Total per item and its share of the enclosing group."""
    totals = df.groupBy(*within, *item).agg(measure.alias("total"))
    group = totals.groupBy(*within).agg(F.sum("total").alias("group_total"))
    return (
        totals.join(group, list(within))
        .withColumn("share", F.col("total").cast("double") / F.col("group_total").cast("double"))
        .drop("group_total")
    )


def ranked_within(df: DataFrame, within: Sequence[str], item: Sequence[str], measure: Column, top: int) -> DataFrame:
    """The items with the `top` best ranks in each group; equal totals share a rank."""
    totals = df.groupBy(*within, *item).agg(measure.alias("total"))
    w = Window.partitionBy(*within).orderBy(F.desc("total"))
    return totals.withColumn("place", F.rank().over(w)).where(F.col("place") <= top)


def level_table(df: DataFrame, level: Column, value: str) -> DataFrame:
    """Rows, mean and sample deviation of a value per level."""
    return df.groupBy(level.alias("level")).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")
    )


def promotion_level(email: str | Column, featured: str | Column) -> Column:
    """none / emailer / featured / both."""
    e, f = col(email), col(featured)
    return F.when(e & f, "both").when(e, "emailer").when(f, "featured").otherwise("none")
