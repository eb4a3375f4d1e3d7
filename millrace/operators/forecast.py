"""Next-period forecasts for many short series."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import add_lags, moving_mean

MOVING = 3


def with_features(
    weekly: DataFrame, series: Sequence[str], order: str, value: str, lags: Sequence[int], held_out: int,
) -> DataFrame:
    """Adds lags, the moving mean of the weeks before, and `test` (the last `held_out` periods).

    `weekly` has one row per series and period.
    """
    latest_first = Window.partitionBy(*series).orderBy(F.desc(order))
    lagged = add_lags(weekly, series, order, value, lags)
    return lagged.withColumns({
        "moving": moving_mean(weekly, series, order, value, MOVING, forecast=True),
        "test": F.row_number().over(latest_first) <= held_out,
    })


def _sums(features: Sequence[str], value: str) -> list[Column]:
    """The normal equations of a least-squares fit, as aggregates over training rows."""
    columns = [F.lit(1.0), *[F.col(c).cast("double") for c in features]]
    train = ~F.col("test")
    cross = [F.sum(F.when(train, a * b)) for a in columns for b in columns]
    target = [F.sum(F.when(train, a * F.col(value).cast("double"))) for a in columns]
    return [F.array(*cross).alias("xx"), F.array(*target).alias("xy")]


def linear_fits(df: DataFrame, series: Sequence[str], features: Sequence[str], value: str) -> DataFrame:
    """series, weights: one least-squares fit per series.

    The sums are plain Spark aggregates, so the rows of a series never come together in one task;
    only the small equation system is solved in Python. A tiny ridge keeps constant columns apart.
    """
    size = len(features) + 1

    @F.pandas_udf("array<double>")
    def solve(xx: pd.Series, xy: pd.Series) -> pd.Series:
        whole = np.array([[np.nan] * size * size if a is None else a for a in xx], dtype=float).reshape(-1, size, size)
        target = np.array([[np.nan] * size if b is None else b for b in xy], dtype=float).reshape(-1, size, 1)
        sound = np.isfinite(whole).all(axis=(1, 2)) & np.isfinite(target).all(axis=(1, 2))
        out = np.full(len(whole), None, dtype=object)
        if sound.any():
            found = np.linalg.solve(whole[sound] + 1e-8 * np.eye(size), target[sound])
            for row, weights in zip(np.flatnonzero(sound), found[:, :, 0]):
                out[row] = weights.tolist()
        return pd.Series(out)

    usable = df.dropna(subset=list(features))
    return usable.groupBy(*series).agg(*_sums(features, value)).select(*series, solve("xx", "xy").alias("weights"))


def predict_linear(df: DataFrame, fits: DataFrame, series: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Adds `linear`, the fitted value."""
    joined = df.join(fits, list(series), "left")
    value = F.get("weights", F.lit(0))
    for i, c in enumerate(features, 1):
        value = value + F.get("weights", F.lit(i)) * F.col(c).cast("double")
    return joined.withColumn("linear", value).drop("weights")


def predict_boosted(
    df: DataFrame, series: Sequence[str], features: Sequence[str], value: str, iterations: int = 20, depth: int = 4
) -> DataFrame:
    """Adds `boosted`: boosted trees fitted on the training rows of all series together.

    A series is known to the trees by the mean and the number of its training rows, so that any
    number of series will do. Every row is kept; `boosted` is null where a feature is null.
    """
    known = df.where(~F.col("test")).groupBy(*series).agg(F.avg(value).alias("_mean"), F.count(value).cast("double").alias("_rows"))
    numbers = {f"_f{i}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for i, c in enumerate(features)}
    rows = df.join(known, list(series), "left").fillna(0.0, ["_mean", "_rows"]).withColumns(numbers)
    usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in features], F.lit(True))
    stages = [
        VectorAssembler(inputCols=["_mean", "_rows", *numbers], outputCol="_features"),
        GBTRegressor(featuresCol="_features", labelCol=value, predictionCol="_boosted", maxIter=iterations, maxDepth=depth, seed=10),
    ]
    model = Pipeline(stages=stages).fit(rows.where(usable & ~F.col("test") & F.col(value).isNotNull()))
    found = model.transform(rows).withColumn("boosted", F.when(usable, F.col("_boosted")))
    return found.drop("_features", "_boosted", "_mean", "_rows", *numbers)


def mean_absolute_errors(df: DataFrame, value: str, models: Sequence[str]) -> DataFrame:
    """model, mae, rows over the held-out periods for which every model has a value."""
    pairs = [F.struct(F.lit(m).alias("model"), F.abs(F.col(m) - F.col(value)).alias("error")) for m in models]
    long = df.where("test").dropna(subset=[value, *models]).select(F.inline(F.array(*pairs)))
    return long.groupBy("model").agg(F.avg("error").alias("mae"), F.count("error").alias("rows"))


def next_period(weekly: DataFrame, series: Sequence[str], order: str, value: str, size: int = MOVING) -> DataFrame:
    """The forecast for the period after the last one of each series: the mean of its last rows."""
    w = Window.partitionBy(*series).orderBy(F.desc(order))
    last = weekly.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= size)
    return last.groupBy(*series).agg(F.avg(value).alias("forecast"), F.max(order).alias("last_period"))
