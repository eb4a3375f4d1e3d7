"""Group comparison and series statistics."""

from __future__ import annotations

from collections.abc import Sequence
from math import exp, lgamma, log, log1p, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_moments(df: DataFrame, level: str, value: str) -> DataFrame:
    """level, n, mean, variance: one row per level, from one aggregate."""
    return df.groupBy(F.col(level).alias("level")).agg(
        F.count(value).alias("n"),
        F.avg(F.col(value).cast("double")).alias("mean"),
        F.var_samp(F.col(value).cast("double")).alias("variance"),
    )


def anova(moments: DataFrame) -> DataFrame:
    """One-way analysis of variance from the group moments: df_between, df_within, ms_*, f.

    The moments of the levels, one small array, are read once.
    """
    row = moments.agg(
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"),
        (F.count("level") - 1).alias("df_between"),
        (F.sum("n") - F.count("level")).alias("df_within"),
        F.sum((F.col("n") - 1) * F.coalesce("variance", F.lit(0.0))).alias("within"),
        F.collect_list(F.struct("n", "mean")).alias("m"),
    )
    between = F.aggregate(
        "m", F.lit(0.0), lambda s, g: s + g["n"] * (g["mean"] - F.col("grand")) * (g["mean"] - F.col("grand"))
    )
    return row.select(
        "df_between", "df_within", (between / F.col("df_between")).alias("ms_between"),
        (F.col("within") / F.col("df_within")).alias("ms_within"),
    ).withColumn("f", F.col("ms_between") / F.col("ms_within"))


def pairwise_q(moments: DataFrame) -> DataFrame:
    """Tukey-Kramer statistic of every pair of levels: k levels give k(k-1)/2 rows.

    The k moments become one small array, and the pairs are taken from it.
    """
    row = moments.agg(
        F.count("level").alias("levels"),
        (F.sum("n") - F.count("level")).alias("degrees"),
        F.sum((F.col("n") - 1) * F.coalesce("variance", F.lit(0.0))).alias("within"),
        F.sort_array(F.collect_list(F.struct("level", "n", "mean"))).alias("m"),
    )
    pairs = F.flatten(F.transform("m", lambda a, i: F.transform(
        F.filter("m", lambda b: b["level"] > a["level"]), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    long = row.select("levels", "degrees", (F.col("within") / F.col("degrees")).alias("ms"), F.inline(pairs))
    error = F.sqrt(F.col("ms") / 2 * (1 / F.col("a.n") + 1 / F.col("b.n")))
    difference = F.col("a.mean") - F.col("b.mean")
    return long.select(
        F.col("a.level").alias("level_a"), F.col("b.level").alias("level_b"), difference.alias("difference"),
        (F.abs(difference) / error).alias("q"), "levels", "degrees",
    )


def tukey(moments: DataFrame, significance: float = 0.05) -> DataFrame:
    """Tukey's honest significant difference: the pairs with p-value and verdict."""

    @F.pandas_udf("double")
    def p_value(q: pd.Series, levels: pd.Series, degrees: pd.Series) -> pd.Series:
        return pd.Series([studentized_range_sf(*r) for r in zip(q, levels, degrees)], dtype=float)

    return pairwise_q(moments).withColumn("p_value", p_value("q", "levels", "degrees")).withColumn(
        "different", F.col("p_value") < significance
    )


def with_p_value(result: DataFrame) -> DataFrame:
    """The one-row result of `anova` with the p-value of F."""

    @F.pandas_udf("double")
    def p_value(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
        return pd.Series([f_sf(*r) for r in zip(f, d1, d2)], dtype=float)

    return result.withColumn("p_value", p_value("f", "df_between", "df_within"))


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    from math import erfc

    return np.vectorize(lambda v: 0.5 * erfc(-v / sqrt(2)))(x)


def studentized_range_sf(q: float, levels: float, degrees: float) -> float:
    """P(range of `levels` normals / independent standard deviation > q), by quadrature."""
    nodes, weights = np.polynomial.legendre.leggauss(96)
    z = 9.0 * nodes
    density = np.exp(-z * z / 2) / sqrt(2 * np.pi)
    at_z = _normal_cdf(z)

    def range_cdf(w: float) -> float:
        inner = np.clip(at_z - _normal_cdf(z - w), 0, 1) ** (levels - 1)
        return float(levels * (9.0 * weights * density * inner).sum())

    # s = chi / sqrt(degrees), integrated around its mean; its density is scaled by its own sum, so
    # that no constant has to be found from large numbers that nearly cancel.
    half = 8.0 / sqrt(2 * degrees)
    low, high = max(1e-9, 1 - half), 1 + half + 4.0 / degrees
    s = low + (nodes + 1) / 2 * (high - low)
    away = s - 1
    logs = degrees * (np.log1p(away) - away - away * away / 2) - np.log(s)
    chi = weights * np.exp(logs - logs.max())
    return max(0.0, 1 - float((chi * [range_cdf(q * v) for v in s]).sum() / chi.sum()))


def f_sf(f: float, d1: float, d2: float) -> float:
    """Upper tail of the F distribution, through the incomplete beta function."""
    return _incomplete_beta(d2 / 2, d1 / 2, d2 / (d2 + d1 * f), d1 * f / (d2 + d1 * f))


def _log_gamma_ratio(a: float, b: float) -> float:
    """log(gamma(a + b) / gamma(a)), without the loss of taking two large logarithms apart."""
    shift = 0.0
    while a < 30:
        shift += log1p(b / a)
        a += 1
    c = a + b
    series = (1 / c - 1 / a) / 12 - (1 / c**3 - 1 / a**3) / 360 + (1 / c**5 - 1 / a**5) / 1260
    return (a - 0.5) * log1p(b / a) + b * log(c) - b + series - shift


def _incomplete_beta(a: float, b: float, x: float, y: float) -> float:
    """The regularised incomplete beta function at x, where y = 1 - x."""
    if x <= 0 or y <= 0:
        return min(max(x, 0.0), 1.0)
    if x > (a + 1) / (a + b + 2):
        return 1 - _incomplete_beta(b, a, y, x)
    large, small = max(a, b), min(a, b)
    powers = a * (log1p(-y) if y < 0.5 else log(x)) + b * (log1p(-x) if x < 0.5 else log(y))
    front = exp(_log_gamma_ratio(large, small) - lgamma(small) + powers) / a
    # continued fraction, evaluated from the innermost term outwards
    value = 0.0
    for m in range(400, 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        value = even / (1 + odd / (1 + value))
    first = -(a + b) * x / (a + 1)
    return front / (1 + first / (1 + value))


def autocorrelation(df: DataFrame, series: Sequence[str], order: str, value: str, lags: int) -> DataFrame:
    """series, lag, r: correlation of each series with itself, lag by lag.

    The rows are one per series and period, so a series is as long as the calendar allows.
    """
    from pyspark.sql import Window

    whole = Window.partitionBy(*series)
    w = whole.orderBy(order)
    centred = df.select(*series, order, (F.col(value) - F.avg(value).over(whole)).alias("d"))
    products = centred.withColumns({f"p{k}": F.col("d") * F.lag("d", k).over(w) for k in range(1, lags + 1)})
    sums = products.groupBy(*series).agg(
        F.sum(F.col("d") * F.col("d")).alias("p0"), F.count("d").alias("n"),
        *[F.sum(f"p{k}").alias(f"p{k}") for k in range(1, lags + 1)],
    )
    pairs = [F.struct(F.lit(k).alias("lag"), (F.col(f"p{k}") / F.nullif("p0", F.lit(0.0))).alias("r")) for k in range(1, lags + 1)]
    return sums.select(*series, "n", F.inline(F.array(*pairs)))


def partial_autocorrelation(df: DataFrame, series: Sequence[str], order: str, value: str, lags: int) -> DataFrame:
    """series, lag, r, partial, bound, significant.

    The Durbin-Levinson recursion runs per series on its `lags` correlations; the bound is
    1.96 / sqrt(n).
    """
    acf = autocorrelation(df, series, order, value, lags)
    per_series = acf.groupBy(*series, "n").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("lag", "r"))), lambda s: s["r"]).alias("r")
    )

    @F.pandas_udf("array<double>")
    def partials(r: pd.Series) -> pd.Series:
        return r.map(durbin_levinson)

    long = per_series.withColumn("p", partials("r")).select(
        *series, "n", "r", F.posexplode("p").alias("i", "partial")
    )
    bound = F.lit(1.96) / F.sqrt("n")
    return long.select(
        *series, (F.col("i") + 1).alias("lag"), F.get("r", "i").alias("r"), "partial", bound.alias("bound"),
        (F.abs("partial") > bound).alias("significant"),
    )


def durbin_levinson(r) -> list[float]:
    """Partial autocorrelations from the autocorrelations of lags 1, 2, ..."""
    out, phi = [], np.zeros(0)
    for k in range(len(r)):
        past = np.asarray(r[:k], dtype=float)
        rest = 1 - float(phi @ past)
        step = (float(r[k]) - float(phi @ past[::-1])) / rest if rest else 0.0
        phi = np.append(phi - step * phi[::-1], step)
        out.append(step)
    return out
