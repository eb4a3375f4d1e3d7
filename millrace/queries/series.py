"""Time series: smoothing, lags, correlation, group comparison, forecasts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import week_start
from ..functions.numbers import exact_mean, exact_sum
from ..operators import forecast, stats
from ..operators.lookups import left_lookup
from ..operators.windows import add_lags, moving_mean
from .base import Inputs, query

DAILY = """
d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
"""


def daily(t: Inputs):
    return t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("moving_average", f"""
WITH {DAILY}
SELECT event_type, day, n,
  CASE WHEN count(n) OVER f = 3 THEN CAST(sum(n) OVER f AS DOUBLE) / 3 END AS forecast,
  CASE WHEN count(n) OVER s = 3 THEN CAST(sum(n) OVER s AS DOUBLE) / 3 END AS smooth
FROM d WINDOW f AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
  s AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""")
def moving_average(t: Inputs):
    d = daily(t)
    series = (["event_type"], "day", "n", 3)
    return d.withColumns({"forecast": moving_mean(d, *series, True), "smooth": moving_mean(d, *series, False)})


@query("lag_features", f"""
WITH {DAILY}
SELECT *, lag(n, 1) OVER w AS n_lag1, lag(n, 2) OVER w AS n_lag2, lag(n, 7) OVER w AS n_lag7 FROM d
WINDOW w AS (PARTITION BY event_type ORDER BY day)""")
def lag_features(t: Inputs):
    return add_lags(daily(t), ["event_type"], "day", "n", [1, 2, 7])


@query("autocorrelation", f"""
WITH {DAILY},
c AS (SELECT event_type, day, n - avg(n) OVER (PARTITION BY event_type) AS x FROM d),
l AS (SELECT event_type, x, k, lag(x, k) OVER (PARTITION BY event_type, k ORDER BY day) AS y FROM c, (SELECT unnest([1, 2, 3, 4]) AS k))
SELECT event_type, count(x) AS n, CAST(k AS INTEGER) AS lag, round(sum(x * y) / sum(x * x), 8) AS r FROM l GROUP BY event_type, k""")
def autocorrelation(t: Inputs):
    return stats.autocorrelation(daily(t), ["event_type"], "day", "n", 4).withColumn("r", F.round("r", 8))


@query("pacf", f"""
WITH {DAILY},
c AS (SELECT event_type, day, n - avg(n) OVER (PARTITION BY event_type) AS x FROM d),
l AS (SELECT event_type, x, lag(x, 1) OVER w AS y1, lag(x, 2) OVER w AS y2 FROM c WINDOW w AS (PARTITION BY event_type ORDER BY day)),
r AS (SELECT event_type, count(*) AS n, sum(x * y1) / sum(x * x) AS r1, sum(x * y2) / sum(x * x) AS r2 FROM l GROUP BY 1),
p AS (SELECT event_type, n, 1 AS lag, r1 AS r, r1 AS partial FROM r UNION ALL
  SELECT event_type, n, 2, r2, (r2 - r1 * r1) / (1 - r1 * r1) FROM r)
SELECT event_type, lag, round(r, 8) AS r, round(partial, 8) AS partial, round(1.96 / sqrt(n), 8) AS bound,
  abs(partial) > 1.96 / sqrt(n) AS significant FROM p""")
def pacf(t: Inputs):
    out = stats.partial_autocorrelation(daily(t), ["event_type"], "day", "n", 2)
    return out.withColumns({c: F.round(c, 8) for c in ("r", "partial", "bound")})


@query("pacf_lags")
def pacf_lags(t: Inputs):
    """Eight lags of the weekly order numbers of each priority."""
    weekly = t.orders.groupBy("o_orderpriority", week_start("o_orderdate").alias("week")).agg(F.count(F.lit(1)).alias("n"))
    return stats.partial_autocorrelation(weekly, ["o_orderpriority"], "week", "n", 8)


LEVEL = """CASE WHEN l_discount > 0.05 AND l_tax > 0.04 THEN 'both' WHEN l_discount > 0.05 THEN 'emailer'
  WHEN l_tax > 0.04 THEN 'featured' ELSE 'none' END"""
MOMENTS = f"""
m AS (SELECT {LEVEL} AS level, count(*) AS n, avg(l_quantity) AS mean, var_samp(l_quantity) AS v FROM lineitem GROUP BY 1),
t AS (SELECT count(*) AS k, sum(n)::BIGINT AS rows, sum(n * mean) / sum(n) AS grand, sum((n - 1) * v) AS w FROM m)
"""


def promotion_moments(t: Inputs):
    from ..operators.aggregates import promotion_level

    lines = t.lineitem.select(
        promotion_level(F.col("l_discount") > 0.05, F.col("l_tax") > 0.04).alias("promotion"), "l_quantity"
    )
    return stats.group_moments(lines, "promotion", "l_quantity")


@query("anova", f"""
WITH {MOMENTS},
b AS (SELECT sum(n * (mean - grand) * (mean - grand)) AS s FROM m, t)
SELECT k - 1 AS df_between, rows - k AS df_within, round(s / (k - 1), 5) AS ms_between, round(w / (rows - k), 5) AS ms_within,
  round((s / (k - 1)) / (w / (rows - k)), 5) AS f FROM t, b""")
def anova(t: Inputs):
    return stats.anova(promotion_moments(t)).withColumns({c: F.round(c, 5) for c in ("ms_between", "ms_within", "f")})


@query("tukey_statistics", f"""
WITH {MOMENTS}
SELECT a.level AS level_a, b.level AS level_b, round(a.mean - b.mean, 6) AS difference,
  round(abs(a.mean - b.mean) / sqrt(w / (rows - k) / 2 * (1 / a.n + 1 / b.n)), 5) AS q
FROM m a JOIN m b ON a.level < b.level, t""")
def tukey_statistics(t: Inputs):
    return stats.pairwise_q(promotion_moments(t)).select(
        "level_a", "level_b", F.round("difference", 6).alias("difference"), F.round("q", 5).alias("q"))


@query("tukey")
def tukey(t: Inputs):
    return stats.tukey(promotion_moments(t))


@query("anova_p_value")
def anova_p_value(t: Inputs):
    return stats.with_p_value(stats.anova(promotion_moments(t)))


SERIES = ["s_nationkey", "p_type"]
FEATURES = ["quantity_lag1", "quantity_lag2", "discount", "emailer", "featured"]


def weekly_demand(t: Inputs):
    """Quantity, mean discount and promotion flags per nation, category and week."""
    placed = left_lookup(t.lineitem, t.part, {"p_partkey": "l_partkey"}, {"p_type": "p_type"})
    placed = left_lookup(placed, t.supplier, {"s_suppkey": "l_suppkey"}, {"s_nationkey": "s_nationkey"})
    return placed.groupBy(*SERIES, week_start("l_shipdate").alias("week")).agg(
        exact_sum("l_quantity").cast("double").alias("quantity"), exact_mean("l_discount").alias("discount"),
        F.max((F.col("l_discount") > 0.05).cast("int")).alias("emailer"),
        F.max((F.col("l_tax") > 0.04).cast("int")).alias("featured"),
    )


WEEKLY = """
w AS (SELECT s_nationkey, p_type, CAST(date_trunc('week', l_shipdate) AS DATE) AS week, CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS quantity
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
"""


@query("forecast_moving_average", f"""
WITH {WEEKLY},
f AS (SELECT *, avg(quantity) OVER p AS moving, count(*) OVER p AS c, row_number() OVER (PARTITION BY s_nationkey, p_type ORDER BY week DESC) AS r
  FROM w WINDOW p AS (PARTITION BY s_nationkey, p_type ORDER BY week ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING))
SELECT 'moving' AS model, round(avg(abs(moving - quantity)), 6) AS mae, count(moving) AS rows FROM f WHERE r <= 8 AND c = 3""")
def forecast_moving_average(t: Inputs):
    rows = forecast.with_features(weekly_demand(t), SERIES, "week", "quantity", [1], 8)
    return forecast.mean_absolute_errors(rows, "quantity", ["moving"]).withColumn("mae", F.round("mae", 6))


@query("forecast_next_week", f"""
WITH {WEEKLY},
f AS (SELECT *, row_number() OVER (PARTITION BY s_nationkey, p_type ORDER BY week DESC) AS r FROM w)
SELECT s_nationkey, p_type, round(avg(quantity), 6) AS forecast, max(week) AS last_period FROM f WHERE r <= 3 GROUP BY ALL""")
def forecast_next_week(t: Inputs):
    return forecast.next_period(weekly_demand(t), SERIES, "week", "quantity").withColumn("forecast", F.round("forecast", 6))


@query("forecast_mae")
def forecast_mae(t: Inputs):
    """Held-out error of the moving mean, one linear fit per series, and boosted trees over all series."""
    rows = forecast.with_features(weekly_demand(t), SERIES, "week", "quantity", [1, 2], 8)
    fits = forecast.linear_fits(rows, SERIES, FEATURES, "quantity")
    rows = forecast.predict_linear(rows, fits, SERIES, FEATURES)
    rows = forecast.predict_boosted(rows, SERIES, FEATURES, "quantity")
    return forecast.mean_absolute_errors(rows, "quantity", ["moving", "linear", "boosted"])


@query("forecast_linear", f"""
WITH l AS (SELECT s_nationkey, p_type, CAST(date_trunc('week', l_shipdate) AS DATE) AS week,
    CAST(sum(CAST(l_quantity AS DECIMAL(18, 2))) AS DOUBLE) AS y
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL),
f AS (SELECT *, lag(y) OVER (PARTITION BY s_nationkey, p_type ORDER BY week) AS x,
    row_number() OVER (PARTITION BY s_nationkey, p_type ORDER BY week DESC) <= 8 AS test FROM l)
SELECT s_nationkey, p_type, round(regr_intercept(y, x), 3) AS intercept, round(regr_slope(y, x), 3) AS slope
FROM f WHERE NOT test GROUP BY ALL""")
def forecast_linear(t: Inputs):
    """The least-squares fit of each series on the week before."""
    rows = forecast.with_features(weekly_demand(t), SERIES, "week", "quantity", [1], 8)
    fits = forecast.linear_fits(rows, SERIES, ["quantity_lag1"], "quantity")
    return fits.select(*SERIES, F.round(F.get("weights", F.lit(0)), 3).alias("intercept"),
                       F.round(F.get("weights", F.lit(1)), 3).alias("slope"))
