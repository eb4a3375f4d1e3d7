"""Things that must not depend on the size of a table."""

import math

from pyspark.sql import functions as F

from millrace.operators import forecast, history, quantiles, stats
from millrace.queries.streams import batch_time


def test_tukey_has_one_method():
    below, above = stats.studentized_range_sf(3.4, 3, 4999), stats.studentized_range_sf(3.4, 3, 5001)
    assert abs(below - above) < 1e-6
    # Published 5 per cent points of the studentized range.
    for levels, degrees, point in ((3, 10, 3.877), (4, 20, 3.958), (5, 60, 3.977), (3, 1e9, 3.314)):
        assert abs(stats.studentized_range_sf(point, levels, degrees) - 0.05) < 2e-4


def test_f_tail():
    # Published 5 per cent points of F.
    for f, d1, d2 in ((4.10, 2, 10), (3.10, 3, 20), (2.605, 3, 1e9), (161.4, 1, 1)):
        assert abs(stats.f_sf(f, d1, d2) - 0.05) < 2e-4
    assert abs(stats.f_sf(0.5, 3, 6e11) - 0.68227) < 1e-5


def test_any_batch_has_a_time():
    assert batch_time(0) == "2025-01-01 00:00:00" and batch_time(40) == "2025-02-10 00:00:00"


def test_quantiles_take_infinities(spark):
    df = spark.createDataFrame([(float(x),) for x in ("-inf", "-1.7e308", 1, 2, 3, "1.7e308", "inf", "nan")] + [(None,)], "v double")
    found = quantiles.exact_quantiles(df, {"v": [0.0, 0.25, 0.5, 0.75, 1.0]})["v"]
    assert found == [-math.inf, -1.7e308, 2.0, 1.7e308, math.inf]
    row = quantiles.describe(df.where("v > 0 OR v IS NULL"), "v").first()
    assert row["n"] == 5 and row["q50"] == 3.0 and row["high"] == math.inf
    tiny = spark.createDataFrame([(5e-324,), (1e-323,), (1.5e-323,)], "v double")
    assert quantiles.exact_quantiles(tiny, {"v": [0.5]})["v"] == [1e-323]


def test_boosted_forecast_of_many_series(spark):
    rows = spark.range(3600).select(
        (F.col("id") % 1200).alias("s"), (F.col("id") / 1200).cast("int").alias("t"), (F.col("id") % 7).cast("double").alias("x"),
        (F.col("id") % 1200 / 10).alias("y"), (F.col("id") >= 2400).alias("test"),
    ).withColumn("x", F.when(F.col("s") > 0, F.col("x")))
    found = forecast.predict_boosted(rows, ["s"], ["x"], "y", iterations=3, depth=3)
    assert found.count() == 3600 and found.columns == [*rows.columns, "boosted"]
    assert found.where("boosted IS NULL").select("s").distinct().collect() == [(0,)]
    errors = forecast.mean_absolute_errors(found.withColumn("none", F.when(F.col("s") % 2 == 0, F.col("y"))), "y", ["boosted", "none"])
    assert {r["rows"] for r in errors.collect()} == {599}


def test_null_key_is_one_key(spark):
    first = spark.createDataFrame([(None, "a"), (1, "b")], "k int, v string")
    kept = history.snapshot(None, first, ["k"], "2025-01-01 00:00:00")
    again = history.snapshot(kept, first, ["k"], "2025-01-02 00:00:00")
    assert again.count() == 2 and again.where("valid_to IS NULL").count() == 2


