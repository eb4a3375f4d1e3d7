"""Quantiles per group against sorting in Python."""

import random
from collections import defaultdict
from math import ceil, inf, isnan, nan

import pytest

from millrace.operators import quantiles
from millrace.operators.aggregates import histogram
from millrace.operators.quantiles import describe_by, group_quantiles

P = (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)


def plain(data, probabilities):
    groups = defaultdict(list)
    for key, v in data:
        if v is not None and not isnan(v):
            groups[key].append(v)
    return {(k, p): sorted(vs)[max(1, ceil(round(p * len(vs), 6))) - 1] for k, vs in groups.items() for p in probabilities}


def found(df):
    return {(r["g"], r["p"]): r["value"] for r in df.collect()}


@pytest.mark.parametrize("slices", [64, 2048])
def test_any_values(spark, monkeypatch, slices):
    monkeypatch.setattr(quantiles, "SLICES", slices)
    draw = random.Random(5)
    data = [("hot", draw.gauss(1000, 1)) for _ in range(600)] + [("ties", draw.choice([1.0, 2.0, 2.0000001])) for _ in range(300)]
    data += [(f"g{draw.randrange(60)}", draw.uniform(-5, 5)) for _ in range(300)]
    data += [(None, float(i)) for i in range(7)] + [("nothing", None), ("nothing", nan), ("one", -0.0)]
    data += [("far", v) for v in (-inf, inf, inf, 1.7e308, -1.7e308, 5e-324, -5e-324, 0.0, 1e-300, nan, None)]
    df = spark.createDataFrame(data, "g string, v double")
    assert found(group_quantiles(df, ["g"], "v", P)) == plain(data, P)


def test_scale_by_scale(spark):
    """Values far apart in size share no slice for long."""
    data = [("a", 10.0**k * (1 + i * 1e-12)) for k in range(-300, 300, 20) for i in range(5)]
    df = spark.createDataFrame(data, "g string, v double")
    assert found(group_quantiles(df, ["g"], "v", P)) == plain(data, P)


def test_odd_names_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 2, 3.0), (1, 2, 5.0), (1, None, 4.0)], "_k0 int, _v int, value double")
    got = {tuple(r) for r in group_quantiles(df, ["_k0", "_v"], "value", [0.5]).collect()}
    assert got == {(1, 2, 0.5, 3.0), (1, None, 0.5, 4.0)}
    assert group_quantiles(df.limit(0), ["_v"], "value", P).count() == 0
    assert [tuple(r) for r in group_quantiles(df, [], "value", [0.5]).collect()] == [(0.5, 4.0)]


def test_description_keeps_groups_without_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", None), (None, 2.0)], "g string, v double")
    got = {r["g"]: (r["n"], r["mean"], r["low"], r["q25"], r["q50"], r["q75"], r["high"]) for r in describe_by(df, ["g"], "v").collect()}
    assert got == {"a": (2, 2.0, 1.0, 1.0, 1.0, 3.0, 3.0), "b": (0, None, None, None, None, None, None), None: (1, 2.0, 2.0, 2.0, 2.0, 2.0, 2.0)}


def test_no_task_sorts_a_group(spark):
    """Windows run over counts per slice, and no plan gathers values."""
    df = spark.range(20000).selectExpr("id % 2 AS g", "CAST(id % 9973 AS double) AS v")
    plan = group_quantiles(df, ["g"], "v", [0.5])._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "percentile" not in plan
    assert found(group_quantiles(df, ["g"], "v", [0.5])) == plain([(i % 2, float(i % 9973)) for i in range(20000)], [0.5])


def test_histogram_by_group_with_own_limits(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 10.0), ("a", 4.9), ("b", 7.0), ("b", 7.0), ("c", None)], "g string, v double")
    got = {(r["g"], r["bin"]): (r["n"], r["bin_start"]) for r in histogram(df, "v", 2, ["g"], own_limits=True).collect()}
    assert got == {("a", 0): (2, 0.0), ("a", 1): (1, 5.0), ("b", 0): (2, 7.0)}
