"""Many models in one pass against one model at a time."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.operators import learn, many


def labelled(spark, n=240, noise=0.6):
    draw = random.Random(5)
    rows = []
    for i in range(n):
        y = float(i % 2)
        rows.append((y, Vectors.dense([y + draw.gauss(0, noise), draw.gauss(0, 1), float(draw.random() < 0.3 + 0.3 * y), 100 + draw.gauss(0, 5)])))
    return spark.createDataFrame(rows, ["label", "features"]).repartition(3)


@pytest.fixture(scope="module")
def rows(spark):
    return many.dealt(labelled(spark), folds=4)


def test_weights_are_those_of_one_regression(spark, rows):
    fits = [many.Fit(-1, -1), many.Fit(2, -1), many.Fit(2, 3)]
    left = [[0, 1, 2, 3], [0, 2, 3], [0, 1, 2, 3]]
    scales = many._scales(rows, 4)
    weights = many.logistic_weights(rows, fits, left, scales)
    for fit, features, found in zip(fits, left, weights):
        mean, deviation = scales[fit.outer]
        train = rows.where((F.col("outer") != fit.outer) & (F.col("inner") != fit.inner))
        scaled = train.select("label", *[((F.get("x", F.lit(i)) - float(mean[i])) / float(deviation[i])).alias(f"f{i}") for i in features])
        vectors = VectorAssembler(inputCols=[f"f{i}" for i in features], outputCol="v").transform(scaled)
        model = LogisticRegression(featuresCol="v", regParam=1 / train.count(), standardization=False, tol=1e-12, maxIter=500).fit(vectors)
        assert np.allclose(found[[f + 1 for f in features]], model.coefficients.toArray(), atol=1e-3)
        assert abs(found[0] - model.intercept) < 1e-3
        assert all(found[j + 1] == 0 for j in range(4) if j not in features)


def test_scales_are_those_of_the_training_rows(spark, rows):
    for fold, (mean, deviation) in many._scales(rows, 4).items():
        x = np.array([r.x for r in rows.where(F.col("outer") != fold).collect()])
        assert np.allclose(mean, x.mean(axis=0)) and np.allclose(deviation, x.std(axis=0, ddof=1))


def test_hits_are_counted_in_the_fold_left_out(spark, rows):
    fits = [many.Fit(1, -1), many.Fit(1, 0)]
    scales = many._scales(rows, 4)
    weights = many.logistic_weights(rows, fits, [[0, 1, 2, 3]] * 2, scales)
    mean, deviation = scales[1]
    for (hits, n), w, where in zip(many._hits(rows, fits, weights, scales), weights, ["outer = 1", "outer <> 1 AND inner = 0"]):
        test = rows.where(where).collect()
        right = sum((w[0] + ((np.array(r.x) - mean) / deviation) @ w[1:] > 0) == (r.label == 1) for r in test)
        assert (hits, n) == (right, len(test))


def plain_boost(x, y, rounds, rate, depth):
    """Row by row, every cut of every feature tried."""
    f = np.full(len(y), math.log(sum(y) / (len(y) - sum(y))))
    gains = np.zeros(x.shape[1])

    def grow(at, residual, curve, level, step):
        best = (1e-9, None)
        if level < depth:
            for j in range(x.shape[1]):
                for cut in sorted(set(x[at, j]))[:-1]:
                    low, high = at[x[at, j] <= cut], at[x[at, j] > cut]
                    gain = residual[low].sum() ** 2 / len(low) + residual[high].sum() ** 2 / len(high) - residual[at].sum() ** 2 / len(at)
                    if gain > best[0] + 1e-12:
                        best = (gain, (j, low, high))
        if best[1] is None:
            step[at] = residual[at].sum() / curve[at].sum()
        else:
            j, low, high = best[1]
            gains[j] += best[0]
            grow(low, residual, curve, level + 1, step)
            grow(high, residual, curve, level + 1, step)

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        step = np.zeros(len(y))
        grow(np.arange(len(y)), y - p, p * (1 - p), 0, step)
        f = f + rate * step
    return f, gains


def test_boosting_on_counts_is_boosting_on_rows():
    draw = np.random.default_rng(2)
    x = draw.integers(0, 6, (150, 3))
    y = (x[:, 0] + x[:, 1] * 0.5 + draw.normal(0, 1.2, 150) > 3.7).astype(float)
    want, want_gains = plain_boost(x, y, 6, 0.3, 3)
    bins, at = np.unique(x, axis=0, return_inverse=True)
    n1 = np.bincount(at.ravel(), y, len(bins))
    n0 = np.bincount(at.ravel(), 1 - y, len(bins))
    margin, gains = many.boost(bins, n0, n1, 6, [0, 1, 2], many.Trees(6, 0.3, 3))
    assert np.allclose(margin[at.ravel()], want) and np.allclose(gains, want_gains)
    only, some = many.boost(bins, n0, n1, 6, [1], many.Trees(6, 0.3, 3))
    assert some[0] == some[2] == 0 and len(set(np.round(only, 9))) <= 6


def test_cells_hold_every_row(spark, rows):
    counted, width = many.cells(rows)
    assert counted.agg(F.sum("n0"), F.sum("n1")).first() == (120, 120) and 2 <= width <= many.MOST_BINS
    assert [len({r.bins[i] for r in counted.collect()}) for i in range(4)] == [width, width, 2, width]
    shares = many._share_out(counted, [0, 1, 2, 3], [-1, 0, 1, 2, 3])
    for r in shares.groupBy("fold", "part", "test").agg(F.sum(F.col("n0") + F.col("n1")).alias("n")).collect():
        if r.part < 0:
            want = rows.where((F.col("outer") == r.fold) == F.lit(r.test)).count()
        else:
            want = rows.where((F.col("outer") != r.fold) & ((F.col("inner") == r.part) == F.lit(r.test))).count()
        assert r.n == want


def test_bins_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(many, "CELLS", 64)
    wide = many.dealt(labelled(spark), folds=3)
    counted, width = many.cells(wide)
    assert width == 3 and counted.select("bins").distinct().count() <= 2 * 3**3


def test_elimination_keeps_what_tells_the_labels(spark, rows):
    counted, width = many.cells(rows)
    for steps in [many.eliminate_logistic(rows, 4, [0, 1])[0][0], many.eliminate_boosted(counted, width, 4, [0, 1], many.Trees(20))[0]]:
        assert [len(s.features) for s in steps] == [4, 3, 2, 1] and steps[-1].features == (0,)
        assert all(len(s.accuracy) == 4 for s in steps)


def test_cross_validation(spark):
    found = {r.model: r for r in many.cross_validate(labelled(spark, noise=0.25), folds=3, trees=many.Trees(20)).collect()}
    assert set(found) == {"logistic", "boosted"} and all(r.accuracy > 0.9 and r.deviation < 0.1 for r in found.values())
    assert many.cross_validate(labelled(spark).limit(0)).isEmpty()


def test_search_shares_the_choice_of_features(spark, monkeypatch):
    """One elimination per fold, whatever the number of settings."""
    calls = []
    whole = many.eliminate_boosted
    monkeypatch.setattr(many, "eliminate_boosted", lambda *a, **b: calls.append(a) or whole(*a, **b))
    model = learn.boosted("chosen")
    job = learn.Pipeline(stages=[learn.scaler(), learn.Elimination(learn.boosted("chosen", maxIter=10, maxDepth=2), folds=3), model])
    assert isinstance(job.getStages()[0], StandardScaler)
    found = learn.random_search(labelled(spark), job, {model.maxIter: [5, 10, 20], model.maxDepth: [1, 2]}, tries=4, folds=3).collect()
    assert len(found) == 4 and len(calls) == 1 and sum(r.best for r in found) == 1
    assert all("maxIter=" in r.settings and r.accuracy > 0.6 for r in found)
