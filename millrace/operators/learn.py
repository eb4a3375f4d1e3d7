"""Classification on tables with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from . import many

SEED = 10
FOLDS = 10


def binary_code(df: DataFrame, column: str, name: str) -> DataFrame:
    """0 / 1 code of a two-valued column, in alphabetical order; null stays null."""
    first = df.agg(F.min(column)).scalar()
    return df.withColumn(name, F.when(F.col(column).isNotNull(), (F.col(column) != first).cast("int")))


def encoder(categorical: Sequence[str], numeric: Sequence[str], name: str = "features") -> list:
    """Stages that make one vector: one-hot without the alphabetically first value, then numbers.

    The order of the index is descending, because the encoder drops the last one. Fill nulls first.
    """
    stages = []
    for c in categorical:
        stages += [
            StringIndexer(inputCol=c, outputCol=f"{c}_index", stringOrderType="alphabetDesc"),
            OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_hot", dropLast=True),
        ]
    stages.append(VectorAssembler(inputCols=[f"{c}_hot" for c in categorical] + list(numeric), outputCol=name))
    return stages


def scaler(source: str = "features", name: str = "scaled") -> StandardScaler:
    """Mean zero and sample deviation one."""
    return StandardScaler(inputCol=source, outputCol=name, withMean=True, withStd=True)


def logistic(features: str = "scaled", label: str = "label", rows: int | None = None) -> LogisticRegression:
    """Logistic regression, at most 100 steps.

    With the number of training rows it carries a unit L2 penalty on the summed loss, the usual
    default of single-machine libraries.
    """
    return LogisticRegression(featuresCol=features, labelCol=label, regParam=1 / rows if rows else 0.0, tol=1e-4)


def boosted(features: str = "scaled", label: str = "label", **settings) -> GBTClassifier:
    return GBTClassifier(featuresCol=features, labelCol=label, seed=SEED, **settings)


def _kept(df: DataFrame) -> DataFrame:
    """The rows of many passes, cached. Cut the lineage of rows that are expensive to make again first."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def fold_rows(rows: int, folds: int = FOLDS) -> int:
    """Rows that a fold trains on."""
    return max(1, rows * (folds - 1) // folds)


def cross_validate(
    df: DataFrame, estimators: Mapping[str, Estimator], folds: int = FOLDS, label: str = "label", parallel: int = 8,
) -> DataFrame:
    """model, accuracy, deviation over shuffled folds; one row per estimator.

    The rows are cached while the folds are fitted. Any Spark estimator will do; `many.cross_validate`
    fits logistic regressions and boosted trees with eliminations in far fewer jobs.
    """
    rows = []
    for name, estimator in estimators.items():
        mean, deviation = _fold_scores(df, estimator, [{}], folds, label, parallel)
        rows.append((name, mean[0], deviation[0]))
    return df.sparkSession.createDataFrame(rows, "model string, accuracy double, deviation double")


def _accuracy(model, rows: DataFrame, label: str) -> float:
    """Share of rows whose label a fitted model or pipeline predicts; 0 without rows.

    A linear model is applied as a column, from its coefficients.
    """
    *before, last = model.stages if isinstance(model, PipelineModel) else [model]
    for stage in before:
        rows = stage.transform(rows)
    if hasattr(last, "coefficients"):
        weights = F.array(*[F.lit(float(w)) for w in last.coefficients.toArray()])
        products = F.zip_with(vector_to_array(last.getFeaturesCol()), weights, lambda x, w: x * w)
        margin = F.aggregate(products, F.lit(float(last.intercept)), lambda total, x: total + x)
        prediction = (margin > 0).cast("double")
    else:
        rows = last.transform(rows)
        prediction = F.col(last.getPredictionCol())
    return rows.agg(F.avg((prediction == F.col(label)).cast("double"))).first()[0] or 0.0


def _fold_scores(df, estimator, params, folds, label, parallel):
    """Mean and deviation over the folds of the accuracy of each of `params`."""
    dealt = _kept(df.withColumn("_fold", F.floor(F.rand(SEED) * folds)))

    def score(job):
        fold, setting = job
        test = dealt.where(F.col("_fold") == fold).drop("_fold")
        if test.isEmpty():
            return None
        return _accuracy(estimator.fit(dealt.where(F.col("_fold") != fold).drop("_fold"), setting), test, label)

    try:
        with ThreadPool(parallel) as pool:
            found = pool.map(score, [(fold, setting) for setting in params for fold in range(folds)], chunksize=1)
    finally:
        dealt.unpersist()
    each = [[s for s in found[i * folds : (i + 1) * folds] if s is not None] for i in range(len(params))]
    return [float(np.mean(s)) for s in each], [float(np.std(s)) for s in each]


def _weights(model) -> list[float]:
    """How much each feature counts in a fitted model."""
    found = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    return [abs(float(w)) for w in found.toArray()]


def _eliminate(train: DataFrame, test: DataFrame | None, job, size: int, label: str) -> list[tuple[list[int], float, int]]:
    """(features left, accuracy on `test`, the weakest of them), from all features down to one.

    `job(features)` is the pipeline of these features; its last stage is the classifier.
    """
    left, steps = list(range(size)), []
    while left:
        model = job(left).fit(train)
        weights = _weights(model.stages[-1])
        weakest = left[min(range(len(left)), key=lambda i: (weights[i], i))]
        steps.append((left, _accuracy(model, test, label) if test is not None else 0.0, weakest))
        left = [i for i in left if i != weakest]
    return steps


def _elimination(df: DataFrame, job, size: int, label: str, folds: int, parallel: int):
    """The steps on all rows, the mean accuracy of each number of features, and the best number.

    Every fold eliminates on its own training rows, so no row takes part in the choice it is measured on.
    """
    kept = _kept(df.withColumn("_fold", F.floor(F.rand(SEED) * folds)))

    def fold(i):
        test = kept.where(F.col("_fold") == i)
        return [] if test.isEmpty() else [s[1] for s in _eliminate(kept.where(F.col("_fold") != i), test, job, size, label)]

    try:
        with ThreadPool(parallel) as pool:
            scores = [s for s in pool.map(fold, range(folds)) if s]
        steps = _eliminate(kept, None, job, size, label)
    finally:
        kept.unpersist()
    accuracy = [sum(s[k] for s in scores) / len(scores) for k in range(size)]
    best = max(range(size), key=lambda k: (accuracy[k], k))  # the later step has fewer features
    return steps, accuracy, best


class Elimination(Estimator):
    """Recursive elimination as a stage: fitted on the rows it is given, it keeps the chosen entries of a vector.

    `classifier` reads the column `output`; it ranks the features and is measured over `folds`.
    """

    def __init__(self, classifier: Estimator, source: str = "scaled", output: str = "chosen", label: str = "label", folds: int = FOLDS, parallel: int = 1):
        super().__init__()
        self.classifier, self.source, self.output = classifier, source, output
        self.label, self.folds, self.parallel = label, folds, parallel

    def _slicer(self, indices: list[int]) -> VectorSlicer:
        return VectorSlicer(inputCol=self.source, outputCol=self.output, indices=indices)

    def _fit(self, dataset: DataFrame) -> VectorSlicer:
        rows = dataset.select(self.label, self.source)
        size = rows.first()[self.source].size
        steps, _, best = _elimination(
            rows, lambda left: Pipeline(stages=[self._slicer(left), self.classifier]), size, self.label, self.folds, self.parallel
        )
        return self._slicer(steps[best][0])


def eliminate_features(df: DataFrame, names: Sequence[str], features: str = "features", label: str = "label", folds: int = FOLDS) -> DataFrame:
    """Recursive elimination: n_features, accuracy, dropped, features, chosen.

    The weakest coefficient on standardised data goes in each step; the number of features with the
    best accuracy is chosen (the smaller number, if two are equal). Every fold eliminates on its
    training rows alone, all folds at once. `features` is a vector column with the given names.
    """
    (steps, _), = many.eliminate_logistic(many.dealt(df, features, label, folds, outer=False), folds).values()
    best = many.best_step(steps)
    found = [
        (len(s.features), float(np.mean(s.accuracy)), names[s.weakest], [names[i] for i in s.features], k == best) for k, s in enumerate(steps)
    ]
    schema = "n_features int, accuracy double, dropped string, features array<string>, chosen boolean"
    return df.sparkSession.createDataFrame(found, schema)


def _shared(estimator: Estimator, grid: Mapping[object, Sequence]) -> tuple[GBTClassifier, GBTClassifier] | None:
    """(ranks, final) of scaled features, an elimination with boosted trees and boosted trees on what is left.

    Only where the grid changes nothing but the rounds, rate and depth of the last stage.
    """
    stages = estimator.getStages() if isinstance(estimator, Pipeline) else []
    kinds = [type(s) for s in stages]
    if kinds != [StandardScaler, Elimination, GBTClassifier] or not isinstance(stages[1].classifier, GBTClassifier):
        return None
    last = stages[2]
    if stages[1].output != last.getFeaturesCol() or any(p not in (last.maxIter, last.stepSize, last.maxDepth) for p in grid):
        return None
    return stages[1].classifier, last


def _trees(model: GBTClassifier, **changed) -> many.Trees:
    value = lambda p: changed.get(p.name, model.getOrDefault(p))
    return many.Trees(value(model.maxIter), value(model.stepSize), value(model.maxDepth))


def random_search(
    df: DataFrame, estimator: Estimator, grid: Mapping[object, Sequence], tries: int, folds: int = FOLDS,
    label: str = "label", parallel: int = 8, seed: int = SEED,
) -> DataFrame:
    """settings, accuracy, deviation, best for a random sample of a parameter grid.

    Where only the boosted trees at the end of a pipeline vary, the features are chosen once per fold
    for all settings, and all fits of all folds are made side by side (`many`).
    """
    import random

    draw = random.Random(seed)
    chosen, seen = [], set()
    size = 1
    for values in grid.values():
        size *= len(values)
    while len(chosen) < min(tries, size):
        pick = tuple(draw.randrange(len(v)) for v in grid.values())
        if pick not in seen:
            seen.add(pick)
            chosen.append({p: v[i] for (p, v), i in zip(grid.items(), pick)})
    shared = _shared(estimator, grid)
    if shared:
        ranks, last = shared
        rows = many.dealt(df, estimator.getStages()[0].getInputCol(), label, folds)
        settings = [_trees(last, **{p.name: v for p, v in s.items()}) for s in chosen]
        scores = many.boosted_accuracy(*many.choose_boosted(rows, estimator.getStages()[1].folds, _trees(ranks)), settings)
        means, deviations = [float(np.mean(s)) for s in scores], [float(np.std(s)) for s in scores]
    else:
        means, deviations = _fold_scores(df, estimator, chosen, folds, label, parallel)
    best = max(range(len(means)), key=lambda i: (means[i], -i))
    rows = [
        (", ".join(f"{p.name}={v}" for p, v in s.items()), means[i], deviations[i], i == best)
        for i, s in enumerate(chosen)
    ]
    return _frame(df.sparkSession, rows)


def _frame(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame(rows, "settings string, accuracy double, deviation double, best boolean")
