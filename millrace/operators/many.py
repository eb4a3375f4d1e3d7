"""Many small classifiers over one table: folds, settings and elimination steps share every pass.

Rows are dealt to outer folds (what a model is measured on) and inner folds (what its features are
chosen on). A model is a column of such a pass and never a Spark job of its own:

* Logistic regressions take Newton steps together; one aggregate sums the equations of all models.
* Boosted trees see binned features only, so rows are first counted by bin, label and folds. The counts are
  all the trees need, and their number is bounded by the bins, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

FOLDS = 10
SEED = 10
# Bins of all features together make at most about this many combinations; no feature has more than MOST_BINS.
CELLS = 1 << 20
MOST_BINS = 32
RIDGE = 1.0
STEPS = 25


class Fit(NamedTuple):
    """Trained on the rows outside these folds; -1 leaves no row out."""

    outer: int
    inner: int


class Step(NamedTuple):
    """One step of an elimination: the features left, the weakest of them, accuracy by inner fold."""

    features: tuple[int, ...]
    weakest: int
    accuracy: list[float]


def dealt(df: DataFrame, features: str = "features", label: str = "label", folds: int = FOLDS, outer: bool = True) -> DataFrame:
    """label, x, outer, inner: the rows of `df` dealt to shuffled folds, checkpointed."""
    x = vector_to_array(features)
    return cut_lineage(df.select(
        F.col(label).cast("double").alias("label"), x.alias("x"),
        (F.floor(F.rand(SEED) * folds).cast("int") if outer else F.lit(-2)).alias("outer"), F.floor(F.rand(SEED + 1) * folds).cast("int").alias("inner"),
    ))


def _size(rows: DataFrame) -> int:
    return len(rows.first()["x"])


def best_step(steps: Sequence[Step]) -> int:
    """The step of the best mean accuracy; the later one, with fewer features, of two alike."""
    means = [np.mean(s.accuracy) if s.accuracy else 0.0 for s in steps]
    return max(range(len(steps)), key=lambda k: (means[k], k))


# Logistic regressions


def _scales(rows: DataFrame, size: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and sample deviation of every feature over the rows outside each outer fold (-1: all rows)."""
    x = [F.get("x", F.lit(i)) for i in range(size)]
    centre = np.array(rows.agg(*[F.avg(c) for c in x]).first(), dtype=float)
    moved = [c - F.lit(float(m)) for c, m in zip(x, centre)]
    found = rows.groupBy("outer").agg(F.count("*"), *[F.sum(c) for c in moved], *[F.sum(c * c) for c in moved]).collect()
    parts = {r[0]: np.array(r[1:], dtype=float) for r in found}
    whole = sum(parts.values())
    out = {}
    for fold, left_out in [(-1, 0.0), *parts.items()]:
        n, s, q = np.split(whole - left_out, [1, 1 + size])
        mean = s / np.maximum(n, 1)
        deviation = np.sqrt(np.maximum(q - n * mean**2, 0) / np.maximum(n - 1, 1))
        out[fold] = centre + mean, np.where(deviation > 0, deviation, 1.0)
    return out


def _arrays(batches: Iterator[pa.RecordBatch], size: int):
    for batch in batches:
        x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        yield x, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "outer", "inner"))


def _by_outer(fits: Sequence[Fit]) -> dict[int, np.ndarray]:
    return {o: np.array([i for i, f in enumerate(fits) if f.outer == o]) for o in sorted({f.outer for f in fits})}


def _equations(rows: DataFrame, fits: Sequence[Fit], weights: np.ndarray, scales) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and Hessian of every fit's log loss at its weights, from one pass over the rows."""
    size = weights.shape[1] - 1
    a, b = np.triu_indices(size + 1)
    groups, inner = _by_outer(fits), np.array([f.inner for f in fits])
    names = [f"v{i}" for i in range(len(a) + size + 1)]

    def work(batches):
        total = np.zeros((len(fits), len(names)))
        for x, label, at_outer, at_inner in _arrays(batches, size):
            for fold, mine in groups.items():
                mean, deviation = scales.get(fold, scales[-1])
                z = np.hstack([np.ones((len(x), 1)), (x - mean) / deviation])
                chance = 1 / (1 + np.exp(-np.clip(z @ weights[mine].T, -500, 500)))
                used = (at_outer != fold)[:, None] & (at_inner[:, None] != inner[mine])
                total[mine, : len(a)] += (used * chance * (1 - chance)).T @ (z[:, a] * z[:, b])
                total[mine, len(a) :] += (used * (label[:, None] - chance)).T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(len(fits)), pa.int32()), *map(pa.array, total.T.copy())], names=["fit", *names])

    sums = rows.mapInArrow(work, "fit int, " + ", ".join(f"{n} double" for n in names))
    found = np.zeros((len(fits), len(names)))
    for r in sums.groupBy("fit").agg(*[F.sum(n) for n in names]).collect():
        found[r[0]] = r[1:]
    hessian = np.zeros((len(fits), size + 1, size + 1))
    hessian[:, a, b] = hessian[:, b, a] = found[:, : len(a)]
    return found[:, len(a) :], hessian


def logistic_weights(rows: DataFrame, fits: Sequence[Fit], left: Sequence[Sequence[int]], scales, start: np.ndarray | None = None) -> np.ndarray:
    """Weights (intercept first, zero for features not in `left`) on standardised features, one row per fit.

    Unit L2 penalty on the summed loss, none on the intercept. All fits step together until they stand still.
    """
    size = len(scales[-1][0])
    weights = np.zeros((len(fits), size + 1)) if start is None else start.copy()
    active = np.zeros((len(fits), size + 1), dtype=bool)
    for i, features in enumerate(left):
        active[i, [0, *(f + 1 for f in features)]] = True
    weights[~active] = 0.0
    going = np.arange(len(fits))
    for _ in range(STEPS):
        gradient, hessian = _equations(rows, [fits[i] for i in going], weights[going], scales)
        moved = []
        for i, g, h in zip(going, gradient, hessian):
            on = np.flatnonzero(active[i])
            penalty = np.where(on > 0, RIDGE, 1e-9)
            step = np.linalg.solve(h[np.ix_(on, on)] + np.diag(penalty), g[on] - np.where(on > 0, RIDGE, 0.0) * weights[i, on])
            # A long step is shortened, as Newton steps may overshoot far from the minimum.
            weights[i, on] += step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
            if np.abs(step).max() > 1e-5:
                moved.append(i)
        if not moved:
            break
        going = np.array(moved)
    return weights


def _hits(rows: DataFrame, fits: Sequence[Fit], weights: np.ndarray, scales) -> np.ndarray:
    """Rows hit and rows in all, of each fit, in the fold that it left out (the inner one, if any)."""
    size = weights.shape[1] - 1
    groups, inner = _by_outer(fits), np.array([f.inner for f in fits])

    def work(batches):
        total = np.zeros((len(fits), 2), dtype=np.int64)
        for x, label, at_outer, at_inner in _arrays(batches, size):
            for fold, mine in groups.items():
                mean, deviation = scales.get(fold, scales[-1])
                z = np.hstack([np.ones((len(x), 1)), (x - mean) / deviation])
                right = (z @ weights[mine].T > 0) == (label[:, None] > 0.5)
                by_inner = (at_outer != fold)[:, None] & (at_inner[:, None] == inner[mine])
                tested = np.where(inner[mine] < 0, (at_outer == fold)[:, None], by_inner)
                total[mine] += np.stack([(right & tested).sum(axis=0), tested.sum(axis=0)], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(fits)), pa.int32()), *map(pa.array, total.T.copy())], names=["fit", "hits", "n"])

    out = np.zeros((len(fits), 2), dtype=np.int64)
    for r in rows.mapInArrow(work, "fit int, hits bigint, n bigint").groupBy("fit").agg(F.sum("hits"), F.sum("n")).collect():
        out[r[0]] = r[1:]
    return out


def eliminate_logistic(rows: DataFrame, folds: int = FOLDS, outer: Sequence[int] = (-1,)) -> dict[int, tuple[list[Step], list[float | None]]]:
    """For each outer fold: the elimination on the rows outside it, and each step's accuracy inside it.

    All outer and inner folds drop their weakest feature at the same time, so a step costs as many
    passes as one regression. The accuracy of an outer fold without rows is None.
    """
    size = _size(rows)
    scales = _scales(rows, size)
    fits = [Fit(o, i) for o in outer for i in [-1, *range(folds)]]
    left = [list(range(size)) for _ in fits]
    weights, history = None, []
    for _ in range(size):
        weights = logistic_weights(rows, fits, left, scales, weights)
        weakest = [min(f, key=lambda j: (abs(w[j + 1]), j)) for f, w in zip(left, weights)]
        history.append((weights.copy(), [tuple(f) for f in left], weakest))
        left = [[j for j in f if j != x] for f, x in zip(left, weakest)]
    found = _hits(rows, fits * size, np.concatenate([w for w, _, _ in history]), scales).reshape(size, len(fits), 2)
    out = {}
    for o in outer:
        mine = [i for i, f in enumerate(fits) if f.outer == o]
        steps, scores = [], []
        for (_, features, weakest), counts in zip(history, found):
            steps.append(Step(features[mine[0]], weakest[mine[0]], [h / n for h, n in counts[mine[1:]] if n]))
            h, n = counts[mine[0]]
            scores.append(h / n if n else None)
        out[o] = steps, scores
    return out


# Boosted trees


class Trees(NamedTuple):
    """Settings of boosted trees."""

    rounds: int = 100
    rate: float = 0.1
    depth: int = 3


def _bin(value: Column, cuts: Sequence[float]) -> Column:
    """The number of cuts below a value."""
    return F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda cut: cut < value)) if cuts else F.lit(0)


def cells(rows: DataFrame) -> tuple[DataFrame, int]:
    """outer, inner, bins, n0, n1: rows of both labels by bins of their features; the most bins of a feature.

    Features of few values keep them. The others are cut at quantiles of all rows, in as many bins
    as keep the combinations below CELLS (two at least).
    """
    size = _size(rows)
    x = [F.get("x", F.lit(i)) for i in range(size)]
    few = [F.slice(F.sort_array(F.collect_set(c)), 1, MOST_BINS + 1) for c in x]
    values = rows.agg(*[F.when(F.approx_count_distinct(c) <= 2 * MOST_BINS, f) for c, f in zip(x, few)]).first()
    many = [i for i in range(size) if values[i] is None or len(values[i]) > MOST_BINS]
    narrow = [F.get("x", F.lit(i)) for i in range(size) if i not in many]
    combinations = rows.agg(F.approx_count_distinct(F.array(*narrow))).first()[0] if narrow else 1
    bins = max(2, min(MOST_BINS, int((CELLS / max(combinations, 1)) ** (1 / max(len(many), 1)))))
    cuts: list[list[float]] = [[(a + b) / 2 for a, b in zip(v, v[1:])] if i not in many else [] for i, v in enumerate(values)]
    if many:
        named = rows.select(*[x[i].alias(f"f{i}") for i in many])
        quantiles = named.approxQuantile([f"f{i}" for i in many], [k / bins for k in range(1, bins)], 0.001)
        for i, found in zip(many, quantiles):
            cuts[i] = sorted(set(found))
    binned = rows.select("label", "outer", "inner", F.array(*map(_bin, x, cuts)).alias("bins"))
    counted = binned.groupBy("outer", "inner", "bins").agg(
        F.sum((F.col("label") <= 0.5).cast("long")).alias("n0"), F.sum((F.col("label") > 0.5).cast("long")).alias("n1")
    )
    return cut_lineage(counted), max(map(len, cuts)) + 1


def boost(bins: np.ndarray, n0: np.ndarray, n1: np.ndarray, width: int, features: Sequence[int], trees: Trees) -> tuple[np.ndarray, np.ndarray]:
    """Margin of every cell and gain of every feature, after boosting on the counts of both labels.

    Cells without counts only get their margin. Trees of `depth` levels fit the residuals of the
    log loss; a leaf takes one Newton step.
    """
    size = bins.shape[1]
    n = (n0 + n1).astype(float)
    gains = np.zeros(size)
    start = np.log(max(n1.sum(), 1e-9) / max(n0.sum(), 1e-9))
    margin = np.full(len(bins), start)
    columns = np.array(sorted(features))
    mine = bins[:, columns]
    flat = np.arange(len(columns)) * width + mine
    each = np.arange(len(bins))
    for _ in range(trees.rounds):
        chance = 1 / (1 + np.exp(-margin))
        residual, curve = n1 - n * chance, n * chance * (1 - chance)
        node = np.zeros(len(bins), dtype=np.int64)
        for level in range(trees.depth):
            nodes = 1 << level
            at = (flat + (node * len(columns) * width)[:, None]).ravel()
            shape = (nodes, len(columns), width)
            g = np.bincount(at, np.repeat(residual, len(columns)), nodes * len(columns) * width).reshape(shape).cumsum(axis=2)
            m = np.bincount(at, np.repeat(n, len(columns)), nodes * len(columns) * width).reshape(shape).cumsum(axis=2)
            all_g, all_m = g[:, :1, -1:], m[:, :1, -1:]
            sound = (m > 0.5) & (all_m - m > 0.5)
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = np.where(sound, g * g / m + (all_g - g) ** 2 / (all_m - m) - all_g * all_g / all_m, 0.0).reshape(nodes, -1)
            best = gain.argmax(axis=1)
            worth = gain[np.arange(nodes), best]
            split = worth > 1e-9
            column, cut = best // width, np.where(split, best % width, width)
            np.add.at(gains, columns[column[split]], worth[split])
            node = 2 * node + (mine[each, column[node]] > cut[node])
        leaves = 1 << trees.depth
        top, low = np.bincount(node, residual, leaves), np.bincount(node, curve, leaves)
        margin = margin + trees.rate * np.divide(top, low, out=np.zeros(leaves), where=low > 1e-12)[node]
    return margin, gains


def _share_out(counted: DataFrame, folds: Sequence[int], inner: Sequence[int]) -> DataFrame:
    """fold, part, test, bins, n0, n1: the cells of every fit; test marks what it is measured on."""
    rows = counted.withColumn("fold", F.explode(F.array(*map(F.lit, folds)))).withColumn("part", F.explode(F.array(*map(F.lit, inner))))
    left_out = F.col("outer") == F.col("fold")
    rows = rows.where((F.col("part") < 0) | ~left_out)
    test = F.when(F.col("part") < 0, left_out).otherwise(F.col("inner") == F.col("part"))
    return rows.groupBy("fold", "part", test.alias("test"), "bins").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def _counts(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    bins = group["bins"].combine_chunks()
    n = len(group)
    return (bins.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.int64),
            *(group[c].to_numpy().astype(float) for c in ("n0", "n1")), group["test"].to_numpy(zero_copy_only=False).astype(bool))


def _measured(margin, n0, n1, test) -> tuple[int, int]:
    return int(np.where(margin > 0, n1, n0)[test].sum()), int((n0 + n1)[test].sum())


def eliminate_boosted(counted: DataFrame, width: int, folds: int = FOLDS, outer: Sequence[int] = (-1,), trees: Trees = Trees()) -> dict[int, list[Step]]:
    """For each outer fold the elimination on the rows outside it; every fold is one task over its cells."""

    def work(group: pa.Table) -> pa.Table:
        bins, n0, n1, test = _counts(group)
        left, out = list(range(bins.shape[1])), []
        while left:
            margin, gains = boost(bins, n0 * ~test, n1 * ~test, width, left, trees)
            weakest = min(left, key=lambda j: (gains[j], j))
            out.append({"features": list(left), "weakest": weakest, **dict(zip(("hits", "n"), _measured(margin, n0, n1, test)))})
            left = [j for j in left if j != weakest]
        ids = [{c: group[c][0].as_py() for c in ("fold", "part")}] * len(out)
        return pa.Table.from_pylist([{**a, **b} for a, b in zip(ids, out)], schema)

    schema = pa.schema([("fold", pa.int32()), ("part", pa.int32()), ("features", pa.list_(pa.int32())), ("weakest", pa.int32()), ("hits", pa.int64()), ("n", pa.int64())])
    shared = _share_out(counted, outer, [-1, *range(folds)])
    found = shared.groupBy("fold", "part").applyInArrow(work, "fold int, part int, features array<int>, weakest int, hits bigint, n bigint").collect()
    out = {}
    for o in outer:
        mine = sorted((r for r in found if r["fold"] == o), key=lambda r: (r["part"], -len(r["features"])))
        whole = [r for r in mine if r["part"] == -1]
        inner: dict[int, list[float]] = {}
        for r in mine:
            if r["part"] >= 0 and r["n"]:
                inner.setdefault(len(r["features"]), []).append(r["hits"] / r["n"])
        out[o] = [Step(tuple(r["features"]), r["weakest"], inner.get(len(r["features"]), [])) for r in whole]
    return out


def boosted_accuracy(counted: DataFrame, width: int, chosen: dict[int, Sequence[int]], settings: Sequence[Trees]) -> list[list[float]]:
    """For every setting its accuracy in each outer fold, on the features chosen for the fold."""

    def work(group: pa.Table) -> pa.Table:
        bins, n0, n1, test = _counts(group)
        fold, k = group["fold"][0].as_py(), group["setting"][0].as_py()
        margin, _ = boost(bins, n0 * ~test, n1 * ~test, width, chosen[fold], settings[k])
        hits, n = _measured(margin, n0, n1, test)
        return pa.table({"fold": pa.array([fold], pa.int32()), "setting": pa.array([k], pa.int32()), "hits": [hits], "n": [n]})

    shared = _share_out(counted, list(chosen), [-1]).withColumn("setting", F.explode(F.array(*map(F.lit, range(len(settings))))))
    found = shared.groupBy("fold", "setting").applyInArrow(work, "fold int, setting int, hits bigint, n bigint").collect()
    return [[r["hits"] / r["n"] for r in sorted(found, key=lambda r: r["fold"]) if r["setting"] == k and r["n"]] for k in range(len(settings))]


def choose_boosted(rows: DataFrame, folds: int = FOLDS, trees: Trees = Trees()) -> tuple[DataFrame, int, dict[int, Sequence[int]]]:
    """Cells, their width, and for each outer fold the features that its elimination keeps."""
    counted, width = cells(rows)
    outer = sorted(r[0] for r in counted.select("outer").distinct().collect())
    steps = eliminate_boosted(counted, width, folds, outer, trees)
    return counted, width, {o: s[best_step(s)].features for o, s in steps.items()}


def cross_validate(df: DataFrame, folds: int = FOLDS, features: str = "features", label: str = "label", trees: Trees = Trees()) -> DataFrame:
    """model, accuracy, deviation of a logistic regression and of boosted trees over shuffled folds.

    Both choose their features anew on the training rows of each fold, by recursive elimination over
    inner folds. Labels are 0 and 1, features without nulls.
    """
    rows = dealt(df, features, label, folds)
    outer = sorted(r[0] for r in rows.select("outer").distinct().collect())
    scores = {"logistic": [], "boosted": []}
    for steps, inside in (eliminate_logistic(rows, folds, outer) if outer else {}).values():
        scores["logistic"].append(inside[best_step(steps)])
    if outer:
        scores["boosted"] = boosted_accuracy(*choose_boosted(rows, folds, trees), [trees])[0]
    found = [(m, float(np.mean(s)), float(np.std(s))) for m, s in scores.items() if s]
    return df.sparkSession.createDataFrame(found, "model string, accuracy double, deviation double")
