"""Learning jobs choose features inside each fold and search the whole grid."""

import random

from pyspark.ml import Pipeline
from pyspark.ml.linalg import Vectors

from millrace.operators import learn
from millrace.queries import learning


def rows(spark):
    draw = random.Random(1)
    found = [(float(i % 2), Vectors.dense([i % 2 + draw.gauss(0, 0.2), draw.gauss(0, 1)])) for i in range(60)]
    return spark.createDataFrame(found, ["label", "features"]).coalesce(1).cache()


def test_elimination_is_fitted_in_each_fold(spark, monkeypatch):
    seen = []
    whole = learn.Elimination._fit

    def fit(self, dataset):
        model = whole(self, dataset)
        seen.append((dataset.count(), model.getIndices()))
        return model

    monkeypatch.setattr(learn.Elimination, "_fit", fit)
    job = Pipeline(stages=[learn.scaler(), learn.Elimination(learn.logistic("chosen"), folds=2), learn.logistic("chosen")])
    found = learn.cross_validate(rows(spark), {"logistic": job}, folds=2, parallel=1).first()
    assert found.accuracy > 0.9
    assert sorted(n < 60 for n, _ in seen)[-2:] == [True, True] and all(0 in chosen for _, chosen in seen)


def test_search_has_the_whole_grid(spark, monkeypatch):
    given = {}
    monkeypatch.setattr(learning, "prepared", lambda t: rows(spark))
    monkeypatch.setattr(learning, "cut_lineage", lambda df: df)
    monkeypatch.setattr(learn, "random_search", lambda df, job, grid, tries: given.update(job=job, grid=grid, tries=tries))
    learning.random_search(None)
    assert any(isinstance(s, learn.Elimination) for s in given["job"].getStages()) and given["tries"] == 10
    assert sorted(map(len, given["grid"].values())) == [6, 10, 20]
    assert {p.name: (min(v), max(v)) for p, v in given["grid"].items()} == {"maxIter": (50, 500), "stepSize": (0.01, 0.2), "maxDepth": (3, 8)}
