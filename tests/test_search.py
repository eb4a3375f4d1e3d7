"""Exact search by clusters against all pairs."""

import numpy as np
import pytest

from millrace.operators import similarity

INPUT = "vector array<double>"


def frame(spark, matrix, name, parts=4):
    rows = [(i, None if v is None else [float(x) for x in v]) for i, v in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} int, {INPUT}").repartition(parts)


def brute(items, queries, k):
    length = lambda m: np.maximum(np.sqrt((m * m).sum(axis=1, keepdims=True)), 1e-300)
    scores = np.round((queries / length(queries)) @ (items / length(items)).T, similarity.SCORE_PLACES)
    return {q: [(int(i), float(scores[q, i])) for i in sorted(range(len(items)), key=lambda i: (-scores[q, i], i))[:k]] for q in range(len(queries))}


def grouped(df):
    out = {}
    for r in df.orderBy("query_id", "place").collect():
        out.setdefault(r.query_id, []).append((r.item_id, pytest.approx(r.score, abs=1e-9)))
    return out


def clustered(rng, n, groups=12, width=16, spread=0.15):
    centres = rng.normal(size=(groups, width))
    return centres[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, width))


@pytest.mark.parametrize("k", [1, 5, 900])
def test_every_nearest_item_is_found(spark, monkeypatch, k):
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 8)
    monkeypatch.setattr(similarity, "UNIT", 50)
    rng = np.random.default_rng(k)
    items = clustered(rng, 600)
    items[::3] = items[0]  # a third of the items are copies of one
    items[7] = 0.0
    queries = np.vstack([clustered(rng, 20), items[:2], np.zeros((1, 16))])
    found = grouped(similarity.top_items(frame(spark, items, "item_id"), frame(spark, queries, "query_id"), k))
    assert found == brute(items, queries, min(k, 600))


def test_most_pairs_are_pruned(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    draw = lambda n: centres[rng.integers(0, 30, n)] + 0.05 * rng.normal(size=(n, 16))
    items, queries = draw(3000), draw(1500)
    found, share = similarity.search(
        frame(spark, items, "item_id").withColumnRenamed("vector", "v"), frame(spark, queries, "query_id").withColumnRenamed("vector", "v"), 3
    )
    assert share < 0.2
    assert grouped(similarity._ranked(found, "query_id", 3)) == brute(items, queries, 3)


def test_best_query_of_every_item(spark, monkeypatch):
    rng = np.random.default_rng(4)
    items, queries = clustered(rng, 80), clustered(rng, 40)
    queries[5] = queries[2]
    args = frame(spark, items, "item_id"), frame(spark, queries, "query_id")
    few = {(r.item_id, r.query_id): r.score for r in similarity.best_query(*args).collect()}
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 8)
    many = {(r.item_id, r.query_id): r.score for r in similarity.best_query(*args).collect()}
    want = brute(queries, items, 1)
    assert set(few) == set(many) == {(i, w[0][0]) for i, w in want.items()} and many == pytest.approx(few)


def test_no_items_and_no_queries(spark, monkeypatch):
    some, none = np.ones((3, 4)), []
    for block in (1024, 1):
        monkeypatch.setattr(similarity, "QUERY_BLOCK", block)
        for items, queries in [(some, none), (none, some), ([None], some), (some, [None])]:
            args = frame(spark, items, "item_id"), frame(spark, queries, "query_id")
            assert similarity.top_items(*args, 2).isEmpty() and similarity.best_query(*args).isEmpty()
