import datetime as dt
import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from millrace.operators import aggregates as agg
from millrace.operators import forecast, history, learn, lookups, prefs, quality as q, search, shape, similarity, stats, windows
from millrace.operators.embed import embed, hashed_text_vectors
from millrace.operators.profile import profile_table, value_frequencies
from millrace.operators.quantiles import describe, exact_quantiles

R1, R2, R3 = "2025-01-01 00:00:00", "2025-02-01 00:00:00", "2025-03-01 00:00:00"
RUNS = {R: dt.datetime.fromisoformat(R) for R in (R1, R2, R3)}


# ---- shaping


def test_small_steps_chain(spark):
    df = spark.createDataFrame([(1, "5.5", "x")], "id int, amount string, gone string")
    out = (
        df.transform(shape.copy_columns, {"id": ["nk", "id2"]}).transform(shape.cast_columns, {"amount": "decimal(9,2)"})
        .transform(shape.add_literals, {"kind": "k"}).transform(shape.drop_columns, ["gone"])
        .transform(shape.add_row_hash, ["nk", "amount"], "key").transform(shape.pick_columns, ["key", "nk", "amount", "kind"])
    )
    assert out.columns == ["key", "nk", "amount", "kind"] and str(out.first().amount) == "5.50"


def test_missing_columns(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(shape.MissingColumns):
        shape.pick_columns(df, ["a", "b"])
    assert shape.pick_columns(df, ["a", "b"], tolerant=True).columns == ["a"]
    assert shape.cast_columns(df, {"b": "int"}, tolerant=True).columns == ["a"]
    with pytest.raises(shape.MissingColumns):
        lookups.attach_keys(df, df, {"x": "y"})


def test_bad_casts(spark):
    df = spark.createDataFrame([("x",)], "a string")
    assert shape.cast_columns(df, {"a": "int"}).first().a is None
    with pytest.raises(Exception):
        shape.cast_columns(df, {"a": "int"}, strict=True).collect()


def test_stack_and_dedupe(spark):
    a = spark.createDataFrame([(1, "a")], "id int, x string")
    b = spark.createDataFrame([(1, 2.0), (2, 3.0)], "id int, y double")
    both = shape.stack_tables([a, b])
    assert rows(both, "id", "x", "y") == [(1, None, 2.0), (1, "a", None), (2, None, 3.0)]
    numbered = spark.createDataFrame([(1, 5), (1, 3), (2, 9)], "k int, v int")
    assert rows(shape.first_per_key(numbered, ["k"], ["v"])) == [(1, 3), (2, 9)]
    assert rows(shape.last_per_key(numbered, ["k"], ["v"])) == [(1, 5), (2, 9)]
    assert rows(shape.where_maximum(numbered, "v")) == [(2, 9)]


def test_keep_one_limits_rows_before_the_shuffle(spark):
    spark.range(1000).selectExpr("1 as k", "id as v").write.mode("overwrite").format("noop").save()
    df = shape.first_per_key(spark.range(1000).repartition(4).selectExpr("id % 3 as k", "id as v"), ["k"], ["v"])
    assert "WindowGroupLimit" in df._jdf.queryExecution().executedPlan().toString()


def test_lookup_with_several_offices(spark):
    events = spark.createDataFrame([("a",), ("b",), (None,)], "nk string")
    offices = spark.createDataFrame([("a", "k2"), ("a", "k1"), ("c", "k3")], "nk string, key string")
    assert len(lookups.attach_keys(events, offices, {"nk": "key"}).collect()) == 4
    one = lookups.attach_keys(events, offices, {"nk": "key"}, dedupe=True)
    assert rows(one, "nk", "key") == [(None, None), ("a", "k1"), ("b", None)]


# ---- windows and aggregates


def test_previous_date_matches_plain_lag(spark):
    rng = random.Random(1)
    data = [(rng.choice([1, 1, 1, 2, 3]), i, dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(40))) for i in range(300)]
    df = spark.createDataFrame(data, "c int, id int, d date")
    got = {r.id: r.previous_date for r in windows.previous_date(df, ["c"], "d", "id").collect()}
    expected = {}
    for c in (1, 2, 3):
        mine = sorted((d, i) for k, i, d in data if k == c)
        for before, this in zip([(None, None)] + mine, mine):
            expected[this[1]] = before[0]
    assert got == expected


def test_first_and_next(spark):
    df = spark.createDataFrame([(1, 2, 20.0), (1, 1, 10.0), (1, 3, 30.0), (2, 1, 5.0)], "u int, d int, p double")
    assert rows(windows.first_and_next(df, ["u"], ["d"], ["p"])) == [(1, 10.0, 20.0), (2, 5.0, None)]


def test_running_mean_equals_row_window(spark):
    df = spark.createDataFrame([(m, v) for m, v in [(1, 10), (1, 20), (2, 5), (3, 1), (3, 3)]], "m int, v int")
    got = rows(windows.running_mean_newest_first(df, F.col("m"), F.sum("v"), F.count("v")), "period", "running_mean", "place")
    assert got == [(1, 39 / 5, 3), (2, 3.0, 2), (3, 2.0, 1)]


def test_child_counts_keep_parents_without_children(spark):
    parents, children = spark.createDataFrame([(1,), (2,)], "p int"), spark.createDataFrame([(1,), (1,)], "c int")
    assert rows(agg.child_counts(parents, children, "p", "c")) == [(1, 2), (2, 0)]


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    assert [(r.bin, r.n) for r in agg.histogram(df, "v", 4).collect()] == [(0, 2)]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=60), st.floats(0.01, 1.0))
def test_exact_quantile_is_the_ranked_value(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    expected = sorted(values)[max(1, math.ceil(round(p * len(values), 6))) - 1]
    assert exact_quantiles(df, {"v": [p]}) == {"v": [expected]}


def test_quantiles_with_a_hot_value(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") / 7).alias("v"))
    expected = sorted(7.0 if i % 3 == 0 else i / 7 for i in range(30000))
    got = exact_quantiles(df, {"v": [0.1, 0.5, 0.999]})["v"]
    assert got == [expected[math.ceil(round(p * 30000, 6)) - 1] for p in (0.1, 0.5, 0.999)]
    assert describe(df.where("false"), "v").first().n == 0


# ---- history


def table(spark, data):
    return spark.createDataFrame(data, "k int, a string, b int")


def test_snapshot_cases(spark):
    first = table(spark, [(1, "same", 1), (2, "old", 1), (3, "gone", 1), (4, "x", None), (5, "y", 5)])
    second = table(spark, [(1, "same", 1), (2, "new", 1), (4, "x", 4), (5, "y", None), (6, "fresh", 1)])
    third = table(spark, [(1, "same", 1), (2, "new", 1), (3, "back", 1), (4, "x", 4), (5, "y", None), (6, "fresh", 1)])
    h1 = history.snapshot(None, first, ["k"], R1)
    h2 = history.snapshot(h1, second, ["k"], R2)
    h3 = history.snapshot(h2, third, ["k"], R3)
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    got = sorted(((r.k, r.a, r.b, str(r.valid_from)[5:7], str(r.valid_to)[5:7]) for r in h3.collect()), key=key)
    assert got == sorted([
        (1, "same", 1, "01", ""), (2, "old", 1, "01", "02"), (2, "new", 1, "02", ""), (3, "gone", 1, "01", "02"),
        (3, "back", 1, "03", ""), (4, "x", None, "01", "02"), (4, "x", 4, "02", ""), (5, "y", 5, "01", "02"),
        (5, "y", None, "02", ""), (6, "fresh", 1, "02", ""),
    ], key=key)
    assert len({r.scd_id for r in h3.collect()}) == h3.count()
    assert history.current_rows(h3).count() == 6
    assert sorted(r.k for r in history.rows_as_of(h3, "2025-02-15 00:00:00").collect()) == [1, 2, 4, 5, 6]


def test_snapshot_options(spark):
    first, second = table(spark, [(1, "a", 1), (2, "b", 1)]), table(spark, [(1, "a", 9)])
    h1 = history.snapshot(None, first, ["k"], R1)
    unchecked = history.snapshot(h1, second, ["k"], R2, check=["a"], close_deleted=False)
    assert rows(unchecked, "k", "a", "b") == [(1, "a", 1), (2, "b", 1)]
    assert history.current_rows(unchecked).count() == 2


def test_snapshot_by_two_keys(spark):
    a = spark.createDataFrame([(1, 1), (1, 2)], "x int, y int")
    b = spark.createDataFrame([(1, 2), (2, 2)], "x int, y int")
    h2 = history.snapshot(history.snapshot(None, a, ["x", "y"], R1), b, ["x", "y"], R2)
    assert rows(history.current_rows(h2), "x", "y") == [(1, 2), (2, 2)] and h2.count() == 3


def test_upsert(spark):
    at = F.lit(R1).cast("timestamp_ntz")
    old = spark.createDataFrame([(1, "h1"), (2, "h2"), (3, "h3")], "k int, h string").withColumns({"created_at": at, "updated_at": at})
    new = spark.createDataFrame([(1, "h1"), (2, "changed"), (4, "h4")], "k int, h string")
    got = rows(history.upsert(old, new, ["k"], "h", R2))
    a, b = RUNS[R1], RUNS[R2]
    assert got == [(1, "h1", a, a), (2, "changed", a, b), (4, "h4", b, b)]
    assert len(history.upsert(old, new, ["k"], "h", R2, keep_absent=True).collect()) == 4


# ---- quality


def test_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", -1.0, None, dt.date(2024, 1, 1)), (1, None, 2.0, dt.date(2024, 1, 2), None), (None, "b", None, None, None)],
        "id int, name string, amount double, d1 date, d2 date",
    )
    parents = spark.createDataFrame([("a",)], "n string")
    suite = q.Suite().add(
        "t", df,
        [q.not_null("id"), q.not_negative("amount"), q.date_order("d1", "d2"), q.rule("small", F.col("amount") < 1), q.pattern("name", "^a")],
        [q.unique(df, "id"), q.primary_key(df, "id"), q.foreign_key(df, parents, {"name": "n"}), q.primary_key(df, "id", "name")],
    )
    got = {r.check_name: r.failures for r in suite.report().collect()}
    assert got == {
        "not_null:id": 1, "not_negative:amount": 1, "date_order:d1,d2": 1, "rule:small": 1, "pattern:name": 1,
        "unique:id": 1, "primary_key:id": 2, "foreign_key:name": 1, "primary_key:id,name": 2,
    }
    assert not suite.passed() and q.has_null_key(df, "id") and not q.has_null_key(df.dropna(subset=["id"]), "id")


def test_schema_checks(spark):
    df = spark.createDataFrame([("1", "abc"), ("x", "abcdef"), (None, None)], "n string, t string")
    schema = T.StructType([T.StructField("n", T.IntegerType(), False), T.StructField("t", T.StringType()), T.StructField("z", T.StringType())])
    report = q.Suite().add("t", df, q.schema_checks(df, schema, {"t": 4})).report()
    assert {r.check_name: r.failures for r in report.collect()} == {
        "not_null:n": 1, "type:n:int": 1, "length:t": 1, "present:z": 3}


def test_password_policy(spark):
    df = spark.createDataFrame([("Q+7&AGxB",), ("short1A",), ("alllower1",), (None,)], "p string")
    good, bad = q.split_by(df, q.password_failures("p"))
    assert [r.p for r in good.collect()] == ["Q+7&AGxB"]
    assert {r.p: len(r.failures) for r in bad.collect()} == {"short1A": 1, "alllower1": 1, None: 4}


def test_cascade(spark):
    tables = {
        "a": spark.createDataFrame([(1,), (2,)], "id int"),
        "b": spark.createDataFrame([(10, 1), (11, 2), (12, None)], "id int, a_id int"),
        "c": spark.createDataFrame([(100, 10), (101, 11)], "id int, b_id int"),
    }
    left = q.cascade_delete(tables, [("b", "a_id", "a", "id"), ("c", "b_id", "b", "id")], "a", spark.createDataFrame([(1,)], "id int"))
    assert [rows(left[n], "id") for n in "abc"] == [[(2,)], [(11,), (12,)], [(101,)]]
    assert rows(q.blocked_deletes(tables["b"], "a_id", tables["a"], "id")) == [(1,), (2,)]


def test_estimated_profile(spark):
    df = spark.range(1000).selectExpr("id % 10 as k", "cast(id as string) as s")
    got = {r.column_name: r for r in profile_table(df, "t", approximate=True).collect()}
    assert got["k"].distinct_values == 10 and abs(got["s"].distinct_values - 1000) < 150 and got["k"].max == "9"
    assert profile_table(df, "t", approximate=True).columns == profile_table(df, "t").columns


def test_profile(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", 2.0), (2, "", 2.0), (None, "a", 3.0), (3, "b", 3.0)], "i int, s string, d double")
    got = {r.column_name: r for r in profile_table(df, "t").collect()}
    assert (got["i"].null_percentage, got["i"].duplicate_count, got["i"].min, got["i"].max, got["i"].mode) == (20.0, 2, "1", "3", None)
    assert (got["s"].null_percentage, got["s"].duplicate_count, got["s"].mode, got["s"].min) == (20.0, 2, "a", None)
    assert got["d"].num_rows == 5 and got["d"].num_columns == 3 and got["d"].data_type == "double"
    assert value_frequencies(df).where("column_name = 's'").count() == 3
    assert profile_table(df.where("false"), "t").first().null_percentage == 0.0


# ---- similarity, preferences, search


def brute_top(items, queries, k):
    unit = lambda m: m / np.sqrt((m * m).sum(axis=1, keepdims=True))
    scores = np.round(unit(queries) @ unit(items).T, similarity.SCORE_PLACES)
    return {q: [int(i) for i in sorted(range(len(items)), key=lambda i: (-scores[q, i], i))[:k]] for q in range(len(queries))}


def test_top_items_with_many_copies(spark, monkeypatch):
    rng = np.random.default_rng(3)
    items = rng.normal(size=(300, 8))
    items[::3] = items[0]  # a third of the items are copies of one
    queries = np.vstack([items[0], rng.normal(size=(4, 8))])
    frame = lambda m, n: spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], f"{n} int, vector array<double>")
    monkeypatch.setattr(similarity, "QUERY_BLOCK", 2)  # more than one pass
    got = similarity.top_items(frame(items, "item_id").repartition(5), frame(queries, "query_id"), 7)
    found = {}
    for r in got.orderBy("query_id", "place").collect():
        found.setdefault(r.query_id, []).append(r.item_id)
    assert found == brute_top(items, queries, 7)
    best = similarity.best_query(frame(items, "item_id"), frame(queries, "query_id"))
    assert {r.item_id for r in best.collect() if r.query_id == 0} >= set(range(0, 300, 3))


def test_mean_vectors(spark, monkeypatch):
    monkeypatch.setattr(similarity, "PARTIAL_GROUPS", 1)
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("a", [3.0, 4.0]), ("b", [0.0, 1.0])], "g string, v array<double>").repartition(3)
    assert {r.g: r.vector for r in similarity.mean_vectors(df, "g", "v").collect()} == {"a": [2.0, 3.0], "b": [0.0, 1.0]}


def plain_values(feedback, n_items, alpha=0.1, gamma=0.9):
    q = {}
    for item, reward in feedback:
        top = max([*q.values(), *([0.0] if len(q) < n_items else [])])
        q[item] = q.get(item, 0.0) + alpha * (reward + gamma * top - q.get(item, 0.0))
    return q


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from([1.0, -4.0])), max_size=80), st.integers(4, 6))
def test_values_follow_the_plain_rule(feedback, n_items):
    values = prefs.Values(n_items, 0.1, 0.9)
    for item, reward in feedback:
        values.learn(item, reward)
    assert values.q == plain_values(feedback, n_items)


def test_learned_values_of_a_hot_user(spark):
    rng = random.Random(2)
    data = [(0 if rng.random() < 0.4 else rng.randrange(1, 9), rng.randrange(5), rng.choice([1.0, -4.0]), i) for i in range(900)]
    df = spark.createDataFrame(data, "user_id int, item_id int, reward double, t int").repartition(6)
    got = {}
    for r in prefs.learn_values(df, 5, ["t"]).collect():
        got.setdefault(r.user_id, {})[r.item_id] = r.q
    for user in range(9):
        expected = plain_values([(i, w) for u, i, w, _ in data if u == user], 5)
        assert got.get(user, {}) == pytest.approx(expected)


def test_hand_computed_values(spark):
    df = spark.createDataFrame([(1, "a", 1.0, 1), (1, "a", -4.0, 2), (1, "b", 1.0, 3)], "user_id int, item_id string, reward double, t int")
    got = {r.item_id: r.q for r in prefs.learn_values(df, 10, ["t"]).collect()}
    assert got["a"] == pytest.approx(0.1 + 0.1 * (-4 + 0.9 * 0.1 - 0.1)) and got["b"] == pytest.approx(0.1)


def test_choice(spark):
    candidates = spark.createDataFrame([(u, i, float(-i)) for u in range(300) for i in (3, 1, 2)], "user_id int, item_id int, q double")
    picks = prefs.choose(candidates, ["user_id"], seed=1)
    greedy = picks.where("not explored")
    assert greedy.where("item_id != 1").count() == 0
    explored = picks.where("explored").count()
    assert 10 < explored < 60 and picks.count() == 300
    assert prefs.choose(candidates, ["user_id"], seed=1, epsilon=0.0).where("item_id != 1").count() == 0


def test_search_counts_whole_words(spark):
    df = spark.createDataFrame([(1, "The cat, the dog."), (2, "Category the"), (3, "cat-cat_CAT"), (4, None)], "id int, t string")
    counts = {r.id: r.n for r in df.select("id", search.occurrences("t", "cat").alias("n")).collect()}
    assert counts == {1: 1, 2: 0, 3: 3, 4: 0}
    got = {r.id: (round(r.score, 6), r.matched) for r in search.keyword_scores(df, "t", ["cat", "the", "CAT"]).collect()}
    idf = math.log(5 / 3) + 1
    assert got == {1: (round(3 * idf, 6), 2), 2: (round(idf, 6), 1), 3: (round(3 * idf, 6), 1)}


def test_embedding(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "abcd")], "id int, t string")

    def load():
        return lambda values: np.array([[len(v), 0.0] for v in values])

    assert [r.vector for r in embed(df, "t", load).orderBy("id").collect()] == [[1.0, 0.0], [1.0, 0.0]]
    assert hashed_text_vectors(df, "t", 16).count() == 2


# ---- statistics


def test_known_tails():
    assert stats.f_sf(4.1028, 2, 10) == pytest.approx(0.05, abs=1e-4)
    assert stats.f_sf(2.6138, 3, 1000) == pytest.approx(0.05, rel=5e-3)
    assert stats.studentized_range_sf(3.877, 3, 10) == pytest.approx(0.05, abs=5e-4)
    assert stats.studentized_range_sf(3.633, 4, 1e6) == pytest.approx(0.05, abs=5e-4)
    assert stats.studentized_range_sf(2.772, 2, 1e6) == pytest.approx(0.05, abs=5e-4)


def test_anova_and_tukey(spark):
    data = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("b", 2.0), ("b", 3.0), ("b", 4.0), ("c", 9.0), ("c", 10.0), ("c", 11.0)]
    moments = stats.group_moments(spark.createDataFrame(data, "g string, v double"), "g", "v")
    row = stats.with_p_value(stats.anova(moments)).first()
    assert (row.df_between, row.df_within) == (2, 6)
    assert row.f == pytest.approx(57.0) and row.p_value < 0.001
    pairs = {(r.level_a, r.level_b): (r.q, r.different) for r in stats.tukey(moments).collect()}
    assert pairs[("a", "b")][1] is False and pairs[("a", "c")][1] and pairs[("b", "c")][1]
    assert pairs[("a", "c")][0] == pytest.approx(8 / math.sqrt(1 / 3))


def test_partial_autocorrelation(spark):
    rng = np.random.default_rng(5)
    x = np.zeros(400)
    for i in range(1, 400):
        x[i] = 0.7 * x[i - 1] + rng.normal()
    df = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(x)], "s string, t int, v double")
    got = stats.partial_autocorrelation(df, ["s"], "t", "v", 5).orderBy("lag").collect()
    d = x - x.mean()
    r = np.array([(d[k:] * d[:len(d) - k]).sum() / (d * d).sum() for k in range(6)])
    for row in got:
        k = row.lag
        matrix = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert row.partial == pytest.approx(np.linalg.solve(matrix, r[1:k + 1])[-1])
    assert got[0].significant and abs(got[0].partial - 0.7) < 0.1


# ---- learning


def test_linear_fit_matches_least_squares(spark):
    rng = np.random.default_rng(1)
    data = [(s, t, float(rng.integers(1, 9)), float(2 + 3 * t + s)) for s in (1, 2) for t in range(30)]
    df = spark.createDataFrame(data, "s int, t int, x double, y double").withColumn("test", F.col("t") >= 25)
    fits = forecast.linear_fits(df, ["s"], ["t", "x"], "y")
    errors = forecast.mean_absolute_errors(forecast.predict_linear(df, fits, ["s"], ["t", "x"]), "y", ["linear"]).first()
    assert errors.mae < 1e-4 and errors.rows == 10


def test_classifiers(spark):
    rng = np.random.default_rng(0)
    data = [(float(x > 0), float(x), float(rng.normal()), "ab"[i % 2]) for i, x in enumerate(rng.normal(size=120))]
    df = spark.createDataFrame(data, "label double, x double, noise double, c string").coalesce(1)
    from pyspark.ml import Pipeline

    prepared = Pipeline(stages=learn.encoder(["c"], ["x", "noise"])).fit(df).transform(df).select("label", "features")
    assert prepared.first().features.size == 3  # the first category is dropped
    scores = learn.cross_validate(prepared, {"logistic": Pipeline(stages=[learn.scaler(), learn.logistic()])}, folds=3).first()
    assert scores.accuracy > 0.9
    steps = learn.eliminate_features(prepared, ["c_b", "x", "noise"], folds=2).orderBy("n_features").collect()
    assert [s.n_features for s in steps] == [1, 2, 3] and steps[0].features == ["x"]
    model = learn.boosted("features")
    tried = learn.random_search(prepared, model, {model.maxIter: [2, 3], model.maxDepth: [1, 2]}, tries=2, folds=2)
    assert tried.count() == 2 and tried.where("best").count() == 1


def test_binary_code(spark):
    df = spark.createDataFrame([("yes",), ("no",), (None,)], "c string")
    assert {r.c: r.n for r in learn.binary_code(df, "c", "n").collect()} == {"yes": 1, "no": 0, None: None}
