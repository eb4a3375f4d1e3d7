import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from millrace.operators import prefs
from millrace.operators.quality import password_failures
from millrace.streaming import gate, ingest, merge
from millrace.streaming.prefs import prefs_stream

WAIT = 120


def drop_in(spark, folder, name, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}")


def test_ingest_takes_each_file_once(spark, tmp_path):
    schema = spark.createDataFrame([], "id int, v string").schema
    job = (spark, f"{tmp_path}/in/*", schema, f"{tmp_path}/out", f"{tmp_path}/ckpt")
    drop_in(spark, f"{tmp_path}/in", "day1", [(1, "a")], schema)
    ingest.ingest_available(*job, wait=WAIT)
    drop_in(spark, f"{tmp_path}/in", "day2", [(2, "b")], schema)
    ingest.ingest_available(*job, wait=WAIT)
    ingest.ingest_available(*job, wait=WAIT)
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [(1, "a"), (2, "b")]


def changes(spark, tmp_path, days):
    schema = "k int, a string, t int"
    for i, day in enumerate(days):
        drop_in(spark, f"{tmp_path}/in", f"day{i}", day, schema)
    return lambda: ingest.file_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema, files_per_batch=1)


def run_time(batch):
    return f"2025-01-{batch + 1:02d} 00:00:00"


def test_history_over_batches(spark, tmp_path):
    stream = changes(spark, tmp_path, [[(1, "x", 1), (2, "y", 1), (1, "w", 0)]])
    job = dict(target=f"{tmp_path}/hist", checkpoint=f"{tmp_path}/ckpt", keys=["k"], order=["t"],
               merge=merge.history_merge(["k"], ["a"], run_time), wait=WAIT)
    first = merge.merge_stream(stream(), **job)
    assert rows(first, "k", "a") == [(1, "x"), (2, "y")]
    drop_in(spark, f"{tmp_path}/in", "later", [(1, "z", 2), (3, "n", 2)], "k int, a string, t int")
    second = merge.merge_stream(stream(), **job)
    got = sorted((r.k, r.a, str(r.valid_from)[8:10], r.valid_to and r.valid_to.day) for r in second.collect())
    assert got == [(1, "x", "01", 2), (1, "z", "02", None), (2, "y", "01", None), (3, "n", "02", None)]
    # nothing new: the table stays as it is
    assert merge.merge_stream(stream(), **job).count() == 4


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    job = merge.history_merge(["k"], ["a"], run_time)
    old = spark.createDataFrame([(1, "x")], "k int, a string")
    base = job(None, old, 0)
    new = spark.createDataFrame([(1, "y")], "k int, a string")
    assert rows(job(base.drop("open"), new, 1)) == rows(job(base.drop("open"), new, 1))


def test_upsert_over_batches(spark, tmp_path):
    stream = changes(spark, tmp_path, [[(1, "x", 1), (2, "y", 1)]])
    job = dict(target=f"{tmp_path}/tab", checkpoint=f"{tmp_path}/ckpt", keys=["k"], order=["t"],
               merge=merge.upsert_merge(["k"], ["k", "a"], run_time), wait=WAIT)
    merge.merge_stream(stream(), **job)
    drop_in(spark, f"{tmp_path}/in", "later", [(1, "x", 2), (2, "z", 2)], "k int, a string, t int")
    got = {r.k: (r.a, r.created_at.day, r.updated_at.day) for r in merge.merge_stream(stream(), **job).collect()}
    assert got == {1: ("x", 1, 1), 2: ("z", 1, 2)}


def test_gate(spark, tmp_path):
    schema = "u int, p string"
    drop_in(spark, f"{tmp_path}/in", "a", [(1, "Q+7&AGxB"), (2, "weak"), (3, None)], schema)
    stream = ingest.file_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema)
    gate.gate_stream(stream, password_failures("p"), f"{tmp_path}/good", f"{tmp_path}/bad", f"{tmp_path}/ckpt", wait=WAIT)
    assert rows(spark.read.parquet(f"{tmp_path}/good"), "u") == [(1,)]
    assert {r.u: len(r.failures) for r in spark.read.parquet(f"{tmp_path}/bad").collect()} == {2: 3, 3: 4}
    marks = spark.createDataFrame([(1,), (None,)], "v int").select(gate.rule_failures({"positive": F.col("v") > 0}).alias("f"))
    assert [r.f for r in marks.collect()] == [[], ["positive"]]


def test_online_preferences_equal_the_batch_fold(spark, tmp_path):
    rng = random.Random(4)
    schema = "user_id int, item_id int, reward double, t int"
    data = [(0 if rng.random() < 0.4 else rng.randrange(1, 4), rng.randrange(4), rng.choice([1.0, -4.0]), i) for i in range(120)]
    for i in range(3):
        drop_in(spark, f"{tmp_path}/in", f"part{i}", data[i * 40:(i + 1) * 40], schema)
    stream = ingest.file_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema, files_per_batch=1)
    online = prefs_stream(stream, 6, ["t"], f"{tmp_path}/values", f"{tmp_path}/ckpt", wait=WAIT)
    batch = prefs.learn_values(spark.createDataFrame(data, schema), 6, ["t"])
    got, expected = ({(r.user_id, r.item_id): r.q for r in df.collect()} for df in (online, batch))
    assert got == pytest.approx(expected) and len(got) == len(expected)


@pytest.mark.parametrize("every", [2, 100])
def test_preferences_go_on_over_batches_and_runs(spark, tmp_path, every):
    """A user with a third of all feedback, users and items without an id, users that come back later."""
    rng = random.Random(7)
    schema = "user_id int, item_id int, reward double, t int"
    users, items = [0, 0, 0, 1, 2, 3, 4, None, 5], [0, 1, 2, 3, None]
    data = [(rng.choice(users), rng.choice(items), rng.choice([1.0, -4.0]), i) for i in range(200)]
    for i in range(5):
        drop_in(spark, f"{tmp_path}/in", f"part{i}", rng.sample(data[i * 40:(i + 1) * 40], 40), schema)
        stream = ingest.file_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema)
        online = prefs_stream(stream, 6, ["t"], f"{tmp_path}/values", f"{tmp_path}/ckpt", every=every, wait=WAIT)
    got = {(r.user_id, r.item_id): r.q for r in online.collect()}
    expected = {}
    for user, item, reward, _ in data:
        mine = [q for (u, _), q in expected.items() if u == user]
        top = max(mine + [0.0] * (len(mine) < 6))
        q = expected.get((user, item), 0.0)
        expected[user, item] = q + 0.1 * (reward + 0.9 * top - q)
    assert got == pytest.approx(expected)


def test_a_repeated_preference_batch_is_learned_once(spark, tmp_path):
    schema = "user_id int, item_id int, reward double, t int"
    drop_in(spark, f"{tmp_path}/in", "part", [(1, 1, 1.0, 1), (1, 1, 1.0, 2)], schema)
    for i in range(2):  # a new checkpoint: the same rows come as batch 0 again
        stream = ingest.file_stream(spark, f"{tmp_path}/in/*", spark.createDataFrame([], schema).schema)
        values = prefs_stream(stream, 3, ["t"], f"{tmp_path}/values", f"{tmp_path}/ckpt{i}", every=1, wait=WAIT)
    assert rows(values.selectExpr("user_id", "item_id", "round(q, 9)")) == [(1, 1, 0.199)]
