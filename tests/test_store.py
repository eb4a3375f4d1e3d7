"""The table that is merged on read against runs of the plain operators."""

import os
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from millrace.functions.keys import row_hash
from millrace.operators.history import snapshot, upsert
from millrace.streaming import ingest, store

SCHEMA = "k int, a string, b int"


def run_time(batch):
    return f"2025-01-{batch + 1:02d} 00:00:00"


def batches(spark, n=6, keys=40):
    draw = random.Random(7)
    for i in range(n):
        some = draw.sample(range(keys), keys if i == 0 else 12)
        data = [(None if k == 0 else k, draw.choice([None, "x", "y"]), draw.randrange(100)) for k in some]
        yield spark.createDataFrame(data, SCHEMA).coalesce(1)


def folder_bytes(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(folder) for f in files if f.endswith(".parquet"))


@pytest.mark.parametrize("every", [1, 2, 100])
def test_history_is_that_of_snapshots(spark, tmp_path, every):
    table = store.Store(f"{tmp_path}/t{every}", ("k",), ("a",), buckets=4)
    want = None
    for i, changes in enumerate(batches(spark)):
        store.write_batch(table, changes, i, run_time(i))
        want = snapshot(want, changes, ["k"], run_time(i), ["a"], close_deleted=False)
        if i % every == every - 1:
            store.compact(spark, table, 0.3)
    found = store.read(spark, table)
    assert rows(found, *want.columns) == rows(want)
    assert found.where("valid_to IS NOT NULL").count() > 10


@pytest.mark.parametrize("every", [1, 3, 100])
def test_last_versions_are_those_of_upserts(spark, tmp_path, every):
    table = store.Store(f"{tmp_path}/t{every}", ("k",), ("k", "a"), history=False, buckets=4)
    want = None
    for i, changes in enumerate(batches(spark)):
        changes = changes.where("k IS NOT NULL")
        store.write_batch(table, changes, i, run_time(i))
        fresh = changes.withColumn("row_hash", row_hash(["k", "a"]))
        at = F.lit(run_time(i)).cast("timestamp_ntz")
        want = fresh.withColumns({"created_at": at, "updated_at": at}) if want is None else upsert(want, fresh, ["k"], "row_hash", run_time(i), keep_absent=True)
        if i % every == every - 1:
            store.compact(spark, table, 0.3)
    assert rows(store.read(spark, table), *want.columns) == rows(want)


def test_a_batch_writes_what_it_brings(spark, tmp_path):
    table = store.Store(f"{tmp_path}/t", ("id",), ("v",), buckets=2)
    store.write_batch(table, spark.range(200_000).withColumn("v", F.xxhash64("id")), 0, run_time(0))
    store.compact(spark, table)
    store.write_batch(table, spark.range(200).withColumn("v", F.lit(1)), 1, run_time(1))
    assert folder_bytes(f"{table.target}/batches/batch=1") < folder_bytes(f"{table.target}/batches/batch=0") / 100
    assert store.compact(spark, table) == []
    assert folder_bytes(f"{table.target}/base/gen=1") == 0
    assert store.read(spark, table).where("valid_to IS NULL").count() == 200_000


def test_only_outgrown_buckets_are_rewritten(spark, tmp_path):
    table = store.Store(f"{tmp_path}/t", ("k",), ("a", "b"), buckets=8)
    first = spark.createDataFrame([(k, "x", 0) for k in range(80)], SCHEMA)
    store.write_batch(table, first, 0, run_time(0))
    assert len(store.compact(spark, table)) == 8
    bucket = lambda k: spark.range(1).select(F.pmod(F.xxhash64(F.lit(k)), F.lit(8))).first()[0]
    hot = [k for k in range(80) if bucket(k) == bucket(5)]
    store.write_batch(table, spark.createDataFrame([(k, "y", 1) for k in hot], SCHEMA), 1, run_time(1))
    assert store.compact(spark, table) == [bucket(5)]
    found = store.read(spark, table)
    assert found.where("valid_to IS NULL").count() == 80 and found.count() == 80 + len(hot)


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    table = store.Store(f"{tmp_path}/t", ("k",), ("a",), buckets=2)
    given = list(batches(spark, 3))
    for i, changes in enumerate(given):
        store.write_batch(table, changes, i, run_time(i))
    want = rows(store.read(spark, table))
    store.write_batch(table, given[2], 2, run_time(2))
    assert rows(store.read(spark, table)) == want
    store.compact(spark, table, 0)
    store.write_batch(table, given[2], 2, run_time(2))
    assert rows(store.read(spark, table)) == want


def test_nothing_written_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no batch"):
        store.read(spark, store.Store(f"{tmp_path}/none", ("k",), ("a",)))


def test_stream_into_a_store(spark, tmp_path):
    table = store.Store(f"{tmp_path}/t", ("k",), ("a",), buckets=2)
    want = None
    for i, changes in enumerate(batches(spark, 3)):
        changes.write.parquet(f"{tmp_path}/in/part{i}")
        stream = ingest.file_stream(spark, f"{tmp_path}/in/*", changes.schema)
        found = store.merge_into(stream, table, f"{tmp_path}/ckpt", ["b"], run_time, every=2, wait=120)
        want = snapshot(want, changes, ["k"], run_time(i), ["a"], close_deleted=False)
    assert rows(found, *want.columns) == rows(want)
