"""Publishing: one number, one writer; the tables of a version belong together."""

import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from millrace.sinks import commits, writers


def outcome(call):
    try:
        return call()
    except commits.Conflict:
        return "conflict"


def test_a_number_is_taken_once(spark, tmp_path):
    folder = str(tmp_path / "log")
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda i: outcome(lambda: commits.commit(spark, folder, 1, f"writer {i}")), range(8)))
    assert got.count("conflict") == 7 and commits.committed(spark, folder) == [1]
    assert commits.content(spark, folder, 1) == f"writer {got.index(None)}"
    commits.commit(spark, folder, 12, "é")
    assert commits.committed(spark, folder) == [1, 12] and commits.content(spark, folder, 12) == "é"
    assert {p.name for p in (tmp_path / "log").iterdir() if not p.name.startswith(".")} == {f"{n:020d}" for n in (1, 12)}


def test_no_log_is_an_empty_log(spark, tmp_path):
    assert commits.committed(spark, f"{tmp_path}/none") == []


def test_of_two_loads_one_fails_cleanly(spark, tmp_path):
    home, both = str(tmp_path), threading.Barrier(2)

    class Waits:
        def passed(self):
            both.wait(60)  # both loads have written their tables before either publishes
            return True

    def load(n):
        tables = {"a": spark.range(n), "b": spark.range(n + 100)}
        return outcome(lambda: (writers.load_warehouse(tables, home, checks=lambda w: Waits()), n)[1])

    with ThreadPoolExecutor(2) as pool:
        got = list(pool.map(load, [3, 5]))
    assert got.count("conflict") == 1
    won = next(n for n in got if n != "conflict")
    assert [writers.published_table(spark, home, n).count() for n in ("dim_a", "dim_b")] == [won, won + 100]
    writers.load_warehouse({"a": spark.range(8)}, home)
    assert writers.published_table(spark, home, "dim_a").count() == 8
    assert writers.published_table(spark, home, "dim_b", 1).count() == won + 100


def test_old_versions_go(spark, tmp_path):
    home = str(tmp_path)
    for n in (1, 2, 3):
        writers.load_warehouse({"a": spark.range(n)}, home)
    with pytest.raises(Exception):
        writers.load_warehouse({"a": spark.range(4), "b": spark.sql("SELECT raise_error('x') AS id")}, home)
    assert len(writers.drop_old_versions(spark, home)) == 1  # the failed load is too young to go
    assert [writers.published_table(spark, home, "dim_a", n).count() for n in (2, 3)] == [2, 3]
    assert len(writers.drop_old_versions(spark, home, keep=1, unpublished_hours=-1)) == 2
    assert writers.published_table(spark, home, "dim_a").count() == 3
    writers.load_warehouse({"a": spark.range(5)}, home)
    assert commits.committed(spark, f"{home}/published") == [1, 2, 3, 4]
