import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import SMALL, rows
from millrace.operators import quality as q
from millrace.session import cut_lineage, scratch_path, shared_dir
from millrace.sinks import runlog, writers
from millrace.sources import generate, readers
from millrace.sources.dated_json import read_dated_json
from millrace.sources.registry import Tables


def write(path, text):
    path.write_text(text)
    return str(path)


def test_read_tables(spark):
    tables = readers.read_tables(spark, ["region", "nation"], location=SMALL)
    assert tables["region"].count() == 5 and set(tables) == {"region", "nation"}
    with pytest.raises(ValueError):
        readers.read_table(spark, "region", "paper", SMALL)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "a int")
    with pytest.raises(readers.EmptyTable):
        readers.require_rows(empty, "t")
    assert readers.require_rows(spark.range(1), "t").count() == 1


def test_registry(spark):
    tables = Tables(spark, SMALL, ["region", "nation"])
    assert list(tables) == ["region", "nation"] and len(tables) == 2
    tables.register("raw_")
    assert spark.sql("SELECT count(*) FROM raw_nation JOIN raw_region ON n_regionkey = r_regionkey").first()[0] == 25
    assert {"raw_region", "raw_nation"} <= {r.table_name for r in readers.list_tables(spark).collect()}
    assert "raw_region" not in tables


def test_csv_kinds(spark, tmp_path):
    path = write(tmp_path / "one.csv", 'id,name\n1,"a, ""b"""\nx,c\n')
    assert readers.read_csv(spark, path, infer=False).first().name == 'a, "b"'
    write(tmp_path / "two.csv", "n\n5\n")
    folder = readers.read_csv_folder(spark, str(tmp_path))
    assert set(folder) == {"one", "two"} and folder["two"].schema["n"].dataType.simpleString() == "int"
    assert readers.read_csv_skipping_bad_rows(spark, path, "id int, name string").collect()[0].id == 1
    assert len(readers.read_csv_skipping_bad_rows(spark, path, "id int, name string").collect()) == 1
    with pytest.raises(Exception):
        readers.read_csv_strict(spark, path, "id int, name string").collect()
    good = write(tmp_path / "two_good.csv", "id,name\n1,a\n,b\n")
    assert readers.read_csv_strict(spark, good, "id int, name string").count() == 2
    with pytest.raises(Exception):
        readers.read_csv_strict(spark, good, "id int, name string", not_null=["id"]).collect()


def test_files(spark, tmp_path):
    for n in (1530, 77):
        (tmp_path / f"{n}.jpg").write_bytes(b"x")
    (tmp_path / "notes.txt").write_text("no")
    assert rows(readers.list_files(spark, str(tmp_path), "*.jpg"), "id") == [("1530",), ("77",)]


def test_dated_json(spark, tmp_path):
    for day, records in (("2024-01-01", [{"id": 1, "v": "a"}, {"id": 2}]), ("2024-01-02", []), ("2024-01-03", [{"id": 3, "v": "c"}])):
        (tmp_path / f"{day}.json").write_text(json.dumps(records))
    df = read_dated_json(spark, "id bigint, v string", f"file://{tmp_path}/{{start}}.json", "2024-01-01", "2024-01-04", missing="skip")
    assert rows(df) == [(1, "a"), (2, None), (3, "c")] and df.rdd.getNumPartitions() == 4
    with pytest.raises(Exception):
        read_dated_json(spark, "id bigint", f"file://{tmp_path}/{{start}}.json", "2024-01-04", "2024-01-04").collect()
    none = read_dated_json(spark, "id bigint", f"file://{tmp_path}/{{start}}.json", "2024-01-02", "2024-01-02")
    assert none.isEmpty() and none.columns == ["id"]


def test_jdbc_options():
    options = readers.jdbc_slices("id", 0, 100, 8)
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id"


def test_rows_after_the_mark(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "t int")
    assert rows(readers.rows_after(df, "t", df.where("t < 3"))) == [(3,)]
    assert readers.rows_after(df, "t", df.where("false")).count() == 3


def test_generated_tables_repeat(spark):
    parents = spark.createDataFrame([(i, dt.date(2024, 1, 1)) for i in range(50)], "id int, d date")
    a = generate.children(parents, "id", "d", 3, 10, 5, seed=1, most_days=9)
    b = generate.children(parents.repartition(7), "id", "d", 3, 10, 5, seed=1, most_days=9)
    assert rows(a) == rows(b) and a.count() == 150
    limits = a.agg(F.min("other_key"), F.max("other_key"), F.min("date_created"), F.max("date_created")).first()
    assert (limits[0], limits[1]) == (10, 14) and limits[2] >= dt.date(2024, 1, 1) and limits[3] <= dt.date(2024, 1, 10)
    stock = generate.weekly_stock(parents.select(F.col("id").alias("product_id")), spark, [2021, 2022])
    assert stock.count() == 50 * 104 and stock.agg(F.max("week")).first()[0] == 52
    share = stock.agg(F.avg("promotion")).first()[0]
    assert 0.2 < share < 0.3


def test_staging_and_warehouse(spark, tmp_path):
    home = str(tmp_path)
    tables = {"region": spark.read.parquet(f"{SMALL}/region.parquet"), "orders": spark.read.parquet(f"{SMALL}/orders.parquet")}
    assert writers.stage_tables(tables, home) == ["region", "orders"]
    writers.stage_tables({"region": tables["region"]}, home)
    assert spark.read.parquet(f"{home}/region").count() == 5  # replaced, not doubled
    writers.stage_tables({"region": tables["region"]}, home, mode="append")
    assert spark.read.parquet(f"{home}/region").count() == 10
    with pytest.raises(readers.EmptyTable):
        writers.stage_tables({"x": tables["region"].where("false")}, home)
    names = writers.load_warehouse(tables, f"{home}/dwh", frozenset({"orders"}))
    assert names == ["dim_region", "fct_orders"]
    assert writers.published_table(spark, f"{home}/dwh", "dim_region").count() == 5


def test_nothing_is_loaded_when_a_check_fails(spark, tmp_path):
    df = spark.createDataFrame([(None,)], "a int")
    with pytest.raises(writers.CheckFailed):
        writers.load_warehouse({"t": df}, str(tmp_path), checks=lambda w: q.Suite().add("t", w["dim_t"], [q.not_null("a")]))
    with pytest.raises(ValueError):
        writers.published_table(spark, str(tmp_path), "dim_t")


def test_a_failed_load_leaves_the_old_tables(spark, tmp_path):
    home = str(tmp_path)
    writers.load_warehouse({"a": spark.range(3), "b": spark.range(3)}, home)
    with pytest.raises(Exception):
        writers.load_warehouse({"a": spark.range(9), "b": spark.range(9).selectExpr("raise_error('x') AS id")}, home)
    assert [writers.published_table(spark, home, n).count() for n in ("dim_a", "dim_b")] == [3, 3]
    writers.load_warehouse({"a": spark.range(4), "b": spark.range(5)}, home)
    assert [writers.published_table(spark, home, n).count() for n in ("dim_a", "dim_b")] == [4, 5]


def test_catalog_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS mill")
    writers.write_table(spark.range(3), "mill", "dim_x", source="catalog")
    writers.write_table(spark.range(2), "mill", "dim_x", source="catalog")
    assert readers.read_table(spark, "dim_x", "catalog", "mill").count() == 2
    assert [r.table_name for r in readers.list_tables(spark, "mill").collect()] == ["dim_x"]


def test_bucketed_tables_join_without_a_shuffle(spark):
    for name in ("left_side", "right_side"):
        writers.write_bucketed(spark.range(1000).selectExpr("id as k", "id * 2 as v"), f"default.{name}", ["k"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_side").join(spark.table("right_side"), "k")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_copy_tables(spark, tmp_path):
    tables = readers.read_tables(spark, ["region", "nation"], location=SMALL)
    assert writers.copy_tables(tables, str(tmp_path)) == ["region", "nation"]
    assert spark.read.parquet(f"{tmp_path}/nation").count() == 25


def test_csv_out(spark, tmp_path):
    writers.write_csv(spark.range(5), f"{tmp_path}/a")
    assert readers.read_csv(spark, f"{tmp_path}/a").count() == 5


def test_run_log(spark, tmp_path):
    path = f"{tmp_path}/log"
    with runlog.RunLog(spark, path) as log:
        assert log.run("staging", "extract", "db", "orders", lambda: 7) == 7
        with pytest.raises(ZeroDivisionError):
            log.run("staging", "load", "db", "orders", lambda: 1 / 0)
        log.run("warehouse", "load", "db", "orders", lambda: None)
    entries = runlog.read_log(spark, path)
    assert entries.count() == 3 and "ZeroDivisionError" in entries.where("status = 'fail'").first().error_msg
    assert rows(runlog.summary(entries), "step", "status", "entries") == [
        ("staging", "fail", 1), ("staging", "success", 1), ("warehouse", "success", 1)]


def test_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert cut_lineage(spark.range(4)).count() == 4
