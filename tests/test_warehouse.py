from pyspark.sql import functions as F

from conftest import SMALL, rows
from millrace.operators.history import current_rows
from millrace.plans import calendar
from millrace.plans.warehouse import ORDER_MART, hash_tables, order_mart_checks, run_investment_warehouse, run_order_mart
from millrace.queries import Inputs
from millrace.queries.facts import event_sources, order_sources
from millrace.sinks.runlog import RunLog, read_log
from millrace.sinks.writers import published_table

RUN1, RUN2 = "2025-01-01 00:00:00", "2025-02-01 00:00:00"


def small_sources(spark):
    t = Inputs(spark, SMALL)
    sources = order_sources(t)
    few = t.customer.limit(20).select(F.col("c_custkey").alias("customer_id"))
    sources["cust_order"] = sources["cust_order"].join(few, "customer_id", "left_semi")
    keys = sources["cust_order"].select("order_id")
    for name in ("order_line", "order_history"):
        sources[name] = sources[name].join(keys, "order_id", "left_semi").distinct()
    sources["author"] = t.supplier.select(F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("author_name"))
    sources["book_author"] = t.lineitem.select(F.col("l_suppkey").alias("author_id"), F.col("l_partkey").alias("book_id")).distinct()
    dim_date = calendar.mart_date_dimension(calendar.days_of(t.orders, "o_orderdate"))
    return sources, dim_date


def test_the_declared_checks_are_complete():
    kinds = {"not_null": 0, "unique": 0, "primary_key": 0, "foreign_key": 0, "not_negative": 0, "date_order": 0}
    for spec in ORDER_MART.values():
        single = len(spec.key) == 1
        kinds["not_null"] += len(dict.fromkeys([*(spec.key if single else ()), *spec.foreign, *spec.not_null]))
        kinds["unique"] += single
        kinds["primary_key"] += 1
        kinds["foreign_key"] += len(spec.foreign)
        kinds["not_negative"] += len(spec.not_negative)
        kinds["date_order"] += len(spec.ordered)
    assert kinds == {"not_null": 34, "unique": 8, "primary_key": 9, "foreign_key": 9, "not_negative": 6, "date_order": 3}


def test_two_runs_of_the_order_mart(spark, tmp_path):
    sources, dim_date = small_sources(spark)
    home = f"{tmp_path}/mart"
    with RunLog(spark, f"{tmp_path}/log") as log:
        report = run_order_mart(spark, sources, home, 0, RUN1, log, dim_date)
        assert report.count() == 69
        changed = dict(sources)
        changed["address"] = sources["address"].withColumn(
            "city", F.when(F.col("address_id") == 3, "MOVED").otherwise(F.col("city"))
        ).where("address_id != 4")
        run_order_mart(spark, changed, home, 1, RUN2, log, dim_date)
    first, second = (spark.read.parquet(f"{home}/run={r:06d}/dim_address") for r in (0, 1))
    assert (first.count(), second.count(), current_rows(second).count()) == (25, 26, 24)
    assert rows(second.where("nk_address_id = 3"), "city", F.col("valid_to").isNull().alias("open")) == [
        ("MOVED", True), ("NATION_3", False)]
    # the fact joins current addresses only, so no order line is repeated
    lines = current_rows(spark.read.parquet(f"{home}/run=000001/fct_book_order"))
    assert lines.groupBy("sk_line_id").count().where("count > 1").where("sk_line_id is not null").count() == \
        current_rows(spark.read.parquet(f"{home}/run=000000/fct_book_order")).groupBy("sk_line_id").count().where("count > 1").count()
    assert read_log(spark, f"{tmp_path}/log").where("status = 'success'").count() == 2 * len(ORDER_MART)
    assert order_mart_checks({n: spark.read.parquet(f"{home}/run=000000/{n}") for n in ORDER_MART}).report().where(
        "check_name = 'primary_key:sk_date_id'").first().passed


def test_investment_warehouse(spark, tmp_path):
    sources = event_sources(Inputs(spark, SMALL))
    sources = {n: df.select(*[F.col(c).cast("string") if df.schema[c].dataType.simpleString() == "void" else c for c in df.columns]) for n, df in sources.items()}
    with RunLog(spark, f"{tmp_path}/log") as log:
        names = run_investment_warehouse(
            spark, sources, f"{tmp_path}/staging", f"{tmp_path}/dwh", log, run_time=RUN1, calendar=("1995-01-01", "1995-12-31"))
    assert "fct_startup_event" in names and "dim_company" in names and len(names) == 12
    events = published_table(spark, f"{tmp_path}/dwh", "fct_startup_event")
    assert events.where("startup_event_id is null or event_type_id is null").isEmpty()
    labels = published_table(spark, f"{tmp_path}/dwh", "dim_event_type")
    assert events.join(labels, "event_type_id", "left_anti").isEmpty() and labels.count() == 7
    assert published_table(spark, f"{tmp_path}/dwh", "dim_date").count() == 365


def test_hashes_of_several_tables(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    out = hash_tables({"x": df, "y": df}, {"x": ["k", "v"]})
    assert "row_hash" in out["x"].columns and "row_hash" not in out["y"].columns
