"""Tables written by the sinks and read again by the sources."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from ..operators.reconcile import reconcile
from ..session import scratch_path
from ..sinks import runlog, writers
from ..sources import readers
from .base import TABLE_NAMES, Inputs, query

ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


@query("csv_declared", ORDERS)
def csv_declared(t: Inputs):
    """Orders through CSV files, read into the declared columns."""
    home = scratch_path(t.spark, "csv")
    writers.write_csv(t.orders, home)
    return readers.read_csv_strict(t.spark, home, t.orders.schema, not_null=["o_orderkey"])


@query("csv_text", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer")
def csv_text(t: Inputs):
    """Customers through CSV files, read as text."""
    home = scratch_path(t.spark, "csv")
    writers.write_csv(t.customer.drop("c_acctbal"), home)
    return readers.read_csv(t.spark, home, infer=False)


@query("csv_inferred", "SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_size, p_retailprice FROM part")
def csv_inferred(t: Inputs):
    """Parts through CSV files whose types are inferred; the types found are asked for, so a wrong guess fails."""
    home = scratch_path(t.spark, "csv")
    writers.write_csv(t.part.drop("p_type"), home)
    return readers.read_csv(t.spark, home)


@query("csv_bad_rows", "SELECT event_id, user_id, value FROM events WHERE event_type <> 'error'")
def csv_bad_rows(t: Inputs):
    """Events whose value is no number in the file for one kind of event: those rows are left out."""
    home = scratch_path(t.spark, "csv")
    value = F.when(F.col("event_type") == "error", F.lit("unknown")).otherwise(F.col("value").cast("string"))
    writers.write_csv(t.events.where("event_type IS NOT NULL").select("event_id", "user_id", value.alias("value")), home)
    return readers.read_csv_skipping_bad_rows(t.spark, home, "event_id bigint, user_id bigint, value double")


@query("staged_appends", ORDERS)
def staged_appends(t: Inputs):
    """Orders staged in two loads, the second appended, through ORC; a first load that is overwritten leaves nothing."""
    home, where = scratch_path(t.spark, "staging"), {"source": "orc"}
    finished = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    writers.stage_tables({"orders.orc": t.orders}, home, **where)
    writers.stage_tables({"orders.orc": t.orders.where(finished)}, home, **where)
    writers.stage_tables({"orders.orc": t.orders.where(~finished)}, home, mode="append", **where)
    return readers.read_tables(t.spark, ["orders"], location=home, **where)["orders"]


@query("catalog_tables", "SELECT 'part' AS table_name, p_brand AS label, count(*) AS n FROM part GROUP BY ALL UNION ALL SELECT 'supplier', NULL, count(*) FROM supplier")
def catalog_tables(t: Inputs):
    """Two tables materialised in a database of the catalog, found by its list of tables."""
    database = f"mill_{uuid.uuid4().hex}"
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(t.spark, 'database')}'")
    for name in ("part", "supplier"):
        writers.write_table(t[name], database, name, source="catalog")
    parts = []
    for row in readers.list_tables(t.spark, database).collect():  # names only
        table = readers.read_table(t.spark, row.table_name, "catalog", database)
        label = F.col("p_brand") if "p_brand" in table.columns else F.lit(None).cast("string")
        parts.append(table.groupBy(F.lit(row.table_name).alias("table_name"), label.alias("label")).agg(F.count("*").alias("n")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("published_counts", """
SELECT 'dim_customer' AS table_name, c_mktsegment AS label, count(*) AS n FROM customer GROUP BY ALL
UNION ALL SELECT 'fct_orders', o_orderstatus, count(*) FROM orders GROUP BY ALL""")
def published_counts(t: Inputs):
    """A warehouse published twice: facts and dimensions of the second version, under their warehouse names."""
    home, facts = scratch_path(t.spark, "warehouse"), frozenset({"orders"})
    writers.load_warehouse({"customer": t.customer.where("c_custkey % 2 = 0"), "orders": t.orders.where("o_orderkey % 2 = 0")}, home, facts)
    names = writers.load_warehouse({"customer": t.customer, "orders": t.orders}, home, facts)
    parts = []
    for name, label in zip(names, ("c_mktsegment", "o_orderstatus")):
        table = writers.published_table(t.spark, home, name)
        parts.append(table.groupBy(F.lit(name).alias("table_name"), F.col(label).alias("label")).agg(F.count("*").alias("n")))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("tables_copied", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS same, 0::BIGINT AS changed, 0::BIGINT AS missing, 0::BIGINT AS extra, "
    f"CASE WHEN count(*) > 0 THEN 'success' ELSE 'fail' END AS status FROM {n}" for n in TABLE_NAMES))
def tables_copied(t: Inputs):
    """All tables extracted as they are, each copy compared with its table, row by row, beside its line in the run log."""
    home = scratch_path(t.spark, "copies")
    with runlog.RunLog(t.spark, f"{home}/log") as log:
        for name in TABLE_NAMES:
            try:
                log.run("staging", "extract", "files", name, lambda: writers.copy_tables({name: t[name]}, f"{home}/tables"))
            except readers.EmptyTable:
                continue  # logged as failed; the others are copied all the same
    reports = []
    for name in TABLE_NAMES:
        copy = t.spark.read.schema(t[name].schema).parquet(f"{home}/tables/{name}")
        reports.append(reconcile(t[name], copy).select(F.lit(name).alias("table_name"), "*"))
    report = reduce(lambda a, b: a.unionByName(b), reports)
    entries = runlog.read_log(t.spark, f"{home}/log")
    return report.join(entries.select("table_name", "status"), "table_name")
