"""Checks and profiles of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import quality as q
from ..operators.profile import profile_table, profile_tables, value_frequencies
from ..plans.cleaning import illogical_counts
from .base import Inputs, query


def profile_sql(table: str, columns: dict[str, tuple[str, str]]) -> str:
    """The profile of one table in SQL: {column: (type, 'limits' or 'mode')}."""
    parts = []
    for c, (kind, how) in columns.items():
        empty = f"{c} IS NULL OR {c} = ''" if kind == "string" else f"{c} IS NULL"
        limits = how == "limits"
        low = f"CAST(min({c}) AS VARCHAR)" if limits else "CAST(NULL AS VARCHAR)"
        high = f"CAST(max({c}) AS VARCHAR)" if limits else "CAST(NULL AS VARCHAR)"
        mode = "NULL" if limits else (
            f"(SELECT CAST({c} AS VARCHAR) FROM {table} GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)")
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS num_rows, CAST({len(columns)} AS INTEGER) AS num_columns,"
            f" '{kind}' AS data_type, count(*) FILTER ({empty}) * 100.0::DOUBLE / count(*) AS null_percentage,"
            f" count(DISTINCT {c}) AS distinct_values, count(*) - count(DISTINCT {c}) AS duplicate_count,"
            f" {low} AS \"min\", {high} AS \"max\", CAST({mode} AS VARCHAR) AS \"mode\" FROM {table}"
        )
    return "\nUNION ALL ".join(parts)


CUSTOMER = {
    "c_custkey": ("bigint", "limits"), "c_name": ("string", "mode"), "c_nationkey": ("int", "limits"),
    "c_acctbal": ("double", "limits"), "c_mktsegment": ("string", "mode"),
}
ORDERS = {
    "o_orderkey": ("bigint", "limits"), "o_custkey": ("bigint", "limits"), "o_orderstatus": ("string", "mode"),
    "o_totalprice": ("double", "limits"), "o_orderdate": ("timestamp_ntz", "limits"), "o_orderpriority": ("string", "mode"),
}
PART = {
    "p_partkey": ("bigint", "limits"), "p_name": ("string", "mode"), "p_brand": ("string", "mode"),
    "p_type": ("string", "mode"), "p_size": ("int", "limits"), "p_retailprice": ("double", "limits"),
}

# Columns and types of the other tables; numbers and times have limits, text has a mode.
OTHERS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "lineitem": "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_quantity double, l_extendedprice double,"
    " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def columns_of(text: str) -> dict[str, tuple[str, str]]:
    pairs = [c.split() for c in text.split(",")]
    return {name: (kind, "mode" if kind == "string" else "limits") for name, kind in pairs}


PROFILED = {"customer": CUSTOMER, "orders": ORDERS, "part": PART, **{n: columns_of(c) for n, c in OTHERS.items()}}
PROFILED["embeddings"] = columns_of("vec_id bigint, label int")  # vectors have neither limits nor a mode


@query("profile_columns", profile_sql("customer", CUSTOMER))
def profile_columns(t: Inputs):
    return profile_table(t.customer, "customer")


@query("profile_all_tables", "\nUNION ALL ".join(profile_sql(n, c) for n, c in PROFILED.items()).replace(
    "FROM embeddings", "FROM (SELECT vec_id, label FROM embeddings)"))
def profile_all_tables(t: Inputs):
    return profile_tables({n: t[n].drop("embedding") for n in PROFILED})


@query("value_sets", """
SELECT 'event_type' AS column_name, event_type AS value, count(*) AS n FROM events GROUP BY 2
UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR), count(*) FROM events GROUP BY 2
UNION ALL SELECT 'props', props, count(*) FROM events GROUP BY 2
UNION ALL SELECT 'event_id', CAST(event_id AS VARCHAR), count(*) FROM events GROUP BY 2
UNION ALL SELECT 'ts', CAST(ts AS VARCHAR), count(*) FROM events GROUP BY 2
UNION ALL SELECT 'value', CAST(value AS VARCHAR), count(*) FROM events GROUP BY 2""")
def value_sets(t: Inputs):
    return value_frequencies(t.events)


@query("illogical_values", r"""
SELECT count(*) FILTER (regexp_matches(text, '^(?:[^A-Za-z])')) AS text, count(*) FILTER (regexp_matches(source, '^(?:src1)')) AS source,
  count(*) FILTER (regexp_matches(lang, '^(?:e)')) AS lang FROM documents""")
def illogical_values(t: Inputs):
    return illogical_counts(t.documents, {"text": "[^A-Za-z]", "source": "src1", "lang": "e"})


ORDER_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.IntegerType(), False), T.StructField("o_custkey", T.LongType(), False),
    T.StructField("o_orderstatus", T.StringType(), False), T.StructField("o_orderpriority", T.StringType(), True),
])


@query("dq_suite", """
WITH f AS (SELECT l.*, o_orderdate, CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d1, CAST(l_shipdate AS DATE) AS d2
  FROM lineitem l LEFT JOIN orders ON l_orderkey = o_orderkey)
SELECT *, failures = 0 AS passed FROM (
SELECT 'orders' AS table_name, 'not_null:o_orderkey' AS check_name, count(*) FILTER (o_orderkey IS NULL) AS failures FROM orders
UNION ALL SELECT 'orders', 'not_null:o_custkey', count(*) FILTER (o_custkey IS NULL) FROM orders
UNION ALL SELECT 'orders', 'not_null:o_orderstatus', count(*) FILTER (o_orderstatus IS NULL) FROM orders
UNION ALL SELECT 'orders', 'type:o_orderkey:int', count(*) FILTER (TRY_CAST(o_orderkey AS INTEGER) IS NULL) FROM orders
UNION ALL SELECT 'orders', 'length:o_orderpriority', count(*) FILTER (length(o_orderpriority) > 8) FROM orders
UNION ALL SELECT 'orders', 'not_negative:o_totalprice', count(*) FILTER (o_totalprice < 0) FROM orders
UNION ALL SELECT 'orders', 'unique:o_orderkey', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1))
UNION ALL SELECT 'orders', 'primary_key:o_orderkey', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1 OR o_orderkey IS NULL))
UNION ALL SELECT 'orders', 'foreign_key:o_custkey', (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'lineitem', 'date_order:d1,d2', count(*) FILTER (coalesce(d1, DATE '9999-12-31') > coalesce(d2, DATE '9999-12-31')) FROM f
UNION ALL SELECT 'lineitem', 'rule:price_above_1000', count(*) FILTER (NOT (l_extendedprice > 1000)) FROM f
UNION ALL SELECT 'lineitem', 'pattern:l_returnflag', count(*) FILTER (NOT regexp_matches(l_returnflag, '^[AR]$')) FROM f
UNION ALL SELECT 'lineitem', 'primary_key:l_orderkey,l_linenumber', (SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
UNION ALL SELECT 'customer', 'not_negative:c_acctbal', count(*) FILTER (c_acctbal < 0) FROM customer)""")
def dq_suite(t: Inputs):
    from ..operators.lookups import left_lookup

    lines = left_lookup(t.lineitem, t.orders, {"o_orderkey": "l_orderkey"}, {"o_orderdate": "o_orderdate"}).withColumns({
        "d1": F.when(F.col("l_returnflag") != "N", F.to_date("o_orderdate")), "d2": F.to_date("l_shipdate"),
    })
    suite = q.Suite()
    suite.add(
        "orders", t.orders,
        [*q.schema_checks(t.orders, ORDER_SCHEMA, {"o_orderpriority": 8}), q.not_negative("o_totalprice")],
        [q.unique(t.orders, "o_orderkey"), q.primary_key(t.orders, "o_orderkey"),
         q.foreign_key(t.orders, t.customer, {"o_custkey": "c_custkey"})],
    )
    suite.add(
        "lineitem", lines,
        [q.date_order("d1", "d2"), q.rule("price_above_1000", F.col("l_extendedprice") > 1000), q.pattern("l_returnflag", "^[AR]$")],
        [q.primary_key(t.lineitem, "l_orderkey", "l_linenumber")],
    )
    suite.add("customer", t.customer, [q.not_negative("c_acctbal")])
    return suite.report()


@query("dq_fk_orphans", """
SELECT DISTINCT l_partkey * 2 AS part_ref FROM lineitem WHERE l_partkey * 2 NOT IN (SELECT p_partkey FROM part)""")
def dq_fk_orphans(t: Inputs):
    """References to a doubled part key, of which the upper half does not exist."""
    refs = t.lineitem.select((F.col("l_partkey") * 2).alias("part_ref"))
    return q.foreign_key(refs, t.part, {"part_ref": "p_partkey"}).failures.select("part_ref")


@query("dq_date_order", """
SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS d1, CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) - 30 END AS d2
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE CAST(o_orderdate AS DATE) > coalesce(CASE WHEN l_returnflag <> 'N' THEN CAST(l_shipdate AS DATE) - 30 END, DATE '9999-12-31')""")
def dq_date_order(t: Inputs):
    from ..operators.lookups import left_lookup

    lines = left_lookup(t.lineitem, t.orders, {"o_orderkey": "l_orderkey"}, {"d1": F.to_date("o_orderdate")})
    lines = lines.withColumn("d2", F.when(F.col("l_returnflag") != "N", F.date_sub(F.to_date("l_shipdate"), 30)))
    return lines.where(q.date_order("d1", "d2").broken).select("l_orderkey", "l_linenumber", "l_partkey", "d1", "d2")


@query("dq_policy", """
SELECT c_custkey, list_filter([
  CASE WHEN length(w) < 8 THEN 'at least 8 characters' END, CASE WHEN NOT regexp_matches(w, '[0-9]') THEN 'at least 1 digit' END,
  CASE WHEN NOT regexp_matches(w, '[A-Z]') THEN 'at least 1 capital letter' END,
  CASE WHEN NOT regexp_matches(w, '[a-z]') THEN 'at least 1 small letter' END], lambda x: x IS NOT NULL).array_to_string('; ') AS failures
FROM (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN lower(c_mktsegment) WHEN c_acctbal < 2000 THEN c_mktsegment ELSE c_name END AS w FROM customer)""")
def dq_policy(t: Inputs):
    word = F.when(F.col("c_acctbal") < 0, F.lower("c_mktsegment")).when(F.col("c_acctbal") < 2000, F.col("c_mktsegment"))
    people = t.customer.select("c_custkey", word.otherwise(F.col("c_name")).alias("word"))
    good, bad = q.split_by(people, q.password_failures("word"))
    return good.select("c_custkey", F.lit("").alias("failures")).unionByName(
        bad.select("c_custkey", F.array_join("failures", "; ").alias("failures")))


@query("dq_cascade", """
WITH gone AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'),
go AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (FROM gone))
SELECT 'customer' AS table_name, count(*) AS left_rows FROM customer WHERE c_custkey NOT IN (FROM gone)
UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderkey NOT IN (FROM go)
UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_orderkey NOT IN (FROM go)""")
def dq_cascade(t: Inputs):
    removed = t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    left = q.cascade_delete(
        {"customer": t.customer, "orders": t.orders, "lineitem": t.lineitem},
        [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey")],
        "customer", removed,
    )
    counts = [df.agg(F.count(F.lit(1)).alias("left_rows")).select(F.lit(n).alias("table_name"), "left_rows") for n, df in left.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# People with a sponsor among them and an order that brought them in; both references close circles.
PEOPLE = """people AS (
  SELECT c_custkey, CASE WHEN c_custkey % 4 > 0 THEN c_custkey // 3 END AS sponsor, CASE WHEN c_custkey % 5 = 0 THEN c_custkey * 7 END AS origin FROM customer)"""

GONE = f"""{PEOPLE},
links AS (
  SELECT 'customer' AS parent, o_custkey AS parent_key, 'orders' AS child, o_orderkey AS child_key FROM orders
  UNION ALL SELECT 'customer', sponsor, 'customer', c_custkey FROM people
  UNION ALL SELECT 'orders', origin, 'customer', c_custkey FROM people),
gone AS (
  SELECT 'customer' AS table_name, c_custkey AS key FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 3
  UNION SELECT child, child_key FROM gone JOIN links ON table_name = parent AND key = parent_key)"""


def deleted(t: Inputs) -> q.Cascade:
    """Some customers go, with those they sponsor, their orders, and the customers whom these brought in."""
    key = F.col("c_custkey")
    people = t.customer.withColumns({
        "sponsor": F.when(key % 4 > 0, F.floor(key / 3)), "origin": F.when(key % 5 == 0, key * 7)})
    references = [
        q.Reference("orders", ("o_custkey",), "customer", ("c_custkey",)),
        q.Reference("customer", ("sponsor",), "customer", ("c_custkey",)),
        q.Reference("customer", ("origin",), "orders", ("o_orderkey",)),
        q.Reference("lineitem", ("l_orderkey",), "orders", ("o_orderkey",)),
    ]
    return q.cascade_graph(
        {"customer": people, "orders": t.orders, "lineitem": t.lineitem},
        {"customer": ["c_custkey"], "orders": ["o_orderkey"], "lineitem": ["l_orderkey", "l_linenumber"]},
        references, {"customer": people.where("c_mktsegment = 'BUILDING' AND c_nationkey = 3")},
        [q.Reference("lineitem", ("l_suppkey",), "customer", ("c_custkey",))],
    )


@query("dq_cascade_graph", f"""
WITH RECURSIVE {GONE}
SELECT table_name, key, CAST(NULL AS INTEGER) AS part FROM gone
UNION ALL SELECT DISTINCT 'lineitem', l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT key FROM gone WHERE table_name = 'orders')""")
def dq_cascade_graph(t: Inputs):
    """The keys of all rows that go (a key that repeats once), over a table that refers to itself and a circle of two tables."""
    gone = deleted(t).gone
    none = F.lit(None).cast("int").alias("part")
    return (
        gone["customer"].select(F.lit("customer").alias("table_name"), F.col("c_custkey").alias("key"), none)
        .unionByName(gone["orders"].select(F.lit("orders").alias("table_name"), F.col("o_orderkey").alias("key"), none))
        .unionByName(gone["lineitem"].select(F.lit("lineitem").alias("table_name"), F.col("l_orderkey").alias("key"), F.col("l_linenumber").alias("part")))
    )


@query("dq_cascade_blocked", f"""
WITH RECURSIVE {GONE}
SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey IN (SELECT key FROM gone WHERE table_name = 'customer')
  AND l_orderkey NOT IN (SELECT key FROM gone WHERE table_name = 'orders')""")
def dq_cascade_blocked(t: Inputs):
    """Lines that stay and name a customer who goes (as a supplier), where that reference allows no delete."""
    (lines,) = deleted(t).blocked.values()
    return lines.select("l_orderkey", "l_linenumber", "l_suppkey")


@query("dq_blocked_deletes", """
SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_custkey IN (SELECT o_custkey FROM orders)""")
def dq_blocked_deletes(t: Inputs):
    removed = t.customer.where(F.col("c_mktsegment") == "MACHINERY").select("c_custkey")
    return q.blocked_deletes(t.orders, "o_custkey", removed, "c_custkey")
