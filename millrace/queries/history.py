"""Snapshots and upserts of the customer table.

The second version of the table gives customers in debt another segment, empties the nation of the
BUILDING segment and drops the MACHINERY segment.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.numbers import exact
from ..operators import history as h
from ..operators.asof import as_of_join
from ..operators.shape import add_row_hash
from .base import Inputs, query

RUN1, RUN2, RUN3 = "2025-01-01 00:00:00", "2025-02-01 00:00:00", "2025-03-01 00:00:00"
CHECK = ["c_mktsegment", "c_nationkey"]

VERSIONS = f"""
WITH v1 AS (SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'FURNITURE'),
v2 AS (SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_nationkey END AS c_nationkey,
  CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY'),
h1 AS (SELECT *, TIMESTAMP '{RUN1}' AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to, TIMESTAMP '{RUN1}' AS updated_at,
  md5(c_custkey || '|' || '{RUN1}') AS scd_id FROM v1),
h2 AS (
  SELECT h1.* REPLACE (CASE WHEN v2.c_custkey IS NULL OR h1.c_mktsegment IS DISTINCT FROM v2.c_mktsegment OR h1.c_nationkey IS DISTINCT FROM v2.c_nationkey
      THEN TIMESTAMP '{RUN2}' END AS valid_to,
    CASE WHEN v2.c_custkey IS NULL OR h1.c_mktsegment IS DISTINCT FROM v2.c_mktsegment OR h1.c_nationkey IS DISTINCT FROM v2.c_nationkey
      THEN TIMESTAMP '{RUN2}' ELSE h1.updated_at END AS updated_at)
  FROM h1 LEFT JOIN v2 ON h1.c_custkey = v2.c_custkey
  UNION ALL
  SELECT v2.*, TIMESTAMP '{RUN2}', NULL, TIMESTAMP '{RUN2}', md5(v2.c_custkey || '|' || '{RUN2}')
  FROM v2 LEFT JOIN v1 ON v1.c_custkey = v2.c_custkey
  WHERE v1.c_custkey IS NULL OR v1.c_mktsegment IS DISTINCT FROM v2.c_mktsegment OR v1.c_nationkey IS DISTINCT FROM v2.c_nationkey)
"""


def versions(t: Inputs):
    names = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    v1 = t.customer.where(F.col("c_mktsegment") != "FURNITURE").select(*names)
    v2 = t.customer.where(F.col("c_mktsegment") != "MACHINERY").select(
        "c_custkey", "c_name", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey")).alias("c_nationkey"),
        F.when(F.col("c_acctbal") < 0, "DEBT").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
    )
    return v1, v2


def two_runs(t: Inputs, **options):
    v1, v2 = versions(t)
    return h.snapshot(h.snapshot(None, v1, ["c_custkey"], RUN1), v2, ["c_custkey"], RUN2, CHECK, **options)


@query("snapshot_initial", VERSIONS + "SELECT * FROM h1")
def snapshot_initial(t: Inputs):
    return h.snapshot(None, versions(t)[0], ["c_custkey"], RUN1)


@query("snapshot_changed", VERSIONS + "SELECT * FROM h2")
def snapshot_changed(t: Inputs):
    return two_runs(t)


@query("snapshot_deleted", VERSIONS + f"""
SELECT c_custkey, valid_from, valid_to FROM h2 WHERE valid_to IS NOT NULL AND c_custkey NOT IN (SELECT c_custkey FROM v2)""")
def snapshot_deleted(t: Inputs):
    closed = two_runs(t).where(F.col("valid_to").isNotNull())
    return closed.join(versions(t)[1].select("c_custkey"), "c_custkey", "left_anti").select("c_custkey", "valid_from", "valid_to")


@query("snapshot_current", VERSIONS + "SELECT c_custkey, c_mktsegment, c_nationkey FROM v2")
def snapshot_current(t: Inputs):
    return h.current_rows(two_runs(t)).select("c_custkey", "c_mktsegment", "c_nationkey")


@query("snapshot_reappearing", VERSIONS + f"""
SELECT c_custkey, c_mktsegment, c_nationkey, valid_from, coalesce(valid_to, CASE WHEN c_custkey NOT IN (SELECT c_custkey FROM v1)
  OR (valid_to IS NULL AND EXISTS (SELECT 1 FROM v1 WHERE v1.c_custkey = h2.c_custkey AND (v1.c_mktsegment IS DISTINCT FROM h2.c_mktsegment OR v1.c_nationkey IS DISTINCT FROM h2.c_nationkey)))
  THEN TIMESTAMP '{RUN3}' END) AS valid_to FROM h2
UNION ALL
SELECT v1.c_custkey, v1.c_mktsegment, v1.c_nationkey, TIMESTAMP '{RUN3}', NULL FROM v1 LEFT JOIN v2 ON v1.c_custkey = v2.c_custkey
WHERE v2.c_custkey IS NULL OR v1.c_mktsegment IS DISTINCT FROM v2.c_mktsegment OR v1.c_nationkey IS DISTINCT FROM v2.c_nationkey""")
def snapshot_reappearing(t: Inputs):
    """A third run that goes back to the first version: dropped customers come back as new rows."""
    third = h.snapshot(two_runs(t), versions(t)[0], ["c_custkey"], RUN3)
    return third.select("c_custkey", "c_mktsegment", "c_nationkey", "valid_from", "valid_to")


@query("snapshot_as_of", VERSIONS + "SELECT c_custkey, c_mktsegment FROM v1")
def snapshot_as_of(t: Inputs):
    return h.rows_as_of(two_runs(t), "2025-01-15 00:00:00").select("c_custkey", "c_mktsegment")


@query("snapshot_composite_key", """
WITH a AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'N'),
b AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'A')
SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey,
  a.l_partkey IS NOT NULL AS in_first, b.l_partkey IS NULL AS closed
FROM a FULL JOIN b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey""")
def snapshot_composite_key(t: Inputs):
    """The bridge of parts and suppliers, keyed by both."""
    keys = ["l_partkey", "l_suppkey"]
    grouped = t.lineitem.groupBy(*keys).agg(*[F.bool_or(F.col("l_returnflag") != flag).alias(flag) for flag in "NA"])
    pairs = [grouped.where(flag).select(*keys) for flag in "NA"]
    merged = h.snapshot(h.snapshot(None, pairs[0], keys, RUN1), pairs[1], keys, RUN2)
    first = F.lit(RUN1).cast("timestamp_ntz")
    return merged.select(*keys, (F.col("valid_from") == first).alias("in_first"), F.col("valid_to").isNotNull().alias("closed"))


@query("upsert_by_hash", f"""
WITH v1 AS (SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment <> 'FURNITURE'),
v2 AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY')
SELECT v2.c_custkey, v2.c_mktsegment, sha256(v2.c_custkey || '||' || v2.c_mktsegment) AS row_hash,
  CASE WHEN v1.c_custkey IS NULL THEN TIMESTAMP '{RUN2}' ELSE TIMESTAMP '{RUN1}' END AS created_at,
  CASE WHEN v1.c_mktsegment = v2.c_mktsegment THEN TIMESTAMP '{RUN1}' ELSE TIMESTAMP '{RUN2}' END AS updated_at
FROM v2 LEFT JOIN v1 USING (c_custkey)""")
def upsert_by_hash(t: Inputs):
    v1, v2 = (v.select("c_custkey", "c_mktsegment").transform(add_row_hash, ["c_custkey", "c_mktsegment"], "row_hash") for v in versions(t))
    at = F.lit(RUN1).cast("timestamp_ntz")
    return h.upsert(v1.withColumns({"created_at": at, "updated_at": at}), v2, ["c_custkey"], "row_hash", RUN2)


@query("changed_rows", """
SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment
FROM customer WHERE c_acctbal < 0 AND c_mktsegment NOT IN ('FURNITURE', 'MACHINERY')""")
def changed_rows_query(t: Inputs):
    from ..operators.lookups import changed_rows

    v1, v2 = (v.select("c_custkey", "c_mktsegment") for v in versions(t))
    return changed_rows(v1, v2, ["c_custkey"], "c_mktsegment")


@query("order_snapshot", f"""
SELECT o_orderkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS price, TIMESTAMP '{RUN1}' AS valid_from,
  CASE WHEN o_orderstatus = 'O' THEN TIMESTAMP '{RUN2}' END AS valid_to FROM orders
UNION ALL SELECT o_orderkey, 'F', CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR), TIMESTAMP '{RUN2}', NULL FROM orders WHERE o_orderstatus = 'O'""")
def order_snapshot(t: Inputs):
    """All columns checked: open orders get finished."""
    v1 = t.orders.select("o_orderkey", "o_orderstatus", exact("o_totalprice").cast("string").alias("price"))
    v2 = v1.withColumn("o_orderstatus", F.when(F.col("o_orderstatus") == "O", "F").otherwise(F.col("o_orderstatus")))
    merged = h.snapshot(h.snapshot(None, v1, ["o_orderkey"], RUN1), v2, ["o_orderkey"], RUN2)
    return merged.drop("updated_at", "scd_id")


TIERS = """
yearly AS (SELECT o_custkey, year(o_orderdate) AS y, sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS spent FROM orders GROUP BY ALL),
tiers AS (SELECT o_custkey, make_timestamp(y + 1, 1, 1, 0, 0, 0) AS valid_from, CASE WHEN spent >= 500000 THEN 'gold' WHEN spent >= 200000 THEN 'silver' ELSE 'plain' END AS tier FROM yearly),
kept AS (SELECT * FROM tiers WINDOW w AS (PARTITION BY o_custkey ORDER BY valid_from) QUALIFY coalesce(lag(tier) OVER w <> tier, true)),
history AS (SELECT *, lead(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from) AS valid_to FROM kept)"""


def customer_tiers(t: Inputs):
    """A history of customers: the tier that a year's spending gives from the next year on."""
    yearly = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(F.sum(exact("o_totalprice")).alias("spent"))
    tier = F.when(F.col("spent") >= 500000, "gold").when(F.col("spent") >= 200000, "silver").otherwise("plain")
    start = F.make_timestamp_ntz(F.col("y") + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    tiers = yearly.select("o_custkey", start.alias("valid_from"), tier.alias("tier"))
    w = Window.partitionBy("o_custkey").orderBy("valid_from")
    kept = tiers.withColumn("_before", F.lag("tier").over(w)).where(~F.col("_before").eqNullSafe(F.col("tier"))).drop("_before")
    return kept.withColumn("valid_to", F.lead("valid_from").over(w))


@query("orders_as_of", f"""
WITH {TIERS}
SELECT o_orderkey, o_orderdate, tier, valid_from FROM orders LEFT JOIN history h
  ON h.o_custkey = orders.o_custkey AND h.valid_from <= o_orderdate AND (h.valid_to IS NULL OR o_orderdate < h.valid_to)""")
def orders_as_of(t: Inputs):
    """Every order with its customer's tier on the order date."""
    found = as_of_join(t.orders, customer_tiers(t), ["o_custkey"], "o_orderdate", "valid_from", ["tier", "valid_from"], "valid_to")
    return found.select("o_orderkey", "o_orderdate", "tier", "valid_from")


@query("view_before_event", """
SELECT e.event_id, max(v.ts) AS viewed_at FROM events e LEFT JOIN events v
  ON v.user_id = e.user_id AND v.event_type = 'view' AND v.ts < e.ts GROUP BY 1""")
def view_before_event(t: Inputs):
    """Every event with the time of its user's last view before it."""
    views = t.events.where("event_type = 'view'").select("user_id", F.col("ts").alias("viewed_at"))
    return as_of_join(t.events, views, ["user_id"], "ts", "viewed_at", ["viewed_at"], before=True).select("event_id", "viewed_at")
