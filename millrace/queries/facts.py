"""Dimension and fact builds on the given tables, mapped to the source schemas of the warehouses."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import minute_of_day
from ..operators.shape import stack_tables
from ..plans import dimensions as d
from ..plans import facts as f
from ..plans.calendar import days_of, mart_date_dimension, time_dimension
from ..plans.warehouse import ORDER_MART, order_mart, order_mart_checks
from ..session import scratch_path
from ..sinks.writers import stage_tables
from .base import Inputs, query


def order_sources(t: Inputs) -> dict:
    """Orders, lines and customers in the columns of the order warehouse.

    Addresses are nations, the shipping method is the priority digit, the order history are the
    line flags on their ship dates, books are parts.
    """
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    methods = t.orders.select(digit.alias("method_id"), F.substring("o_orderpriority", 3, 20).alias("method_name")).distinct()
    state = F.when(F.col("l_returnflag") == "R", 6).when(F.col("l_linestatus") == "F", 4).otherwise(1)
    states = t.spark.createDataFrame(list(enumerate(f.ORDER_STATES, 1)), "status_id int, status_value string")
    return {
        "cust_order": t.orders.select(
            F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("order_date"),
            F.col("o_custkey").alias("customer_id"), digit.alias("shipping_method_id"), digit.alias("dest_address_id"),
        ),
        "order_history": t.lineitem.select(
            F.col("l_orderkey").alias("order_id"), state.alias("status_id"), F.col("l_shipdate").alias("status_date")
        ),
        "order_status": states,
        "customer_address": t.customer.select(
            F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("address_id"),
            F.when(F.col("c_acctbal") < 0, 2).otherwise(1).alias("status_id"),
        ),
        "address_status": t.spark.createDataFrame([(1, "Active"), (2, "Inactive")], "status_id int, address_status string"),
        "shipping_method": methods.withColumn("cost", F.col("method_id") * 1.5),
        "order_line": t.lineitem.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"), F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("book_id"), F.col("l_extendedprice").alias("price"),
        ),
        "customer": t.customer.select(
            F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("first_name"),
            F.col("c_name").alias("last_name"), F.lower("c_name").alias("email"),
        ),
        "address": t.nation.select(
            F.col("n_nationkey").alias("address_id"), F.col("n_name").alias("street_name"), F.col("n_name").alias("city"),
            F.col("n_regionkey").alias("country_id"),
        ),
        "country": t.region.select(F.col("r_regionkey").alias("country_id"), F.col("r_name").alias("country_name")),
        "book": t.part.select(
            F.col("p_partkey").alias("book_id"), F.col("p_name").alias("title"), F.col("p_type").alias("isbn13"),
            F.col("p_size").alias("language_id"), F.col("p_size").alias("num_pages"),
            F.lit(None).cast("date").alias("publication_date"), F.col("p_brand").alias("publisher_id"),
        ),
        "publisher": t.part.select(F.col("p_brand").alias("publisher_id"), F.lower("p_brand").alias("publisher_name")).distinct(),
        "book_language": t.part.select(
            F.col("p_size").alias("language_id"), F.col("p_size").cast("string").alias("language_code"),
            F.concat(F.lit("lang "), F.col("p_size").cast("string")).alias("language_name"),
        ).distinct(),
    }


FACT_SQL = """
WITH h AS (SELECT l_orderkey, CAST(l_shipdate AS DATE) AS sd, strftime(l_shipdate, '%H:%M:%S') AS st,
  CASE WHEN l_returnflag = 'R' THEN 6 WHEN l_linestatus = 'F' THEN 4 ELSE 1 END AS s FROM lineitem),
p AS (SELECT l_orderkey, max(sd) FILTER (s = 1) AS order_received_date, max(st) FILTER (s = 1) AS order_received_time,
  max(sd) FILTER (s = 4) AS delivered_date, max(st) FILTER (s = 4) AS delivered_time,
  max(sd) FILTER (s = 6) AS returned_date, max(st) FILTER (s = 6) AS returned_time FROM h GROUP BY 1)
SELECT md5(coalesce(CAST(l.l_orderkey * 10 + l_linenumber AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS sk_line_id, md5(CAST(o_custkey AS VARCHAR)) AS sk_customer_id,
  md5(substr(o_orderpriority, 1, 1)) AS sk_address_id, md5(CAST(l_partkey AS VARCHAR)) AS sk_book_id,
  md5(CAST(CAST(o_orderdate AS DATE) AS VARCHAR)) AS sk_date_id, CAST(hour(o_orderdate) * 60 + minute(o_orderdate) AS INTEGER) AS time_id,
  o_orderkey AS nk_order_id, CAST(o_orderdate AS DATE) AS order_date, strftime(o_orderdate, '%H:%M:%S') AS order_time,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS nk_shipping_method_id, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS nk_dest_address_id,
  order_received_date, order_received_time, CAST(NULL AS DATE) AS pending_delivery_date, CAST(NULL AS VARCHAR) AS pending_delivery_time,
  CAST(NULL AS DATE) AS delivery_in_progress_date, CAST(NULL AS VARCHAR) AS delivery_in_progress_time, delivered_date, delivered_time,
  CAST(NULL AS DATE) AS cancelled_date, CAST(NULL AS VARCHAR) AS cancelled_time, returned_date, returned_time,
  CAST(CASE WHEN c_custkey IS NULL THEN NULL WHEN c_acctbal < 0 THEN 2 ELSE 1 END AS INTEGER) AS nk_customer_address_status_id,
  CASE WHEN c_custkey IS NULL THEN NULL WHEN c_acctbal < 0 THEN 'Inactive' ELSE 'Active' END AS dest_address_status,
  substr(o_orderpriority, 3, 20) AS shipping_method_name, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 1.5::DOUBLE AS shipping_method_cost,
  l.l_orderkey * 10 + l_linenumber AS nk_line_id, l_partkey AS nk_book_id, l_extendedprice AS order_line_price
FROM orders o LEFT JOIN lineitem l ON o_orderkey = l.l_orderkey LEFT JOIN p ON o_orderkey = p.l_orderkey
LEFT JOIN customer ON c_custkey = o_custkey AND c_nationkey = CAST(substr(o_orderpriority, 1, 1) AS INTEGER)"""


@query("fact_assembly", FACT_SQL)
def fact_assembly(t: Inputs):
    dim_date = mart_date_dimension(days_of(t.orders, "o_orderdate"))
    return f.order_lines(order_sources(t), dim_date, time_dimension(t.spark))


@query("order_lifecycle", """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS d, strftime(ts, '%H:%M:%S') AS c, event_type FROM events)
SELECT user_id, max(d) FILTER (event_type = 'signup') AS order_received_date, max(c) FILTER (event_type = 'signup') AS order_received_time,
  max(d) FILTER (event_type = 'view') AS pending_delivery_date, max(c) FILTER (event_type = 'view') AS pending_delivery_time,
  max(d) FILTER (event_type = 'click') AS delivery_in_progress_date, max(c) FILTER (event_type = 'click') AS delivery_in_progress_time,
  max(d) FILTER (event_type = 'purchase') AS delivered_date, max(c) FILTER (event_type = 'purchase') AS delivered_time,
  max(d) FILTER (event_type = 'error') AS cancelled_date, max(c) FILTER (event_type = 'error') AS cancelled_time,
  CAST(NULL AS DATE) AS returned_date, CAST(NULL AS VARCHAR) AS returned_time FROM e GROUP BY 1""")
def order_lifecycle(t: Inputs):
    return f.state_pivot(event_states(t), "user_id", "state", "ts")


@query("order_lifecycle_same_row", """
WITH m AS (SELECT user_id, max(ts) FILTER (event_type = 'signup') AS r, max(ts) FILTER (event_type = 'view') AS p, max(ts) FILTER (event_type = 'click') AS i,
  max(ts) FILTER (event_type = 'purchase') AS d, max(ts) FILTER (event_type = 'error') AS c FROM events GROUP BY 1)
SELECT user_id, CAST(r AS DATE) AS order_received_date, strftime(r, '%H:%M:%S') AS order_received_time,
  CAST(p AS DATE) AS pending_delivery_date, strftime(p, '%H:%M:%S') AS pending_delivery_time,
  CAST(i AS DATE) AS delivery_in_progress_date, strftime(i, '%H:%M:%S') AS delivery_in_progress_time,
  CAST(d AS DATE) AS delivered_date, strftime(d, '%H:%M:%S') AS delivered_time,
  CAST(c AS DATE) AS cancelled_date, strftime(c, '%H:%M:%S') AS cancelled_time,
  CAST(NULL AS DATE) AS returned_date, CAST(NULL AS VARCHAR) AS returned_time FROM m""")
def order_lifecycle_same_row(t: Inputs):
    """All six states, date and time of each from its latest moment."""
    return f.state_pivot(event_states(t), "user_id", "state", "ts", same_row=True)


def event_states(t: Inputs):
    names = {"signup": "Order Received", "view": "Pending Delivery", "click": "Delivery In Progress",
             "purchase": "Delivered", "error": "Cancelled"}
    state = F.lit(None).cast("string")
    for event, label in names.items():
        state = F.when(F.col("event_type") == event, label).otherwise(state)
    return t.events.select("user_id", state.alias("state"), "ts")


BEHAVIOUR_SQL = """
WITH o AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d,
  CAST(lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE) AS p FROM orders),
a AS (SELECT *, (12 * year(d) + month(d)) - (12 * year(p) + month(p)) - CAST(day(d) < day(p) AS INTEGER) AS m,
  day(d) - day(p) + CASE WHEN day(d) < day(p) THEN day(last_day(p)) ELSE 0 END AS spare FROM o),
g AS (SELECT o_custkey, coalesce(CAST(sum(CAST((m // 12) * 365.25 + (m % 12) * 30 + spare AS DECIMAL(18, 2))) AS DOUBLE) / count(p), 0) AS avg_days_between_orders,
  coalesce(CAST(sum(m) AS DOUBLE) / count(p), 0) AS avg_months_between_orders, coalesce(CAST(sum(m // 12) AS DOUBLE) / count(p), 0) AS avg_years_between_orders,
  max(d) AS last_order_date FROM a GROUP BY 1),
s AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS x FROM lineitem GROUP BY 1),
v AS (SELECT o_custkey, count(DISTINCT l_orderkey) AS order_frequency, CAST(sum(x) AS DOUBLE) / count(x) AS average_order_value
  FROM orders LEFT JOIN s ON o_orderkey = l_orderkey GROUP BY 1)
SELECT md5(CAST(g.o_custkey AS VARCHAR)) AS sk_customer_id, md5(CAST(last_order_date AS VARCHAR)) AS sk_date_id, g.o_custkey AS nk_customer_id,
  avg_days_between_orders, avg_months_between_orders, avg_years_between_orders, last_order_date, order_frequency, average_order_value
FROM g LEFT JOIN v ON g.o_custkey = v.o_custkey"""


@query("customer_behavior", BEHAVIOUR_SQL)
def customer_behavior(t: Inputs):
    sources = order_sources(t)
    dim_date = mart_date_dimension(days_of(t.orders, "o_orderdate"))
    return f.customer_behaviour(sources["cust_order"], sources["order_line"], dim_date)


@query("dimension_build", """
SELECT 'address' AS dim, md5(CAST(n_nationkey AS VARCHAR)) AS sk, concat_ws('|', n_nationkey, n_name, n_name, r_regionkey, r_name) AS attributes
FROM nation LEFT JOIN region ON n_regionkey = r_regionkey
UNION ALL SELECT 'author', md5(CAST(s_suppkey AS VARCHAR)), concat_ws('|', s_suppkey, s_name) FROM supplier
UNION ALL SELECT 'book', md5(CAST(p_partkey AS VARCHAR)), concat_ws('|', p_partkey, p_name, p_type, p_size, p_size, p_brand, lower(p_brand), p_size, 'lang ' || p_size) FROM part
UNION ALL SELECT 'customer', md5(CAST(c_custkey AS VARCHAR)), concat_ws('|', c_custkey, c_mktsegment, c_name, lower(c_name)) FROM customer
UNION ALL SELECT 'bridge', md5(CAST(l_suppkey AS VARCHAR)) || md5(CAST(l_partkey AS VARCHAR)), concat_ws('|', l_suppkey, l_partkey)
FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)""")
def dimension_build(t: Inputs):
    s = order_sources(t)
    authors = t.supplier.select(F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("author_name"))
    pairs = t.lineitem.select(F.col("l_suppkey").alias("author_id"), F.col("l_partkey").alias("book_id")).distinct()
    dims = {
        "address": d.address_dimension(s["address"], s["country"]),
        "author": d.author_dimension(authors),
        "book": d.book_dimension(s["book"], s["publisher"], s["book_language"]),
        "customer": d.customer_dimension(s["customer"]),
    }
    rows = []
    for name, df in dims.items():
        key, *rest = df.columns
        rows.append(df.select(F.lit(name).alias("dim"), F.col(key).alias("sk"), F.concat_ws("|", *rest).alias("attributes")))
    bridge = d.author_bridge(pairs)
    rows.append(bridge.select(F.lit("bridge").alias("dim"), F.concat("sk_author_id", "sk_book_id").alias("sk"),
                              F.concat_ws("|", "nk_author_id", "nk_book_id").alias("attributes")))
    return stack_tables(rows)


def event_sources(t: Inputs) -> dict:
    """The given tables in the columns of the investment warehouse.

    Objects are customers (c:), suppliers (s:) and parts (p:). Orders are acquisitions and funding
    rounds, order lines investments, events the ipos, funds and milestones.
    """
    nothing = F.lit(None).cast("string")

    def obj(prefix, column):
        return F.concat(F.lit(f"{prefix}:"), F.col(column).cast("string"))

    def office(df, prefix, key, name):
        return df.select(F.col(key).alias("office_id"), obj(prefix, key).alias("object_id"), F.col(name).alias("description"),
                         F.lit("x").alias("region"))

    blank = {c: nothing for c in ("address1", "address2", "city", "zip_code", "state_code", "country_code")}
    company = stack_tables([
        office(t.customer, "c", "c_custkey", "c_name"), office(t.supplier, "s", "s_suppkey", "s_name"),
        office(t.part, "p", "p_partkey", "p_name"),
    ]).withColumns({**blank, "latitude": F.lit("1.5"), "longitude": F.lit("2.25")})
    link = {"source_url": nothing, "source_description": nothing}
    events = t.events.withColumns({"object_id": obj("c", "user_id"), **link})
    money = ["raised_amount", "raised_currency_code"]
    rounds = [c for c in d.INVESTMENT_DIMENSIONS["funding_rounds"].hashed if c != "funding_round_nk"]
    return {
        "company": company,
        "acquisition": t.orders.select(
            F.col("o_orderkey").alias("acquisition_id"), obj("c", "o_custkey").alias("acquiring_object_id"),
            obj("p", "o_custkey").alias("acquired_object_id"), F.col("o_orderstatus").alias("term_code"),
            F.col("o_totalprice").cast("decimal(15,2)").alias("price_amount"), F.lit("USD").alias("price_currency_code"),
            F.col("o_orderdate").alias("acquired_at"), F.lit("web").alias("source_url"), F.col("o_orderpriority").alias("source_description"),
        ),
        "ipos": events.where(F.col("event_type") == "signup").select(
            F.col("event_id").alias("ipo_id"), "object_id", F.col("ts").alias("public_at"), *link,
            F.col("value").cast("decimal(15,2)").alias("valuation_amount"), nothing.alias("valuation_currency_code"),
            *[nothing.alias(c) for c in money], F.col("props").alias("stock_symbol"),
        ),
        "funds": events.where(F.col("event_type") == "purchase").select(
            F.col("event_id").alias("fund_id"), "object_id", F.col("ts").alias("funded_at"), *link, F.col("props").alias("name"),
            *[nothing.alias(c) for c in money],
        ),
        "milestones": events.where(F.col("event_type").isin("view", "click", "error")).select(
            F.col("event_id").alias("milestone_id"), "object_id", F.col("ts").alias("milestone_at"), *link,
            F.col("props").alias("description"), F.col("event_type").alias("milestone_code"),
        ),
        "funding_rounds": t.orders.select(
            F.col("o_orderkey").alias("funding_round_id"), F.col("o_orderdate").alias("funded_at"),
            F.lit("web").alias("source_url"), F.col("o_orderpriority").alias("source_description"), *[nothing.alias(c) for c in rounds],
        ),
        "investments": t.lineitem.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("investment_id"), F.col("l_orderkey").alias("funding_round_id"),
            obj("p", "l_partkey").alias("funded_object_id"), obj("s", "l_suppkey").alias("investor_object_id"),
        ),
        "people": t.customer.select(
            obj("c", "c_custkey").alias("object_id"), F.col("c_mktsegment").alias("first_name"), F.col("c_name").alias("last_name"),
            nothing.alias("birthplace"), nothing.alias("affiliation_name"),
        ),
        "relationships": t.orders.select(
            F.col("o_orderkey").alias("relationship_id"), obj("c", "o_custkey").alias("person_object_id"),
            obj("p", "o_custkey").alias("relationship_object_id"), F.col("o_orderdate").alias("start_at"), nothing.alias("end_at"),
            F.lit("true").alias("is_past"), F.lit("7").alias("sequence"), F.col("o_orderpriority").alias("title"),
        ),
    }


def _texts(columns: str) -> str:
    """SQL: the columns as text, 'null' for null."""
    return ", ".join(f"coalesce(CAST({c.strip()} AS VARCHAR), 'null')" for c in columns.split(","))


COMPANY_SQL = """
company AS (SELECT object_nk, sha256(concat_ws('||', k, object_nk, nm, 'x', 'null', 'null', 'null', 'null', 'null', 'null', '1.500000', '2.250000')) AS company_id FROM (
  SELECT c_custkey AS k, 'c:' || c_custkey AS object_nk, c_name AS nm FROM customer
  UNION ALL SELECT s_suppkey, 's:' || s_suppkey, s_name FROM supplier
  UNION ALL SELECT p_partkey, 'p:' || p_partkey, p_name FROM part))
"""
EVENT_SQL = f"""
WITH {COMPANY_SQL},
acq AS (SELECT *, sha256(concat_ws('||', o_orderkey, 'c:' || o_custkey, 'p:' || o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15, 2)), 'USD')) AS acquisition_id FROM orders),
fr AS (SELECT *, sha256(concat_ws('||', o_orderkey, {", ".join(["'null'"] * 15)})) AS funding_rounds_id FROM orders),
e AS (
  SELECT acquisition_id, NULL AS ipos_id, NULL AS funds_id, NULL AS funding_rounds_id, NULL AS milestones_id, 'Acquiring' AS et, 'c:' || o_custkey AS object_nk,
    CAST(o_orderkey AS VARCHAR) AS acquisition_nk, NULL AS ipo_nk, NULL AS fund_nk, NULL AS investment_nk, NULL AS funding_round_nk, NULL AS milestone_nk,
    o_orderdate AS event_datetime, 'web' AS source_url, o_orderpriority AS source_description FROM acq
  UNION ALL SELECT acquisition_id, NULL, NULL, NULL, NULL, 'Acquired', 'p:' || o_custkey, CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL, NULL, NULL, o_orderdate, 'web', o_orderpriority FROM acq
  UNION ALL SELECT NULL, sha256(concat_ws('||', event_id, CAST(value AS DECIMAL(15, 2)), 'null', 'null', 'null', props)), NULL, NULL, NULL, 'IPO', 'c:' || user_id,
    NULL, CAST(event_id AS VARCHAR), NULL, NULL, NULL, NULL, ts, NULL, NULL FROM events WHERE event_type = 'signup'
  UNION ALL SELECT NULL, NULL, sha256(concat_ws('||', event_id, props, 'null', 'null')), NULL, NULL, 'Funds', 'c:' || user_id,
    NULL, NULL, CAST(event_id AS VARCHAR), NULL, NULL, NULL, ts, NULL, NULL FROM events WHERE event_type = 'purchase'
  UNION ALL SELECT NULL, NULL, NULL, NULL, sha256(concat_ws('||', event_id, props, event_type)), 'Milestone', 'c:' || user_id,
    NULL, NULL, NULL, NULL, NULL, CAST(event_id AS VARCHAR), ts, NULL, NULL FROM events WHERE event_type IN ('view', 'click', 'error')
  UNION ALL SELECT NULL, NULL, NULL, funding_rounds_id, NULL, 'Received Funding', 'p:' || l_partkey,
    NULL, NULL, NULL, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), CAST(l_orderkey AS VARCHAR), NULL, o_orderdate, 'web', o_orderpriority FROM lineitem LEFT JOIN fr ON l_orderkey = o_orderkey
  UNION ALL SELECT NULL, NULL, NULL, funding_rounds_id, NULL, 'Made Investment', 's:' || l_suppkey,
    NULL, NULL, NULL, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), CAST(l_orderkey AS VARCHAR), NULL, o_orderdate, 'web', o_orderpriority FROM lineitem LEFT JOIN fr ON l_orderkey = o_orderkey),
k AS (SELECT e.*, company_id, sha256(et) AS event_type_id, CAST(event_datetime AS DATE) AS event_date FROM e LEFT JOIN company USING (object_nk))
SELECT sha256(concat_ws('||', {_texts("""company_id, acquisition_id, ipos_id, funds_id, funding_rounds_id, milestones_id, event_type_id, object_nk, acquisition_nk, ipo_nk, fund_nk,
    investment_nk, funding_round_nk, event_datetime, event_date, source_url, source_description""")})) AS startup_event_id,
  sha256(concat_ws('||', {_texts("object_nk, event_type_id, acquisition_nk, ipo_nk, fund_nk, funding_round_nk, investment_nk, milestone_nk")})) AS stable_id,
  acquisition_id, ipos_id, funds_id, funding_rounds_id, milestones_id, company_id, event_type_id, event_datetime, event_date, source_url, source_description FROM k"""


@query("event_fact_union", EVENT_SQL)
def event_fact_union(t: Inputs):
    """The event fact of all seven kinds."""
    sources = event_sources(t)
    dims = {n: d.INVESTMENT_DIMENSIONS[n].build(sources[n]) for n in ("company", "funding_rounds")}
    return f.company_events(sources, dims)


PEOPLE_SQL = """people AS (
  SELECT sha256(concat_ws('||', 'c:' || c_custkey, c_mktsegment, c_name, 'null', 'null')) AS people_id, 'c:' || c_custkey AS people_nk,
    c_mktsegment AS first_name, c_name AS last_name, CAST(NULL AS VARCHAR) AS birthplace, CAST(NULL AS VARCHAR) AS affiliation_name FROM customer)"""
_NONE = "CAST(NULL AS VARCHAR) AS"

# The nine dimensions with all their columns; amounts as text, so that they compare exactly.
DIMENSION_SQL = {
    "company": f"""
WITH {COMPANY_SQL.strip()},
offices AS (
  SELECT c_custkey AS office_nk, 'c:' || c_custkey AS object_nk, c_name AS description FROM customer
  UNION ALL SELECT s_suppkey, 's:' || s_suppkey, s_name FROM supplier
  UNION ALL SELECT p_partkey, 'p:' || p_partkey, p_name FROM part)
SELECT company_id, office_nk, object_nk, description, 'x' AS region, {_NONE} address1, {_NONE} address2, {_NONE} city, {_NONE} zip_code,
  {_NONE} state_code, {_NONE} country_code, '1.500000' AS latitude, '2.250000' AS longitude
FROM offices JOIN company USING (object_nk)""",
    "acquisition": """
SELECT sha256(concat_ws('||', o_orderkey, 'c:' || o_custkey, 'p:' || o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15, 2)), 'USD')) AS acquisition_id,
  o_orderkey AS acquisition_nk, 'c:' || o_custkey AS acquiring_object_nk, 'p:' || o_custkey AS acquired_object_nk, o_orderstatus AS term_code,
  CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) AS price_amount, 'USD' AS price_currency_code FROM orders""",
    "ipos": f"""
SELECT sha256(concat_ws('||', event_id, CAST(value AS DECIMAL(15, 2)), 'null', 'null', 'null', props)) AS ipos_id, event_id AS ipo_nk,
  CAST(CAST(value AS DECIMAL(15, 2)) AS VARCHAR) AS valuation_amount, {_NONE} valuation_currency_code, {_NONE} raised_amount, {_NONE} raised_currency_code,
  props AS stock_symbol FROM events WHERE event_type = 'signup'""",
    "funds": f"""
SELECT sha256(concat_ws('||', event_id, props, 'null', 'null')) AS funds_id, event_id AS fund_nk, props AS name, {_NONE} raised_amount,
  {_NONE} raised_currency_code FROM events WHERE event_type = 'purchase'""",
    "funding_rounds": f"""
SELECT sha256(concat_ws('||', o_orderkey, {", ".join(["'null'"] * 15)})) AS funding_rounds_id, o_orderkey AS funding_round_nk,
  {_NONE} funding_round_type, {_NONE} funding_round_code, {_NONE} raised_amount_usd, {_NONE} raised_amount, {_NONE} raised_currency_code,
  {_NONE} pre_money_valuation_usd, {_NONE} pre_money_valuation, {_NONE} pre_money_currency_code, {_NONE} post_money_valuation_usd,
  {_NONE} post_money_valuation, {_NONE} post_money_currency_code, {_NONE} participants, {_NONE} is_first_round, {_NONE} is_last_round,
  {_NONE} created_by FROM orders""",
    "people": f"WITH {PEOPLE_SQL} SELECT people_id, people_nk, first_name, last_name, birthplace, affiliation_name FROM people",
    "milestones": """
SELECT sha256(concat_ws('||', event_id, props, event_type)) AS milestones_id, event_id AS milestone_nk, props AS description, event_type AS milestone_code
FROM events WHERE event_type IN ('view', 'click', 'error')""",
    "investments": f"""
SELECT sha256(concat_ws('||', l_orderkey * 10 + l_linenumber, l_orderkey, 'p:' || l_partkey, 's:' || l_suppkey)) AS investments_id,
  CASE WHEN o_orderkey IS NOT NULL THEN sha256(concat_ws('||', o_orderkey, {", ".join(["'null'"] * 15)})) END AS funding_rounds_id,
  l_orderkey * 10 + l_linenumber AS investment_nk, l_orderkey AS funding_round_nk, 'p:' || l_partkey AS funded_object_nk,
  's:' || l_suppkey AS investor_object_nk FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey""",
    "relationships": f"""
WITH {COMPANY_SQL.strip()},
{PEOPLE_SQL}
SELECT sha256(concat_ws('||', coalesce(people_id, 'null'), coalesce(company_id, 'null'), o_orderkey, 'c:' || o_custkey, 'p:' || o_custkey,
    CAST(o_orderdate AS VARCHAR), 'null', 'true', '7', o_orderpriority)) AS relationships_id,
  people_id, company_id, o_orderkey AS relationship_nk, 'c:' || o_custkey AS person_object_nk, 'p:' || o_custkey AS relationship_object_nk,
  o_orderdate AS start_at, CAST(NULL AS TIMESTAMP) AS end_at, true AS is_past, CAST(7 AS INTEGER) AS sequence, o_orderpriority AS title
FROM orders LEFT JOIN people ON people_nk = 'c:' || o_custkey LEFT JOIN company ON object_nk = 'p:' || o_custkey""",
}


def _dimension_query(name: str):
    @query(f"dim_{name}", DIMENSION_SQL[name])
    def run(t: Inputs):
        df = d.investment_dimensions(event_sources(t))[name]
        return df.select(*[F.col(c).cast("string") if kind.startswith("decimal") else F.col(c) for c, kind in df.dtypes])

    return run


for _name in DIMENSION_SQL:
    _dimension_query(_name)


@query("investment_dimensions", "UNION ALL ".join(
    f"SELECT '{name}' AS dim, {name}_id AS id FROM ({sql.strip()})\n" for name, sql in DIMENSION_SQL.items()))
def investment_dimensions(t: Inputs):
    """The keys of all nine dimensions."""
    dims = d.investment_dimensions(event_sources(t))
    return stack_tables([df.select(F.lit(n).alias("dim"), F.col(f"{n}_id").alias("id")) for n, df in dims.items()])


@query("events_per_minute_fact", """
SELECT CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS time_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL""")
def events_per_minute_fact(t: Inputs):
    return t.events.groupBy(minute_of_day("ts").alias("time_id"), F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def mart_check_sql() -> str:
    """The declared checks over the mart tables in SQL."""
    tables = {
        "dim_time": "SELECT CAST(unnest(range(1440)) AS INTEGER) AS time_id",
        "dim_date": "SELECT md5(CAST(CAST(d AS DATE) AS VARCHAR)) AS sk_date_id FROM (SELECT unnest(generate_series("
                    "(SELECT min(CAST(o_orderdate AS DATE)) FROM orders), (SELECT max(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY)) AS d)",
        "dim_address": "SELECT md5(CAST(n_nationkey AS VARCHAR)) AS sk_address_id, n_name AS city, r_name AS country_name FROM nation LEFT JOIN region ON n_regionkey = r_regionkey",
        "dim_author": "SELECT md5(CAST(s_suppkey AS VARCHAR)) AS sk_author_id, s_name AS author_name FROM supplier",
        "dim_book": "SELECT md5(CAST(p_partkey AS VARCHAR)) AS sk_book_id, p_name AS title, p_type AS isbn13, p_brand AS publisher_name, p_size AS language_name FROM part",
        "bridge_book_author": "SELECT DISTINCT md5(CAST(l_suppkey AS VARCHAR)) AS sk_author_id, md5(CAST(l_partkey AS VARCHAR)) AS sk_book_id FROM lineitem",
        "dim_customer": "SELECT md5(CAST(c_custkey AS VARCHAR)) AS sk_customer_id, c_mktsegment AS first_name, lower(c_name) AS email FROM customer",
        "fct_book_order": f"SELECT * FROM ({FACT_SQL})",
        "fct_customer_behavior": f"SELECT * FROM ({BEHAVIOUR_SQL})",
    }
    far = "DATE '9999-12-31'"
    parts = []
    for name, spec in ORDER_MART.items():
        key = ", ".join(spec.key)
        nulls = " OR ".join(f"{c} IS NULL" for c in spec.key)
        single = spec.key if len(spec.key) == 1 else ()
        checks = [(f"not_null:{c}", f"SELECT count(*) FROM {name} WHERE {c} IS NULL") for c in dict.fromkeys([*single, *spec.foreign, *spec.not_null])]
        checks += [(f"not_negative:{c}", f"SELECT count(*) FROM {name} WHERE {c} < 0") for c in spec.not_negative]
        checks += [(f"date_order:{a},{b}", f"SELECT count(*) FROM {name} WHERE coalesce({a}, {far}) > coalesce({b}, {far})") for a, b in spec.ordered]
        checks += [(f"unique:{c}", f"SELECT count(*) FROM (SELECT 1 FROM {name} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)") for c in single]
        checks.append((f"primary_key:{key.replace(' ', '')}", f"SELECT count(*) FROM (SELECT 1 FROM {name} GROUP BY {key} HAVING count(*) > 1 OR {nulls})"))
        checks += [(f"foreign_key:{c}", f"SELECT count(DISTINCT {c}) FROM {name} WHERE {c} NOT IN (SELECT {pc} FROM {p})") for c, (p, pc) in spec.foreign.items()]
        parts += [f"SELECT '{name}' AS table_name, '{check}' AS check_name, ({sql}) AS failures" for check, sql in checks]
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in tables.items())
    return f"WITH {ctes}\nSELECT *, failures = 0 AS passed FROM (" + "\nUNION ALL ".join(parts) + ")"


@query("order_mart_checks", mart_check_sql())
def order_mart_checks_query(t: Inputs):
    """The 69 declared checks of the order mart."""
    sources = order_sources(t)
    sources["author"] = t.supplier.select(F.col("s_suppkey").alias("author_id"), F.col("s_name").alias("author_name"))
    sources["book_author"] = t.lineitem.select(F.col("l_suppkey").alias("author_id"), F.col("l_partkey").alias("book_id")).distinct()
    mart = order_mart(sources, mart_date_dimension(days_of(t.orders, "o_orderdate")))
    home = scratch_path(t.spark, "mart")  # written once, read by all checks
    staged = stage_tables(mart, home, options={"compression": "zstd"})
    written = {n: t.spark.read.parquet(f"{home}/{n}") for n in staged}
    return order_mart_checks(written).report()
