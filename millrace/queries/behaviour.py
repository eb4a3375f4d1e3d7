"""Aggregates, rankings, segments and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.dates import calendar_age, month_start, week_start
from ..functions.numbers import exact, exact_mean, exact_sum, yes_flag
from ..operators import aggregates as agg, textindex
from ..operators.lookups import left_lookup
from ..operators.quantiles import describe, describe_by, exact_quantiles
from ..operators.search import keyword_scores
from ..operators.shape import top_rows
from ..operators.windows import previous_date
from ..session import cut_lineage, scratch_path
from .base import Inputs, query

MEAN = "CAST(sum(CAST({0} AS DECIMAL(18, 2))) AS DOUBLE) / count({0})"
SUM = "CAST(sum(CAST({0} AS DECIMAL(18, 2))) AS DOUBLE)"


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(t: Inputs):
    return agg.value_counts(t.events, "event_type")


@query("two_way_counts", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def two_way_counts(t: Inputs):
    return agg.value_counts(t.orders, "o_orderstatus", "o_orderpriority")


@query("histogram", """
WITH r AS (SELECT min(value) AS a, (max(value) - min(value)) / 20 AS w FROM events)
SELECT event_type, CAST(least(floor((value - a) / w), 19) AS INTEGER) AS bin, count(*) AS n,
  a + least(floor((value - a) / w), 19) * w AS bin_start
FROM events, r GROUP BY ALL""")
def histogram(t: Inputs):
    return agg.histogram(t.events, "value", 20, ["event_type"])


@query("histogram_by_group", """
WITH r AS (SELECT event_type, min(value) AS a, (max(value) - min(value)) / 20 AS w FROM events GROUP BY 1)
SELECT event_type, CAST(least(floor((value - a) / w), 19) AS INTEGER) AS bin, count(*) AS n,
  a + least(floor((value - a) / w), 19) * w AS bin_start
FROM events JOIN r USING (event_type) GROUP BY ALL""")
def histogram_by_group(t: Inputs):
    """Bins between the limits of each type of event."""
    return agg.histogram(t.events, "value", 20, ["event_type"], own_limits=True)


@query("describe_column", """
SELECT count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS sd, min(value) AS low,
  quantile_disc(value, 0.25) AS q25, quantile_disc(value, 0.5) AS q50, quantile_disc(value, 0.75) AS q75, max(value) AS high
FROM events""")
def describe_column(t: Inputs):
    return describe(t.events, "value").withColumns({c: F.round(c, 6) for c in ("mean", "sd")})


@query("describe_prices", """
SELECT count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS sd,
  min(l_extendedprice) AS low, quantile_disc(l_extendedprice, 0.01) AS q1, quantile_disc(l_extendedprice, 0.5) AS q50,
  quantile_disc(l_extendedprice, 0.99) AS q99, max(l_extendedprice) AS high
FROM lineitem""")
def describe_prices(t: Inputs):
    return describe(t.lineitem, "l_extendedprice", (0.01, 0.5, 0.99)).withColumns({c: F.round(c, 4) for c in ("mean", "sd")})


def group_cuts_sql(table: str, by: str, value: str, probabilities: tuple[float, ...]) -> str:
    """Rows, limits and the values at rank ceil(p * n) of each group, from numbered rows."""
    at = "greatest(1, ceil(round({p} * n, 6)))"
    cuts = "".join(f", min(v) FILTER (k = {at.format(p=p)}) AS q{round(p * 100)}" for p in probabilities)
    return f"""numbered AS (
  SELECT {by}, {value} AS v, row_number() OVER (PARTITION BY {by} ORDER BY {value}) AS k, count(*) OVER (PARTITION BY {by}) AS n
  FROM {table} WHERE {value} IS NOT NULL),
cuts AS (SELECT {by}, count(*) AS n, round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS sd, min(v) AS low{cuts}, max(v) AS high FROM numbered GROUP BY {by})"""


@query("describe_by_type", f"WITH {group_cuts_sql('events', 'event_type', 'value', (0.25, 0.5, 0.75))} SELECT * FROM cuts")
def describe_by_type(t: Inputs):
    """Few groups, each of a large part of the rows."""
    return describe_by(t.events, ["event_type"], "value").withColumns({c: F.round(c, 6) for c in ("mean", "sd")})


@query("describe_by_order", f"""
WITH {group_cuts_sql('lineitem', 'l_orderkey', 'l_extendedprice', (0.25, 0.5, 0.75))} SELECT * EXCLUDE (mean, sd) FROM cuts""")
def describe_by_order(t: Inputs):
    """As many groups as orders, a few rows each."""
    return describe_by(t.lineitem, ["l_orderkey"], "l_extendedprice").drop("mean", "sd")


@query("n_unique", """
SELECT count(DISTINCT c_name) AS c_name, count(DISTINCT c_nationkey) AS c_nationkey, count(DISTINCT c_mktsegment) AS c_mktsegment FROM customer""")
def n_unique(t: Inputs):
    return agg.distinct_count(t.customer, "c_name", "c_nationkey", "c_mktsegment")


@query("top_category_per_group", f"""
SELECT n_name, p_type, total, place FROM (
  SELECT n_name, p_type, {SUM.format("l_quantity")} AS total, rank() OVER (PARTITION BY n_name ORDER BY sum(CAST(l_quantity AS DECIMAL(18, 2))) DESC) AS place
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY n_name, p_type) WHERE place <= 2""")
def top_category_per_group(t: Inputs):
    """The best sold categories of every nation. Lines are summed per part and supplier before the joins."""
    sold = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(exact_sum("l_quantity").alias("quantity"))
    placed = left_lookup(sold, t.part, {"p_partkey": "l_partkey"}, {"p_type": "p_type"})
    homes = left_lookup(t.supplier, t.nation, {"n_nationkey": "s_nationkey"}, {"n_name": "n_name"})
    placed = left_lookup(placed, homes, {"s_suppkey": "l_suppkey"}, {"n_name": "n_name"})
    ranked = agg.ranked_within(placed, ["n_name"], ["p_type"], F.sum("quantity"), 2)
    return ranked.withColumn("total", F.col("total").cast("double"))


@query("center_share", """
SELECT s_nationkey, l_returnflag, l_suppkey, count(*) AS total,
  CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER (PARTITION BY s_nationkey, l_returnflag) AS DOUBLE) AS share
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY s_nationkey, l_returnflag, l_suppkey""")
def center_share(t: Inputs):
    """Lines handled by each supplier and its share of the nation and return flag."""
    lines = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.count(F.lit(1)).alias("lines"))
    placed = left_lookup(lines, t.supplier, {"s_suppkey": "l_suppkey"}, {"s_nationkey": "s_nationkey"})
    return agg.shares(placed, ["s_nationkey", "l_returnflag"], ["l_suppkey"], F.sum("lines"))


@query("monthly_sales", f"""
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS orders, {SUM.format("o_totalprice")} AS sales
FROM orders GROUP BY 1""")
def monthly_sales(t: Inputs):
    return t.orders.groupBy(month_start("o_orderdate").alias("month")).agg(
        F.count(F.lit(1)).alias("orders"), exact_sum("o_totalprice").cast("double").alias("sales")
    )


@query("item_sales_over_time", f"""
SELECT l_partkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS lines, {SUM.format("l_quantity")} AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def item_sales_over_time(t: Inputs):
    lines = left_lookup(t.lineitem, t.orders, {"o_orderkey": "l_orderkey"}, {"month": month_start("o_orderdate")})
    return lines.groupBy("l_partkey", "month").agg(
        F.count(F.lit(1)).alias("lines"), exact_sum("l_quantity").cast("double").alias("quantity")
    )


@query("profitability", """
WITH r AS (SELECT p_brand, c_mktsegment, l_linestatus,
  CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2))) AS x
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)
SELECT p_brand, c_mktsegment, l_linestatus AS channel, CAST(sum(x) AS DOUBLE) AS revenue, count(*) AS lines FROM r GROUP BY ALL""")
def profitability(t: Inputs):
    """Revenue by product brand, customer segment and channel."""
    buyers = left_lookup(t.orders, t.customer, {"c_custkey": "o_custkey"}, {"c_mktsegment": "c_mktsegment"})
    lines = left_lookup(t.lineitem, buyers, {"o_orderkey": "l_orderkey"}, {"c_mktsegment": "c_mktsegment"})
    lines = left_lookup(lines, t.part, {"p_partkey": "l_partkey"}, {"p_brand": "p_brand"})
    net = exact("l_extendedprice") * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))
    return lines.groupBy("p_brand", "c_mktsegment", F.col("l_linestatus").alias("channel")).agg(
        F.sum(net).cast("double").alias("revenue"), F.count(F.lit(1)).alias("lines")
    )


@query("segments_rfm", f"""
WITH c AS (SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS last_date, count(*) AS f, {SUM.format("o_totalprice")} AS m FROM orders GROUP BY 1),
r AS (SELECT *, CAST(date_diff('day', last_date, (SELECT max(last_date) FROM c)) AS DOUBLE) AS r FROM c),
q AS (SELECT list_value({", ".join(f"quantile_disc(r, {p})" for p in (0.2, 0.4, 0.6, 0.8))}) AS qr,
  list_value({", ".join(f"quantile_disc(f, {p})" for p in (0.2, 0.4, 0.6, 0.8))}) AS qf,
  list_value({", ".join(f"quantile_disc(m, {p})" for p in (0.2, 0.4, 0.6, 0.8))}) AS qm FROM r)
SELECT o_custkey, CAST(5 - len(list_filter(qr, lambda x: r > x)) AS INTEGER) AS recency, CAST(1 + len(list_filter(qf, lambda x: f > x)) AS INTEGER) AS frequency,
  CAST(1 + len(list_filter(qm, lambda x: m > x)) AS INTEGER) AS monetary
FROM r, q""")
def segments_rfm(t: Inputs):
    """Recency, frequency and monetary scores from 1 to 5, cut at exact quintiles.

    Cut points instead of ntile: no window over all customers, and equal customers score alike.
    """
    per = t.orders.groupBy("o_custkey").agg(
        F.max(F.to_date("o_orderdate")).alias("last_date"), F.count(F.lit(1)).alias("f"),
        exact_sum("o_totalprice").cast("double").alias("m"),
    )
    latest = t.orders.agg(F.max(F.to_date("o_orderdate"))).scalar()
    # One row per customer, read by every pass of the search: kept as a checkpoint.
    per = cut_lineage(per.withColumn("r", F.date_diff(latest, F.col("last_date")).cast("double")))
    cuts = exact_quantiles(per, {c: (0.2, 0.4, 0.6, 0.8) for c in ("r", "f", "m")})

    def above(c):
        return sum((F.when(F.col(c) > v, 1).otherwise(0) for v in cuts[c]), F.lit(0))

    return per.select("o_custkey", (5 - above("r")).alias("recency"), (1 + above("f")).alias("frequency"),
                      (1 + above("m")).alias("monetary"))


@query("promo_effect", """
SELECT CASE WHEN l_discount > 0.05 AND l_tax > 0.04 THEN 'both' WHEN l_discount > 0.05 THEN 'emailer' WHEN l_tax > 0.04 THEN 'featured' ELSE 'none' END AS level,
  count(l_quantity) AS n, round(avg(l_quantity), 6) AS mean, round(stddev_samp(l_quantity), 6) AS sd FROM lineitem GROUP BY 1""")
def promo_effect(t: Inputs):
    level = agg.promotion_level(F.col("l_discount") > 0.05, F.col("l_tax") > 0.04)
    return agg.level_table(t.lineitem, level, "l_quantity").withColumns({c: F.round(c, 6) for c in ("mean", "sd")})


@query("null_safe_average", f"""
SELECT c_custkey, coalesce({MEAN.format("o_totalprice")}, 0) AS mean_price FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1""")
def null_safe_average(t: Inputs):
    means = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(exact_mean("o_totalprice").alias("mean_price"))
    return t.customer.select("c_custkey").join(means, "c_custkey", "left").withColumn(
        "mean_price", F.coalesce("mean_price", F.lit(0.0)))


@query("order_value_two_level", """
WITH s AS (SELECT o_custkey, l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS x FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL)
SELECT o_custkey, CAST(sum(x) AS DOUBLE) / count(x) AS mean_value, count(DISTINCT l_orderkey) AS frequency FROM s GROUP BY 1""")
def order_value_two_level(t: Inputs):
    lines = left_lookup(t.lineitem, t.orders, {"o_orderkey": "l_orderkey"}, {"o_custkey": "o_custkey"})
    return agg.two_level(
        lines, ["l_orderkey"], ["o_custkey"], exact_sum("l_extendedprice"),
        mean_value=F.sum("total").cast("double") / F.count("total"), frequency=F.count("l_orderkey"),  # one row per order and customer
    )


AGE = """
SELECT o_custkey, o_orderkey, d, p,
  (12 * year(d) + month(d)) - (12 * year(p) + month(p)) - CAST(day(d) < day(p) AS INTEGER) AS m,
  day(d) - day(p) + CASE WHEN day(d) < day(p) THEN day(last_day(p)) ELSE 0 END AS spare
FROM (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS d,
  CAST(lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS DATE) AS p FROM orders)
"""


@query("time_between_orders", f"""
SELECT o_custkey, o_orderkey, d AS order_date, p AS previous_date, CAST((m // 12) * 365.25 + (m % 12) * 30 + spare AS DOUBLE) AS days,
  CAST(m AS INTEGER) AS months, CAST(m // 12 AS INTEGER) AS years FROM ({AGE})""")
def time_between_orders(t: Inputs):
    orders = previous_date(t.orders, ["o_custkey"], "o_orderdate", "o_orderkey")
    age = calendar_age("o_orderdate", "previous_date")
    return orders.select(
        "o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("order_date"), "previous_date",
        age.days.cast("double").alias("days"), age.months.cast("int").alias("months"), age.years.alias("years"),
    )


@query("calendar_age", """
SELECT o_orderkey, CAST(date_part('year', a) AS INTEGER) AS years, CAST(date_part('year', a) * 12 + date_part('month', a) AS INTEGER) AS months
FROM (SELECT o_orderkey, age(TIMESTAMP '2002-03-01 00:00:00', o_orderdate) AS a FROM orders)""")
def calendar_age_query(t: Inputs):
    age = calendar_age(F.lit("2002-03-01").cast("date"), "o_orderdate")
    return t.orders.select("o_orderkey", age.years.alias("years"), age.months.cast("int").alias("months"))


@query("text_search", r"""
WITH w AS (SELECT doc_id, regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') AS words FROM documents),
c AS (SELECT doc_id, len(list_filter(words, lambda x: x = 'license')) AS a, len(list_filter(words, lambda x: x = 'copyright')) AS b,
  len(list_filter(words, lambda x: x = 'the')) AS c FROM w),
d AS (SELECT count(*) AS n, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db, count(*) FILTER (c > 0) AS dc FROM c)
SELECT doc_id, round(a * (ln((n + 1) / (da + 1)) + 1) + b * (ln((n + 1) / (db + 1)) + 1) + c * (ln((n + 1) / (dc + 1)) + 1), 6) AS score,
  CAST(a > 0 AS INTEGER) + CAST(b > 0 AS INTEGER) + CAST(c > 0 AS INTEGER) AS matched
FROM c, d WHERE a + b + c > 0""")
def text_search(t: Inputs):
    """Every document with one of three words, scored over its whole text."""
    found = keyword_scores(t.documents.select("doc_id", "text"), "text", ["license", "copyright", "the"])
    return found.select("doc_id", F.round("score", 6).alias("score"), "matched")


@query("text_search_top", r"""
WITH w AS (SELECT doc_id, regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+') AS words FROM documents),
c AS (SELECT doc_id, len(list_filter(words, lambda x: x = 'license')) AS a, len(list_filter(words, lambda x: x = 'and')) AS b FROM w),
d AS (SELECT count(*) AS n, count(*) FILTER (a > 0) AS da, count(*) FILTER (b > 0) AS db FROM c)
SELECT doc_id, round(a * (ln((n + 1) / (da + 1)) + 1) + b * (ln((n + 1) / (db + 1)) + 1), 6) AS score
FROM c, d WHERE a + b > 0 ORDER BY score DESC, doc_id LIMIT 10""")
def text_search_top(t: Inputs):
    """The ten best documents: a ranking that every task cuts to ten rows."""
    found = keyword_scores(t.documents.select("doc_id", "text"), "text", ["license", "and"])
    scored = found.select("doc_id", F.round("score", 6).alias("score"))
    return top_rows(scored, 10, F.desc("score"), F.col("doc_id"))


@query("indexed_search", r"""
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM documents),
c AS (SELECT doc_id, term, count(*) AS n FROM w GROUP BY ALL),
r AS (SELECT term, CAST(round((ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) + 1) * 1000000) AS BIGINT) AS weight FROM c GROUP BY 1),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS term FROM benchmark),
s AS (SELECT item_id, doc_id, sum(n * weight) AS points, count(*) AS matched FROM q JOIN c USING (term) JOIN r USING (term) GROUP BY ALL)
SELECT item_id, doc_id, CAST(points AS DOUBLE) / 1000000 AS score, matched, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY points DESC, doc_id) AS place FROM s) WHERE place <= 10""")
def indexed_search(t: Inputs):
    """The ten best documents for the words of every benchmark item, from an index of two segments."""
    target = scratch_path(t.spark, "index")
    docs = t.documents.select("doc_id", "text", F.coalesce(F.col("lang") == "en", F.lit(False)).alias("english"))
    for segment in (docs.where("english"), docs.where("NOT english")):
        textindex.add(target, segment, "doc_id", "text")
    found = textindex.search(t.spark, target, t.benchmark, "item_id", "text", 10)
    return found.select(F.col("query").alias("item_id"), F.col("doc").alias("doc_id"), "score", "matched", "place")


@query("weekly_orders", f"""
SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week, count(*) AS orders, sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END)::BIGINT AS urgent,
  {MEAN.format("o_totalprice")} AS mean_price FROM orders GROUP BY 1""")
def weekly_orders(t: Inputs):
    return t.orders.groupBy(week_start("o_orderdate").alias("week")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum(yes_flag("o_orderpriority", "1-URGENT")).alias("urgent"),
        exact_mean("o_totalprice").alias("mean_price"),
    )
