"""Shaping, keys, scalar functions and joins on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers, text
from ..functions.dates import date_from_parts, minute_of_day
from ..functions.geo import point_parts
from ..functions.keys import row_hash, surrogate_key
from ..operators import lookups, shape
from ..operators.aggregates import value_counts
from ..plans.calendar import date_dimension, days_of, mart_date_dimension, time_dimension
from ..plans.cleaning import clean_catalogue, clean_survey, missing_names, split_campaign
from ..plans.dimensions import event_type_table
from ..sources.generate import children, weekly_stock
from ..sources.readers import high_water_mark, rows_after
from .base import Inputs, query

HEX = "('0x' || substr(md5({}), 1, 8))::BIGINT"


@query("row_hash", """
SELECT c_custkey, sha256(concat_ws('||', coalesce(CAST(c_custkey AS VARCHAR), 'null'), coalesce(c_name, 'null'),
  coalesce(nullif(c_mktsegment, 'BUILDING'), 'null'), coalesce(CAST(CAST(c_acctbal AS DECIMAL(18, 2)) AS VARCHAR), 'null'))) AS h
FROM customer""")
def row_hash_query(t: Inputs):
    segment = F.nullif("c_mktsegment", F.lit("BUILDING"))
    return t.customer.select("c_custkey", row_hash(["c_custkey", "c_name", segment, numbers.exact("c_acctbal")]).alias("h"))


@query("surrogate_key", """
SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS sk,
  md5(CAST(o_custkey AS VARCHAR) || '-' || coalesce(nullif(o_orderstatus, 'P'), '_dbt_utils_surrogate_key_null_')) AS sk2
FROM orders""")
def surrogate_key_query(t: Inputs):
    return t.orders.select(
        "o_orderkey", surrogate_key("o_orderkey").alias("sk"),
        surrogate_key("o_custkey", F.nullif("o_orderstatus", F.lit("P"))).alias("sk2"),
    )


@query("event_type_ids", "SELECT DISTINCT sha256(event_type) AS event_type_id, event_type FROM events")
def event_type_ids(t: Inputs):
    return event_type_table(t.events, "event_type")


@query("code_lookup", """
SELECT event_id, sha256('purchase') AS purchase_id, event_type = 'purchase' AS is_purchase FROM events""")
def code_lookup(t: Inputs):
    codes = event_type_table(t.events, "event_type")
    purchase = lookups.code_of_label(codes, "purchase", "event_type", "event_type_id")
    coded = lookups.left_lookup(t.events, codes, {"event_type": "event_type"}, {"event_type_id": "event_type_id"})
    return coded.select("event_id", purchase.alias("purchase_id"), (F.col("event_type_id") == purchase).alias("is_purchase"))


DATE_SQL = """
WITH r AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders),
d AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM r)
"""


@query("dim_date", DATE_SQL + """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, d AS date_actual,
  day(d) || CASE WHEN day(d) BETWEEN 10 AND 20 THEN 'th' WHEN day(d) % 10 = 1 THEN 'st' WHEN day(d) % 10 = 2 THEN 'nd'
    WHEN day(d) % 10 = 3 THEN 'rd' ELSE 'th' END AS day_suffix,
  dayname(d) AS day_name, CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  CAST((day(d) - 1) // 7 + 1 AS INTEGER) AS week_of_month, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
  year(d) || '-W' || lpad(CAST(weekofyear(d) AS VARCHAR), 2, '0') AS week_of_year_iso,
  CAST(month(d) AS INTEGER) AS month_actual, monthname(d) AS month_name, strftime(d, '%b') AS month_name_abbreviated,
  CAST(quarter(d) AS INTEGER) AS quarter_actual,
  ['First', 'Second', 'Third', 'Fourth'][quarter(d)] AS quarter_name, CAST(year(d) AS INTEGER) AS year_actual,
  CAST(date_trunc('week', d) AS DATE) AS first_day_of_week, CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE) AS last_day_of_week,
  CAST(date_trunc('month', d) AS DATE) AS first_day_of_month, last_day(d) AS last_day_of_month,
  CAST(date_trunc('quarter', d) AS DATE) AS first_day_of_quarter,
  CAST(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS last_day_of_quarter,
  CAST(date_trunc('year', d) AS DATE) AS first_day_of_year, make_date(year(d), 12, 31) AS last_day_of_year,
  strftime(d, '%m%Y') AS mmyyyy, strftime(d, '%m%d%Y') AS mmddyyyy,
  CASE WHEN isodow(d) >= 6 THEN 'weekend' ELSE 'weekday' END AS weekend_indr
FROM d""")
def dim_date(t: Inputs):
    return date_dimension(days_of(t.orders, "o_orderdate"))


@query("dim_date_orders", DATE_SQL + """
SELECT md5(CAST(d AS VARCHAR)) AS sk_date_id, d AS date_day, CAST(date_trunc('week', d) AS DATE) AS iso_week_start_date,
  CAST(isodow(d) AS INTEGER) AS day_of_week_iso, count(o_orderkey) AS orders
FROM d LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY ALL""")
def dim_date_orders(t: Inputs):
    """Orders per day of the mart calendar, days without orders included."""
    days = mart_date_dimension(days_of(t.orders, "o_orderdate"))
    counts = value_counts(t.orders.select(F.to_date("o_orderdate").alias("date_day")), "date_day")
    return days.join(counts, "date_day", "left").select(
        "sk_date_id", "date_day", "iso_week_start_date", "day_of_week_iso", F.coalesce("n", F.lit(0)).alias("orders")
    )


@query("dim_time", """
SELECT CAST(m AS INTEGER) AS time_id, lpad(CAST(m // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(m % 60 AS VARCHAR), 2, '0') || ':00' AS time_actual,
  CASE WHEN m < 720 THEN 'AM' ELSE 'PM' END AS half_day, CAST(m // 15 AS INTEGER) AS quarter_hour, count(event_id) AS n
FROM range(1440) r(m) LEFT JOIN events ON hour(ts) * 60 + minute(ts) = m GROUP BY ALL""")
def dim_time(t: Inputs):
    """Events per minute of the day, quiet minutes included."""
    counts = value_counts(t.events.select(minute_of_day("ts").alias("time_id")), "time_id")
    minutes = time_dimension(t.spark)
    return minutes.join(counts, "time_id", "left").select(
        "time_id", "time_actual", "half_day", "quarter_hour", F.coalesce("n", F.lit(0)).alias("n")
    )


@query("minute_join", """
SELECT event_id, CAST(hour(ts) * 60 + minute(ts) AS INTEGER) AS time_id, strftime(ts, '%H:%M:%S') AS event_time FROM events""")
def minute_join(t: Inputs):
    from ..functions.dates import time_part

    events = t.events.select("event_id", time_part("ts").alias("event_time"))
    minute = F.concat(F.substring("event_time", 1, 5), F.lit(":00"))
    return lookups.left_lookup(events, time_dimension(t.spark), {"time_actual": minute}, {"time_id": "time_id"})


@query("two_key_join", """
SELECT l.l_orderkey, l.l_linenumber, l.l_quantity, o.o_totalprice, o.o_orderdate
FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey AND l.l_suppkey = o.o_custkey""")
def two_key_join(t: Inputs):
    joined = lookups.left_lookup(
        t.lineitem, t.orders, {"o_orderkey": "l_orderkey", "o_custkey": "l_suppkey"},
        {"o_totalprice": "o_totalprice", "o_orderdate": "o_orderdate"},
    )
    return joined.select("l_orderkey", "l_linenumber", "l_quantity", "o_totalprice", "o_orderdate")


@query("header_into_detail", """
SELECT l_orderkey, l_partkey AS object_nk, 'received' AS kind, CAST(o_orderdate AS DATE) AS event_date FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey
UNION ALL
SELECT l_orderkey, l_suppkey, 'made', CAST(o_orderdate AS DATE) FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey""")
def header_into_detail(t: Inputs):
    """The date of the order copied to both sides of every line: one join, then two roles."""
    lines = lookups.left_lookup(
        t.lineitem, t.orders, {"o_orderkey": "l_orderkey"}, {"event_date": F.to_date("o_orderdate")}
    )
    roles = F.array(
        F.struct(F.col("l_partkey").alias("object_nk"), F.lit("received").alias("kind")),
        F.struct(F.col("l_suppkey").alias("object_nk"), F.lit("made").alias("kind")),
    )
    return lines.select("l_orderkey", "event_date", F.inline(roles))


@query("bridge_join", """
SELECT p_partkey, p_name, s_suppkey, s_name
FROM part JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey""")
def bridge_join(t: Inputs):
    pairs = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")).distinct()
    return lookups.through_bridge(
        t.part.select("p_partkey", "p_name"), pairs, t.supplier.select("s_suppkey", "s_name"), "p_partkey", "s_suppkey"
    )


@query("prepared_columns", """
SELECT sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR), coalesce(o_orderstatus, 'null'), CAST(CAST(o_orderdate AS DATE) AS VARCHAR))) AS order_id,
  o_orderkey AS order_nk, CAST(o_orderdate AS DATE) AS event_date, o_orderdate AS event_datetime, 'web' AS channel, o_orderstatus,
  TIMESTAMP '2025-01-01 00:00:00' AS created_at, TIMESTAMP '2025-01-01 00:00:00' AS updated_at
FROM orders""")
def prepared_columns(t: Inputs):
    orders = shape.copy_columns(t.orders, {"o_orderkey": "order_nk", "o_orderdate": ["event_date", "event_datetime"]})
    orders = shape.cast_columns(orders, {"event_date": "date", "event_datetime": "timestamp_ntz"})
    orders = shape.drop_columns(shape.add_literals(orders, {"channel": "web"}), ["o_totalprice"])
    orders = shape.add_row_hash(orders, ["order_nk", "o_orderstatus", "event_date"], "order_id")
    kept = shape.pick_columns(orders, ["order_id", "order_nk", "event_date", "event_datetime", "channel", "o_orderstatus"])
    return shape.stamp(kept, "2025-01-01 00:00:00")


@query("split_wide", """
SELECT 'client' AS kind, o_custkey AS id, replace(o_orderpriority, '-', '_') AS label, CAST(NULL AS DATE) AS last_contact_date, CAST(NULL AS INTEGER) AS flag FROM orders
UNION ALL
SELECT 'campaign', o_custkey, NULL, make_date(2024, month(o_orderdate), day(o_orderdate)),
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END FROM orders
UNION ALL
SELECT 'economics', o_custkey, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR), NULL, NULL FROM orders""")
def split_wide(t: Inputs):
    month = F.lower(F.date_format("o_orderdate", "MMM"))
    parts = shape.split_columns(t.orders, {
        "client": {"kind": F.lit("client"), "id": "o_custkey", "label": text.swap("o_orderpriority", "-", "_")},
        "campaign": {
            "kind": F.lit("campaign"), "id": "o_custkey", "flag": numbers.outcome_flag("o_orderstatus", "F", "O"),
            "last_contact_date": date_from_parts(2024, month, F.dayofmonth("o_orderdate")),
        },
        "economics": {"kind": F.lit("economics"), "id": "o_custkey", "label": numbers.exact("o_totalprice").cast("string")},
    })
    return shape.stack_tables(list(parts.values()))


def campaign_file(t: Inputs):
    """The marketing file made from customers and orders, one row per contact."""
    nothing = F.lit(None).cast("string")
    people = lookups.left_lookup(t.orders, t.customer, {"c_custkey": "o_custkey"}, {"segment": "c_mktsegment"})
    day = F.least(F.dayofmonth("o_orderdate"), F.lit(28))
    return people.select(
        F.col("o_custkey").alias("client_id"), F.lit(30).alias("age"), F.concat("segment", F.lit(".")).alias("job"), nothing.alias("marital"),
        F.when(F.col("o_orderstatus") == "F", "high.school").when(F.col("o_orderstatus") == "O", "unknown").otherwise("basic.4y").alias("education"), nothing.alias("credit_default"), F.when(F.col("o_totalprice") > 100000, "yes").alias("housing"), nothing.alias("loan"),
        F.lit(1).alias("campaign"), F.lit(60).alias("duration"), F.lit(0).alias("pdays"), F.lit(0).alias("previous"),
        F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "O", "failure").otherwise("nonexistent").alias("poutcome"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "yes").otherwise("no").alias("y"),
        F.lower(F.date_format("o_orderdate", "MMM")).alias("month"), day.alias("day"),
        F.round("o_totalprice", 2).alias("emp_var_rate"), F.lit(0.0).alias("cons_price_idx"), F.col("o_orderkey").cast("double").alias("euribor3m"), F.lit(0.0).alias("nr_employed"),
    )


@query("campaign_clients", """
SELECT o_custkey AS id, 30 AS age, c_mktsegment AS job, CAST(NULL AS VARCHAR) AS marital,
  CASE o_orderstatus WHEN 'F' THEN 'high_school' WHEN 'O' THEN NULL ELSE 'basic_4y' END AS education, CAST(NULL AS VARCHAR) AS credit_default,
  CASE WHEN o_totalprice > 100000 THEN 'yes' END AS housing, CAST(NULL AS VARCHAR) AS loan
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def campaign_clients(t: Inputs):
    return split_campaign(campaign_file(t))["client"]


@query("campaign_contacts", """
SELECT 1 AS campaign_id, o_custkey AS client_id, 1 AS number_contacts, 60 AS contact_duration, 0 AS pdays, 0 AS previous_campaign_contacts,
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS previous_outcome, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS campaign_outcome,
  make_date(2022, month(o_orderdate), least(day(o_orderdate), 28)) AS last_contact_date FROM orders""")
def campaign_contacts(t: Inputs):
    return split_campaign(campaign_file(t))["campaign"]


@query("campaign_economics", """
SELECT o_custkey AS client_id, round(o_totalprice, 2) AS emp_var_rate, 0.0::DOUBLE AS cons_price_idx, o_orderkey::DOUBLE AS euribor_three_months,
  0.0::DOUBLE AS number_employed FROM orders""")
def campaign_economics(t: Inputs):
    return split_campaign(campaign_file(t))["economics"]


@query("campaign_split", """
SELECT id, sum(is_client) AS clients, sum(outcome) AS outcomes, sum(prev) AS previous, max(d) AS last_contact_date, count(education) AS educations
FROM (
  SELECT c_custkey AS id, 1 AS is_client, 0 AS outcome, NULL AS prev, NULL AS d, nullif(replace(c_mktsegment, 'I', '_'), 'unknown') AS education FROM customer
  UNION ALL
  SELECT o_custkey, 0, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END, make_date(2022, month(o_orderdate), least(day(o_orderdate), 28)), NULL FROM orders)
GROUP BY 1""")
def campaign_split(t: Inputs):
    """The campaign part of the marketing file, put together again per client."""
    campaign = split_campaign(campaign_file(t))["campaign"]
    per_client = campaign.groupBy(F.col("client_id").alias("id")).agg(
        F.sum("campaign_outcome").alias("outcomes"), F.sum("previous_outcome").alias("previous"),
        F.max("last_contact_date").alias("last_contact_date"),
    )
    clients = t.customer.select(F.col("c_custkey").alias("id"),
                                text.sentinel_to_null(text.swap("c_mktsegment", "I", "_")).alias("education"))
    return clients.join(per_client, "id", "left").select(
        "id", F.lit(1).cast("bigint").alias("clients"), F.coalesce("outcomes", F.lit(0)).alias("outcomes"), "previous",
        "last_contact_date", F.when(F.col("education").isNotNull(), 1).otherwise(0).cast("bigint").alias("educations"),
    )


@query("outcome_flags", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS urgent,
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS outcome, nullif(o_orderpriority, '4-NOT SPECIFIED') AS priority
FROM orders""")
def outcome_flags(t: Inputs):
    return t.orders.select(
        "o_orderkey", numbers.yes_flag("o_orderpriority", "1-URGENT").alias("urgent"),
        numbers.outcome_flag("o_orderstatus", "F", "O").alias("outcome"),
        text.sentinel_to_null("o_orderpriority", "4-NOT SPECIFIED").alias("priority"),
    )


@query("date_from_parts", """
SELECT event_id, make_date(2022, month(ts), day(ts)) AS contact_date FROM events""")
def date_from_parts_query(t: Inputs):
    month = F.lower(F.date_format("ts", "MMM"))
    return t.events.select("event_id", date_from_parts(2022, month, F.dayofmonth("ts")).alias("contact_date"))


@query("clean_text_fields", r"""
SELECT doc_id, nullif(regexp_extract(source, '([A-Za-z]+)', 1), '') AS source_word,
  regexp_matches(text, '^(?:[A-Z])') AS starts_upper, replace(source, 'src', '') AS source_no,
  nullif(lang, 'fr') AS lang_or_null, length(replace(text, chr(10), '')) AS chars_without_breaks
FROM documents""")
def clean_text_fields(t: Inputs):
    return t.documents.select(
        "doc_id", text.letters("source").alias("source_word"), text.starts_like("text", "[A-Z]").alias("starts_upper"),
        text.without("source", "src").alias("source_no"), text.sentinel_to_null("lang", "fr").alias("lang_or_null"),
        F.length(text.without("text", "\n")).cast("bigint").alias("chars_without_breaks"),
    )


@query("coerce_numbers", """
SELECT event_id, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k, TRY_CAST(event_type AS DOUBLE) AS bad,
  TRY_CAST(replace(CAST(hour(ts) AS VARCHAR) || '/10', '/10', '') AS INTEGER) AS score FROM events""")
def coerce_numbers(t: Inputs):
    return t.events.select(
        "event_id", F.regexp_extract("props", "([0-9]+)", 1).try_cast("int").alias("k"),
        numbers.to_number("event_type").alias("bad"),
        text.number_before(F.concat(F.hour("ts").cast("string"), F.lit("/10")), "/10").alias("score"),
    )


@query("impute_mean", """
WITH a AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(round(value) AS INTEGER) END AS v FROM events)
SELECT event_id, coalesce(v, (SELECT CAST(round_even(avg(v), 0) AS INTEGER) FROM a)) AS age,
  CASE WHEN event_type = 'view' THEN 'Unknown' ELSE event_type END AS web_browser, strftime(ts, '%b') AS review_month,
  CAST(hour(ts) AS INTEGER) AS value_for_money
FROM a JOIN events USING (event_id)""")
def impute_mean(t: Inputs):
    """The survey cleaning on events: errors have no age, views no browser."""
    survey = t.events.select(
        "event_id",
        F.concat(F.dayofmonth("ts").cast("string"), F.lit("-"), F.date_format("ts", "MMM")).alias("review_month"),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("web_browser"),
        F.when(F.col("event_type") == "error", "-").otherwise(F.round("value").cast("int").cast("string")).alias("reviewer_age"),
        F.concat(F.hour("ts").cast("string"), F.lit("/10")).alias("value_for_money"),
    )
    return clean_survey(survey).withColumnRenamed("reviewer_age", "age")


@query("feature_text", """
SELECT p_partkey, concat_ws(' ', p_name, coalesce(p_brand, ''), coalesce(nullif(p_type, 'SMALL'), ''), CAST(p_size AS VARCHAR)) AS text,
  split_part(p_name, ' ', 1) AS first_word, lower(replace(p_brand, '#', '_') ) AS brand_slug, substr(p_type, 1, 4) AS type_prefix,
  'images/' || p_partkey || '.jpg' AS uri
FROM part""")
def feature_text(t: Inputs):
    return t.part.select(
        "p_partkey",
        text.feature_text(["p_name", "p_brand", F.nullif("p_type", F.lit("SMALL")), "p_size"]).alias("text"),
        text.first_token("p_name").alias("first_word"), text.slug(text.swap("p_brand", "#", " ")).alias("brand_slug"),
        text.prefix("p_type", 4).alias("type_prefix"), text.path_of("images", "p_partkey", ".jpg").alias("uri"),
    )


@query("parse_array", """
SELECT event_id, event_type AS first_item, regexp_extract(props, '([0-9]+)', 1) AS second_item, CAST(2 AS INTEGER) AS items FROM events""")
def parse_array(t: Inputs):
    listed = F.concat(F.lit("['"), "event_type", F.lit("', '"), F.regexp_extract("props", "([0-9]+)", 1), F.lit("']"))
    return t.events.select("event_id", text.text_list(listed).alias("items")).select(
        "event_id", F.get("items", F.lit(0)).alias("first_item"), F.get("items", F.lit(1)).alias("second_item"),
        F.size("items").alias("items"),
    )


@query("parse_point", """
SELECT event_id, -value AS lat, value + 0.5 AS lon FROM events""")
def parse_point(t: Inputs):
    point = F.concat(F.lit("("), (-F.col("value")).cast("string"), F.lit(", "), (F.col("value") + 0.5).cast("string"), F.lit(")"))
    lat, lon = point_parts("point")
    return t.events.select("event_id", point.alias("point")).select("event_id", lat.alias("lat"), lon.alias("lon"))


@query("discount_fraction", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_extendedprice - p_retailprice) / l_extendedprice, 6) AS discount
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def discount_fraction(t: Inputs):
    priced = lookups.left_lookup(t.lineitem, t.part, {"p_partkey": "l_partkey"}, {"paid": "p_retailprice"})
    return priced.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                         F.round(numbers.discount_fraction("l_extendedprice", "paid"), 6).alias("discount"))


@query("dedupe_first", """
SELECT doc_id, lang, source FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1""")
def dedupe_first(t: Inputs):
    """Exact copies of a text: the smallest id stays. Only a digest of the whole text is shuffled."""
    marked = t.documents.select("doc_id", "lang", "source", F.sha2("text", 256).alias("digest"))
    return shape.first_per_key(marked, ["digest"], ["doc_id"]).drop("digest")


@query("dedupe_last", """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1""")
def dedupe_last(t: Inputs):
    events = t.events.select("user_id", "event_type", "event_id", "ts", "value")
    return shape.last_per_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@query("union_missing", """
SELECT c_custkey AS id, c_name AS name, NULL AS status, c_acctbal AS amount FROM customer
UNION ALL SELECT o_orderkey, NULL, o_orderstatus, o_totalprice FROM orders""")
def union_missing(t: Inputs):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount"))
    b = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("amount"))
    return shape.stack_tables([a, b], ["id", "name", "status", "amount"])


@query("semi_anti", """
SELECT c_custkey, 'buyer' AS kind FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
UNION ALL SELECT c_custkey, 'idle' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def semi_anti(t: Inputs):
    people, buyers = t.customer.select("c_custkey"), t.orders.select(F.col("o_custkey").alias("c_custkey"))
    return shape.keys_in(people, buyers, "c_custkey").withColumn("kind", F.lit("buyer")).unionByName(
        shape.keys_not_in(people, buyers, "c_custkey").withColumn("kind", F.lit("idle")))


@query("append_sorted", """
SELECT c_custkey AS id, c_name AS name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier ORDER BY 1""")
def append_sorted(t: Inputs):
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return shape.stack_tables([a, b]).orderBy("id", "name")


@query("distinct_values", "SELECT DISTINCT lang, source FROM documents")
def distinct_values(t: Inputs):
    return shape.distinct_values(t.documents, "lang", "source")


@query("missing_text", """
SELECT doc_id, quality IS NULL AS unlabelled, d.text IS NULL OR trim(d.text) = '' AS empty_text
FROM documents d LEFT JOIN labels USING (doc_id)""")
def missing_text(t: Inputs):
    joined = lookups.left_lookup(t.documents, t.labels, {"doc_id": "doc_id"}, {"quality": "quality"})
    return joined.select("doc_id", F.col("quality").isNull().alias("unlabelled"), text.blank("text").alias("empty_text"))


@query("key_prefixes", """
SELECT DISTINCT substr(c_name, 1, 1) AS first_char, substr(c_mktsegment, 1, 1) AS segment_char FROM customer""")
def key_prefixes(t: Inputs):
    return t.customer.select(text.prefix("c_name", 1).alias("first_char"), text.prefix("c_mktsegment", 1).alias("segment_char")).distinct()


@query("high_water_mark", """
SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'error')""")
def high_water_mark_query(t: Inputs):
    loaded = t.events.where(F.col("event_type") == "error")
    return rows_after(t.events.select("event_id", "ts"), "ts", loaded)


@query("current_rows_of_stock", """
SELECT event_id, event_type, value, (SELECT CAST(max(ts) AS VARCHAR) FROM events) AS mark FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def current_rows_of_stock(t: Inputs):
    dated = t.events.withColumn("day", F.to_date("ts"))
    mark = high_water_mark(t.events, "ts").cast("string").alias("mark")
    return shape.where_maximum(dated, "day").select("event_id", "event_type", "value", mark)


@query("cte_report", """
WITH a AS (SELECT o_orderkey AS nk_order_id, o_orderstatus AS status FROM orders),
b AS (SELECT l_orderkey AS nk_order_id, count(*) AS lines FROM lineitem GROUP BY 1)
SELECT status, lines, count(*) AS n FROM a LEFT JOIN b USING (nk_order_id) GROUP BY ALL""")
def cte_report(t: Inputs):
    a = shape.rename_select(t.orders, {"nk_order_id": "o_orderkey", "status": "o_orderstatus"})
    b = t.lineitem.groupBy(F.col("l_orderkey").alias("nk_order_id")).agg(F.count(F.lit(1)).alias("lines"))
    return value_counts(a.join(b, "nk_order_id", "left"), "status", "lines")


@query("catalogue_clean", r"""
SELECT CAST(d.doc_id AS VARCHAR) AS id, '' AS gender, lang AS "masterCategory", source AS "subCategory",
  replace(CAST(n_chars AS VARCHAR) || '.0', '.0', '') AS year, '/img/' || d.doc_id || '.jpg' AS uri,
  md5(lower(lang) || ' ' || replace(d.text, chr(10), '')) AS product,
  concat(' ', lang, ' ', source, ' ', n_chars, ' ', lower(lang), ' ', replace(d.text, chr(10), '')) AS feature_text
FROM documents d WHERE doc_id IN (SELECT doc_id FROM labels)""")
def catalogue_clean(t: Inputs):
    products = t.documents.select(
        F.col("doc_id").alias("id"), F.lit(None).cast("string").alias("gender"), F.col("lang").alias("masterCategory"),
        F.col("source").alias("subCategory"), F.concat(F.col("n_chars").cast("string"), F.lit(".0")).alias("year"),
        F.concat_ws(" ", F.lower("lang"), "text").alias("productDisplayName"),
    )
    images = t.labels.select(F.col("doc_id").cast("string").alias("id"))
    clean = clean_catalogue(products, images, "/img", ["gender", "masterCategory", "subCategory", "year", "productDisplayName"])
    return clean.select("id", "gender", "masterCategory", "subCategory", "year", "uri", F.md5("productDisplayName").alias("product"), F.col("text").alias("feature_text"))


@query("unnamed_products", """
SELECT doc_id, lang FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL""")
def unnamed_products(t: Inputs):
    joined = lookups.left_lookup(t.documents, t.labels, {"doc_id": "doc_id"}, {"quality": "quality"})
    named = joined.withColumn("name", F.col("quality").cast("string"))
    return missing_names(named, "name").select("doc_id", "lang")


@query("synthetic_rows", f"""
WITH c AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, unnest([0, 1]) AS no FROM orders)
SELECT o_orderkey || '-' || no AS child_id, o_orderkey, 100 + {HEX.format("'5||' || o_orderkey || '||' || no")} % 50 AS other_key,
  d + CAST({HEX.format("'6||' || o_orderkey || '||' || no")} % 31 AS INTEGER) AS date_created
FROM c""")
def synthetic_rows(t: Inputs):
    """Two made-up children for every order, with a random key and a later date."""
    return children(t.orders, "o_orderkey", "o_orderdate", 2, 100, 50, seed=5, most_days=30)


@query("synthetic_stock", f"""
WITH w AS (SELECT p_partkey AS product_id, unnest(range(104)) AS week_no FROM part),
h AS (SELECT *, {HEX.format("'0||' || product_id || '||' || week_no")} % 4 = 0 AS p FROM w)
SELECT product_id, count(*) AS weeks, sum(CAST(p AS INTEGER)) AS promotions,
  sum({HEX.format("'1||' || product_id || '||' || week_no")} % 101)::BIGINT AS stock,
  sum(CASE WHEN p THEN {HEX.format("'2||' || product_id || '||' || week_no")} % 9 * 4 + 4
      ELSE {HEX.format("'2||' || product_id || '||' || week_no")} % 20 + 1 END)::BIGINT AS sold
FROM h GROUP BY 1""")
def synthetic_stock(t: Inputs):
    """Two years of weekly stock for every part, summed per part."""
    stock = weekly_stock(t.part.select(F.col("p_partkey").alias("product_id")), t.spark, [2023, 2024])
    return stock.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("weeks"), F.sum("promotion").alias("promotions"),
        F.sum("stock").alias("stock"), F.sum("qty_sold").alias("sold"),
    )
