"""The streaming jobs, run over the files that are there and then stopped."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import gate, ingest, store
from ..streaming.prefs import prefs_stream
from .base import Inputs, query
from .vectors import PREFS, feedback


def event_stream(t: Inputs):
    return ingest.file_stream(t.spark, f"{t.location}/events*.parquet", t.events.schema)


@query("stream_ingest", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_ingest(t: Inputs):
    home = scratch_path(t.spark, "ingest")
    ingest.ingest_available(t.spark, f"{t.location}/events*.parquet", t.events.schema, f"{home}/rows", f"{home}/checkpoint")
    return t.spark.read.schema(t.events.schema).parquet(f"{home}/rows")


def batch_time(batch: int) -> str:
    """The run time of a batch: a day later than that of the one before."""
    return f"{date(2025, 1, 1) + timedelta(days=batch)} 00:00:00"


def slices(t: Inputs, home: str):
    """The events as they arrive: quarters of the month, one after another. Yields a stream after each."""
    quarter = F.floor((F.dayofmonth("ts") - 1) / 8)
    for i in range(4):
        t.events.where(quarter == i).write.parquet(f"{home}/in/slice{i}")
        yield ingest.file_stream(t.spark, f"{home}/in/*/*.parquet", t.events.schema)


# The last event of each user in each quarter of the month that has events; quarters are batches.
ARRIVED = """arrived AS (
  SELECT *, dense_rank() OVER (ORDER BY (day(ts) - 1) // 8) - 1 AS batch FROM events),
given AS (
  SELECT *, TIMESTAMP '2025-01-01 00:00:00' + INTERVAL 1 DAY * batch AS run FROM arrived
  QUALIFY row_number() OVER (PARTITION BY user_id, batch ORDER BY ts DESC, event_id DESC) = 1)"""


@query("stream_merge", f"""
WITH {ARRIVED},
versions AS (
  SELECT * FROM given WINDOW w AS (PARTITION BY user_id ORDER BY batch)
  QUALIFY coalesce(lag(event_type) OVER w <> event_type OR lag(props) OVER w <> props, true))
SELECT user_id, event_type, props, run AS valid_from, lead(run) OVER (PARTITION BY user_id ORDER BY batch) AS valid_to FROM versions""")
def stream_merge(t: Inputs):
    """The latest event of each user kept as a history, over four batches and a compaction between them."""
    home = scratch_path(t.spark, "merge")
    table = store.Store(f"{home}/history", ("user_id",), ("event_type", "props"))
    for stream in slices(t, home):
        store.merge_into(stream, table, f"{home}/checkpoint", ["ts", "event_id"], batch_time, every=2)
    return store.read(t.spark, table).select("user_id", "event_type", "props", "valid_from", "valid_to")


@query("stream_upsert", f"""
WITH {ARRIVED},
hashed AS (
  SELECT user_id, event_type, batch, run, sha256(user_id || '||' || event_type) AS row_hash FROM given),
marked AS (
  SELECT *, coalesce(lag(row_hash) OVER w <> row_hash, true) AS new FROM hashed WINDOW w AS (PARTITION BY user_id ORDER BY batch))
SELECT user_id, event_type, row_hash, min(run) OVER k AS created_at, max(run) FILTER (new) OVER k AS updated_at FROM marked
WINDOW k AS (PARTITION BY user_id) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY batch DESC) = 1""")
def stream_upsert(t: Inputs):
    """The latest event of each user, over four batches and a compaction between them."""
    home = scratch_path(t.spark, "upsert")
    table = store.Store(f"{home}/table", ("user_id",), ("user_id", "event_type"), history=False)
    for stream in slices(t, home):
        store.merge_into(stream, table, f"{home}/checkpoint", ["ts", "event_id"], batch_time, every=2)
    return store.read(t.spark, table).select("user_id", "event_type", "row_hash", "created_at", "updated_at")


@query("stream_prefs", f"WITH RECURSIVE {PREFS} SELECT user_id, item_id, round(q, 9) AS q FROM learned")
def stream_prefs(t: Inputs):
    """The values of all users, learned over four batches in order of time and a compaction between them."""
    home = scratch_path(t.spark, "prefs")
    n_items = t.events.select(F.regexp_extract("props", "([0-9]+)", 1)).distinct().count()
    for stream in slices(t, home):
        values = prefs_stream(feedback(stream), n_items, ["ts", "event_id"], f"{home}/values", f"{home}/checkpoint", every=2)
    return values.withColumn("q", F.round("q", 9))


@query("stream_gate", """
SELECT event_id, event_type <> 'error' AND value >= 5 AS good,
  concat_ws(', ', CASE WHEN event_type = 'error' THEN 'no error' END, CASE WHEN value < 5 THEN 'value' END) AS broken FROM events""")
def stream_gate(t: Inputs):
    home = scratch_path(t.spark, "gate")
    rules = {"no error": F.col("event_type") != "error", "value": F.col("value") >= 5}
    gate.gate_stream(event_stream(t), gate.rule_failures(rules), f"{home}/good", f"{home}/bad", f"{home}/checkpoint")
    good = t.spark.read.parquet(f"{home}/good").select("event_id", F.lit(True).alias("good"), F.lit("").alias("broken"))
    bad = t.spark.read.parquet(f"{home}/bad")
    return good.unionByName(bad.select("event_id", F.lit(False).alias("good"), F.array_join("failures", ", ").alias("broken")))
