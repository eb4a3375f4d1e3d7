"""Similarity search and preferences on embeddings and events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import blend, inner_product, l2_normalise
from ..operators import prefs, similarity as sim
from .base import Inputs, query

# One query vector per label: the mean of its vectors.
CENTRES = """
x AS (SELECT vec_id, label, unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
n AS (SELECT vec_id, label, i, v / sqrt(sum(v * v) OVER (PARTITION BY vec_id)) AS v FROM x),
m AS (SELECT label, i, avg(v) AS v FROM x GROUP BY ALL),
c AS (SELECT label, i, v / sqrt(sum(v * v) OVER (PARTITION BY label)) AS v FROM m),
s AS (SELECT c.label AS query_id, n.vec_id AS item_id, round(sum(c.v * n.v), 10) AS score FROM n JOIN c USING (i) GROUP BY ALL)
"""


def items(t: Inputs):
    return t.embeddings.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vector"), "label")


def centres(t: Inputs):
    return sim.mean_vectors(t.embeddings, "label", "embedding").withColumnRenamed("label", "query_id")


@query("vector_topk", f"""
WITH {CENTRES}
SELECT query_id, item_id, round(score, 6) AS score, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS place FROM s) WHERE place <= 30""")
def vector_topk(t: Inputs):
    """The 30 nearest items of every label's mean vector."""
    return sim.top_items(items(t), centres(t), 30).withColumn("score", F.round("score", 6))


@query("vector_blend_topk", f"""
WITH {CENTRES},
f AS (SELECT label, min(vec_id) AS vec_id FROM embeddings GROUP BY 1),
b AS (SELECT c.label, c.i, 0.5 * c.v + 0.5 * n.v AS v FROM c JOIN f ON c.label = f.label JOIN n ON n.vec_id = f.vec_id AND n.i = c.i),
bn AS (SELECT label, i, v / sqrt(sum(v * v) OVER (PARTITION BY label)) AS v FROM b),
bs AS (SELECT bn.label AS query_id, n.vec_id AS item_id, round(sum(bn.v * n.v), 10) AS score FROM n JOIN bn USING (i) GROUP BY ALL)
SELECT query_id, item_id, round(score, 6) AS score, CAST(place AS INTEGER) AS place FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS place FROM bs) WHERE place <= 3""")
def vector_blend_topk(t: Inputs):
    """Two kinds of query at once: the label's mean and the label's first item, half each."""
    first = t.embeddings.groupBy(F.col("label").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("other"))
    queries = centres(t).join(first, "query_id").select("query_id", blend("vector", "other").alias("vector"))
    return sim.top_items(items(t), queries, 3).withColumn("score", F.round("score", 6))


@query("pair_scores", f"""
WITH {CENTRES}
SELECT item_id, query_id, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, query_id) AS r FROM s) WHERE r = 1""")
def pair_scores(t: Inputs):
    """Every item against every label: the best label and its score."""
    return sim.best_query(items(t), centres(t)).withColumn("score", F.round("score", 6))


@query("own_centre_score", f"""
WITH {CENTRES}
SELECT item_id, round(score, 6) AS score FROM s JOIN embeddings ON vec_id = item_id AND label = query_id""")
def own_centre_score(t: Inputs):
    """Inner product of each normalised item with its own label's normalised mean, in the JVM."""
    joined = items(t).join(centres(t).withColumnsRenamed({"query_id": "label", "vector": "centre"}), "label")
    score = inner_product(l2_normalise("vector"), l2_normalise("centre"))
    return joined.select("item_id", F.round(score, 6).alias("score"))


PREFS = """
e AS (SELECT user_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item_id, CASE WHEN event_type = 'error' THEN -4.0::DOUBLE ELSE 1.0::DOUBLE END AS reward,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS step FROM events),
items AS (SELECT item_id, row_number() OVER (ORDER BY item_id) AS pos FROM (SELECT DISTINCT item_id FROM e)),
f AS (SELECT user_id, step, pos, reward FROM e JOIN items USING (item_id)),
fold AS (
  SELECT DISTINCT user_id, 0::BIGINT AS step, list_transform(range((SELECT count(*) FROM items)), lambda x: 0.0::DOUBLE) AS q FROM e
  UNION ALL
  SELECT d.user_id, d.step + 1, list_transform(d.q, lambda v, i: CASE WHEN i = f.pos THEN v + 0.1 * (f.reward + 0.9 * list_max(d.q) - v) ELSE v END)
  FROM fold d JOIN f ON f.user_id = d.user_id AND f.step = d.step + 1),
final AS (SELECT user_id, arg_max(q, step) AS q FROM fold GROUP BY 1),
learned AS (SELECT user_id, item_id, q[pos] AS q FROM final, items WHERE (user_id, item_id) IN (SELECT (user_id, item_id) FROM e))
"""


def feedback(events: DataFrame):
    """Events as feedback on the item named in their properties; errors are a no."""
    return events.select(
        "user_id", F.regexp_extract("props", "([0-9]+)", 1).cast("bigint").alias("item_id"),
        prefs.reward_of(F.col("event_type") != "error").alias("reward"), "ts", "event_id",
    )


def learned(t: Inputs):
    rows = feedback(t.events)
    n_items = rows.select("item_id").distinct().count()
    return prefs.learn_values(rows, n_items, ["ts", "event_id"])


@query("preference_update", f"WITH RECURSIVE {PREFS} SELECT user_id, item_id, round(q, 9) AS q FROM learned")
def preference_update(t: Inputs):
    return learned(t).withColumn("q", F.round("q", 9))


@query("preference_report", f"""
WITH RECURSIVE {PREFS} SELECT user_id, count(*) AS items, count(*) FILTER (q > 0) AS liked FROM learned WHERE q <> 0 GROUP BY 1""")
def preference_report(t: Inputs):
    return prefs.nonzero(learned(t)).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("items"), F.count_if(F.col("q") > 0).alias("liked"))


@query("rerank")
def rerank(t: Inputs):
    """Each user's query is the label of the item of the latest event; 30 candidates, then the learned value."""
    found = sim.top_items(items(t), centres(t), 30).select(F.col("query_id").alias("label"), "item_id", "score")
    latest = feedback(t.events).groupBy("user_id").agg(F.max_by("item_id", F.struct("ts", "event_id")).alias("seen"))
    wanted = latest.join(t.embeddings.select(F.col("vec_id").alias("seen"), "label"), "seen").select("user_id", "label")
    candidates = prefs.with_values(wanted.join(found, "label"), learned(t))
    return prefs.choose(candidates, ["user_id"], seed=7)
