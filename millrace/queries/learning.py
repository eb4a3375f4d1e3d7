"""Classifiers on the labelled documents and on orders. Results depend on the solver, so no SQL."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import learn, many
from ..operators.embed import hashed_text_vectors
from ..session import cut_lineage
from .base import Inputs, query

NUMERIC = ["log_chars", "words", "lines", "upper_share", "digit_share"]


def labelled(t: Inputs):
    """Documents with a quality label and a few whole-text features."""
    size = F.length("text")
    rows = t.documents.join(t.labels, "doc_id")
    return rows.select(
        F.col("quality").cast("double").alias("label"), "lang",
        F.log(size + 1).alias("log_chars"), F.size(F.split("text", " ")).cast("double").alias("words"),
        F.size(F.split("text", "\n")).cast("double").alias("lines"),
        (F.length(F.regexp_replace("text", "[^A-Z]", "")) / (size + 1)).alias("upper_share"),
        (F.length(F.regexp_replace("text", "[^0-9]", "")) / (size + 1)).alias("digit_share"),
    )


def prepared(t: Inputs):
    rows = labelled(t)
    return Pipeline(stages=learn.encoder(["lang"], NUMERIC)).fit(rows).transform(rows).select("label", "features")


def chosen(model, ranks):
    """Standardised features, those that the elimination with `ranks` keeps, and the model."""
    return Pipeline(stages=[learn.scaler(), learn.Elimination(ranks), model])


@query("classify_cv")
def classify_cv(t: Inputs):
    """Ten-fold accuracy of a logistic regression and of boosted trees, each on the features it chose in the fold."""
    return many.cross_validate(cut_lineage(prepared(t)))


@query("feature_elimination")
def feature_elimination(t: Inputs):
    rows = cut_lineage(prepared(t))
    names = [f"lang_{i}" for i in range(rows.first().features.size - len(NUMERIC))] + NUMERIC
    return learn.eliminate_features(rows, names)


@query("random_search")
def random_search(t: Inputs):
    model = learn.boosted("chosen")
    grid = {
        model.maxIter: list(range(50, 550, 50)), model.stepSize: [k / 100 for k in range(1, 21)], model.maxDepth: list(range(3, 9)),
    }
    job = chosen(model, learn.boosted("chosen", maxIter=100, maxDepth=3))
    return learn.random_search(cut_lineage(prepared(t)), job, grid, tries=10)


@query("encode_scale", """
WITH d AS (SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS x, o_orderpriority AS p FROM orders),
m AS (SELECT avg(x) AS a, stddev_samp(x) AS s FROM d)
SELECT o_orderkey, round((x - a) / s, 6) AS scaled, CAST(p = '5-LOW' AS INTEGER) + 2 * CAST(p = '4-NOT SPECIFIED' AS INTEGER)
  + 4 * CAST(p = '3-MEDIUM' AS INTEGER) + 8 * CAST(p = '2-HIGH' AS INTEGER) AS hot FROM d, m""")
def encode_scale(t: Inputs):
    """One-hot priority without its first value, and the standardised price."""
    from pyspark.ml.feature import VectorAssembler

    stages = [
        *learn.encoder(["o_orderpriority"], []), VectorAssembler(inputCols=["o_totalprice"], outputCol="price"),
        learn.scaler("price", "price_scaled"),
    ]
    out = Pipeline(stages=stages).fit(t.orders).transform(t.orders)
    hot = vector_to_array("features")
    code = sum((F.get(hot, F.lit(i)) * 2**i for i in range(4)), F.lit(0.0))
    return out.select("o_orderkey", F.round(F.get(vector_to_array("price_scaled"), F.lit(0)), 6).alias("scaled"),
                      code.cast("int").alias("hot"))


@query("binary_codes", """
SELECT l_linestatus, CAST(l_linestatus <> (SELECT min(l_linestatus) FROM lineitem) AS INTEGER) AS code, count(*) AS n FROM lineitem GROUP BY ALL""")
def binary_codes(t: Inputs):
    coded = learn.binary_code(t.lineitem.select("l_linestatus"), "l_linestatus", "code")
    return coded.groupBy("l_linestatus", "code").agg(F.count(F.lit(1)).alias("n"))


@query("text_vectors")
def text_vectors(t: Inputs):
    """Hashed TF-IDF vectors of every document: length and non-zero entries."""
    rows = hashed_text_vectors(t.documents.select("doc_id", "text"), "text", 64)
    return rows.select("doc_id", F.size("vector").alias("size"), F.size(F.filter("vector", lambda v: v > 0)).alias("nonzero"))
