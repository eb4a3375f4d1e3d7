"""Operator 12: how filters interact, whatever their order.

Every document gets the set of filters that it fails, as bits. Copies are found by an existential
self-join: a left-semi join on the text's hash, the exact text and a smaller id. The ids of copies are
united with those of the other failures, the bits of an id are put together, and what is left of the
corpus is one count per part and combination of bits. All orders of the filters follow from these.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .base import query, table

WORDS = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COPIES = "E"

# Let a join that shuffles filter its larger side by a Bloom filter of its smaller one. The filter has
# 8 MB at most; if there are more hashes than it tells apart, more texts are shuffled, none is lost.
BLOOM = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1MB",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1TB",
}


def failures(text: Column) -> dict[str, Column]:
    """The conditions on a text alone, by the letters of their filters; `text` is never null."""
    words = F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))
    n_words, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, UPPER, ""))
    return {
        "A": n_words < 50,
        "B": F.lit(100) * distinct < F.lit(65) * n_words,
        "C": F.lit(100) * capitals > F.lit(5) * F.length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def copies(docs: DataFrame, repeated: DataFrame) -> DataFrame:
    """id, part and hash of every row of `docs` whose text some smaller id has as well.

    docs: id, part, hash, text; repeated: hash, n (its rows, more than 1) and the smallest id of each
    hash that occurs again. Of equal texts the smallest id stands for all that may be smaller, so a
    group of any size meets one row. Only texts with such a hash are moved and compared.
    """
    rows = docs.join(repeated.where("n > 1").drop("n"), "hash").where("id >= first")
    first = rows.where("id = first").alias("a")
    later = rows.where("id > first").alias("b")
    return later.join(first, F.expr("a.hash = b.hash AND a.text = b.text AND a.id < b.id"), "left_semi").select("id", "part", "hash")


def combinations(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "source",
    rules=failures, quality: str = "quality", toxic: str = "toxic",
) -> DataFrame:
    """part, bits, n, good, toxic: rows of each part that fail just the filters in `bits`.

    Bit i is the filter in place i of the letters of `rules`, the last bit stands for copies. A null
    part or text counts as empty. Rows with the same id are separate rows, none smaller than the other;
    a null id is neither smaller nor greater than any. A document is good (toxic) if any of its
    labels says so; without a label it is neither.
    """
    spark = docs.sparkSession
    body = F.coalesce(docs[text].cast("string"), F.lit(""))
    rows = docs.select(
        docs[doc_id].alias("id"), F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(body, 256)).alias("hash"), body.alias("text")
    )
    conditions = rules(F.col("text"))
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions.values())), F.lit(0))
    marked = cut_lineage(rows.select("id", "part", "hash", bits.alias("bits")))
    # Written, so that Spark knows the size: a short list is broadcast, for a long one both sides are
    # shuffled, the texts behind a Bloom filter of the list.
    for key, value in BLOOM.items():
        spark.conf.set(key, value)
    path = scratch_path(spark, "hashes")
    marked.groupBy("hash").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").write.parquet(path)
    found = copies(rows, spark.read.parquet(path))
    # Rows alike in id, part and hash fail alike.
    keys = ["id", "part", "hash"]
    failed = marked.select(*keys, "bits", F.lit(1).alias("n")).unionByName(
        found.select(*keys, F.lit(1 << len(conditions)).alias("bits"), F.lit(0).alias("n"))
    )
    each = failed.groupBy(*keys).agg(F.bit_or("bits").alias("bits"), F.sum("n").alias("n"))
    said = labels.groupBy(labels[doc_id].alias("id")).agg(F.max(labels[quality] == 1).alias("is_good"), F.max(labels[toxic] == 1).alias("is_toxic"))
    each = each.join(said, "id", "left")
    yes = lambda flag: F.sum(F.when(F.col(flag), F.col("n")).otherwise(0))
    return each.groupBy("part", "bits").agg(F.sum("n").alias("n"), yes("is_good").alias("good"), yes("is_toxic").alias("toxic"))


def audit(counts: DataFrame, letters: str) -> DataFrame:
    """One row per part, order of the filters and step, from the counts of `combinations`.

    A part's counts become three arrays, indexed by the combination; every order of the filters is
    read off them. shapley is the number of documents that the step's filter removes, summed over all
    orders: a document failing k filters is removed by each of them in one order out of k.
    """
    every = range(1 << len(letters))
    slots = [F.struct(*[F.coalesce(F.max(F.when(F.col("bits") == c, F.col(v))), F.lit(0)).alias(v) for v in ("n", "good", "toxic")]) for c in every]
    parts = counts.groupBy("part").agg(F.array(*slots).alias("slots"))
    orders = ["".join(p) for p in permutations(letters)]
    bit = lambda i: f"shiftleft(1, instr('{letters}', substr(filter_order, {i}, 1)) - 1)"
    rows = parts.withColumn("filter_order", F.explode(F.split(F.lit(" ".join(orders)), " ")))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))))
    rows = rows.withColumn("mine", F.expr(bit("step"))).withColumn(
        "before", F.expr(f"aggregate(filter(sequence(1, {len(letters)}), i -> i < step), 0, (m, i) -> m | {bit('i')})")
    )

    def total(value: str, condition: str):
        each = f"aggregate(sequence(0, {len(every) - 1}), 0L, (s, c) -> s + IF({condition}, {value}, 0L))"
        return F.expr(each)

    removed = "(c & mine) > 0 AND (c & before) = 0"
    return rows.select(
        "part", "filter_order", "step",
        total("slots[c].n", "(c & (mine | before)) = 0").alias("kept"),
        total("slots[c].n", removed).alias("removed"),
        total("slots[c].n", "(c & mine) > 0 AND (c & before) > 0").alias("redundant"),
        F.expr("slots[mine].n").alias("unique_fails"),
        total("slots[c].good", removed).alias("good_lost"),
        total("slots[c].toxic", removed).alias("toxic_lost"),
        total(f"slots[c].n * ({len(orders)}L div bit_count(c))", "(c & mine) > 0").alias("shapley"),
    )


_ORACLE = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
marked AS (
  SELECT doc_id, part,
    len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
    100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) AS c,
    regexp_matches(text, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM words),
said AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS f,
    a::INT + b::INT + c::INT + d::INT + e::INT AS k
  FROM marked LEFT JOIN said USING (doc_id)),
combos AS (
  SELECT part, f, k, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY part, f, k),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.x NOT IN (q.x, r.x, s.x, t.x) AND q.x NOT IN (r.x, s.x, t.x) AND r.x NOT IN (s.x, t.x) AND s.x <> t.x),
steps AS (
  SELECT filter_order, step::INT AS step, substr(filter_order, step, 1) AS mine, substr(filter_order, 1, step - 1) AS before
  FROM orders, range(1, 6) AS r(step)),
judged AS (
  SELECT part, filter_order, step, n, good, toxic, k,
    CASE mine WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END AS fails,
    (contains(before, 'A') AND f.A) OR (contains(before, 'B') AND f.B) OR (contains(before, 'C') AND f.C)
      OR (contains(before, 'D') AND f.D) OR (contains(before, 'E') AND f.E) AS gone
  FROM combos, steps)
SELECT part, filter_order, step,
  coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0)::BIGINT AS kept,
  coalesce(sum(n) FILTER (fails AND NOT gone), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (fails AND gone), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (fails AND k = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(good) FILTER (fails AND NOT gone), 0)::BIGINT AS good_lost,
  coalesce(sum(toxic) FILTER (fails AND NOT gone), 0)::BIGINT AS toxic_lost,
  coalesce(sum(n * (120 // greatest(k, 1))) FILTER (fails), 0)::BIGINT AS shapley
FROM judged GROUP BY part, filter_order, step
"""


@query("op12_filter_audit", _ORACLE)
def op12(spark, folder):
    """Every part's filters in all 120 orders."""
    counts = combinations(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return audit(counts, "ABCD" + COPIES)
