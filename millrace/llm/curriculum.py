"""Operator 11: a training mix whose weights change over time.

Every source has a schedule, its weight as a piecewise linear function of training progress. The integral
of the schedule is the source's weight in the mix, which gives the words it has to deliver; the
part of the integral up to some progress gives the words it has to have delivered by then. A source's
documents stand in a fixed shuffled order, in as many passes as its target needs; inverting the demand
at a document's place in that order gives its place in training, and the mix is sorted by ranges of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .base import query, table
from .manifest import positions

WORDS = r"[^\x20\x09-\x0D]+"
# (progress, weight) in turn for the sources: falling, rising, and highest midway. Integrals 3, 1, 2.
SCHEDULES = (((0.0, 4.5), (1.0, 1.5)), ((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (0.5, 3.0), (1.0, 1.0)))
# Words of the mix, and the most of any source, as shares of what there is.
SHARE, MOST = 1.5, 2
# Documents of a source are put in order in buckets of about this many rows.
BUCKET_ROWS = 1 << 12


def integral(schedule: Sequence[tuple[float, float]]) -> float:
    return sum((b - a) * (v + w) / 2 for (a, v), (b, w) in zip(schedule, schedule[1:]))


def progress(share: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """The progress by which a source has delivered `share` (0 to 1) of its words.

    On every stretch between two points of the schedule the demand is a quadratic, whose root is
    taken in the form that also holds for a constant weight.
    """
    whole, done = integral(schedule), 0.0
    out = None
    for (a, v), (b, w) in zip(schedule, schedule[1:]):
        rest = share * F.lit(whole) - F.lit(done)
        slope = (w - v) / (b - a)
        at = F.lit(a) + F.lit(2.0) * rest / (F.lit(v) + F.sqrt(F.greatest(F.lit(v * v) + F.lit(2 * slope) * rest, F.lit(0.0))))
        done += (b - a) * (v + w) / 2
        at = F.least(at, F.lit(b))
        out = F.when(share * F.lit(whole) <= F.lit(done), at) if out is None else out.when(share * F.lit(whole) <= F.lit(done), at)
    return out.otherwise(F.lit(schedule[-1][0]))


def targets(sources: DataFrame, schedules=SCHEDULES, share: float = SHARE, most: int = MOST) -> DataFrame:
    """source, size -> source, size, turn, target: words that each source gives to the mix.

    Sources by code point, null last, take the schedules in turn. All share `share` times the words
    there are by weight; a source stops at `most` times its size, and what it cannot give is shared
    anew by weight until no source is above its limit. Each round is one sum over the sources.
    """
    spark = sources.sparkSession
    # Nulls come last: sorted by whether the source is null first.
    ranked = positions(sources.withColumn("none", F.col("source").isNull()), [], ["none", "source"], "place", "sources")
    weights = F.array(*[F.lit(integral(s)) for s in schedules])
    ranked = ranked.withColumn("turn", (F.col("place") % len(schedules)).cast("int"))
    path = scratch_path(spark, "sources")
    ranked.select("source", "size", "turn", F.element_at(weights, F.col("turn") + 1).alias("weight"), (F.col("size") * F.lit(float(most))).alias("cap")).write.parquet(path)
    rows = spark.read.parquet(path)
    total = rows.agg(F.sum("size")).first()[0] or 0
    level = 0.0
    while True:
        full = F.col("cap") <= F.col("weight") * F.lit(level)
        given, left = rows.agg(F.sum(F.when(full, F.col("cap")).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if not left:
            break
        new = (share * total - given) / left
        if new <= level:
            break
        level = new
    return rows.select("source", "size", "turn", F.least("cap", F.col("weight") * F.lit(level)).alias("target"))


def plan(
    docs: DataFrame, schedules=SCHEDULES, share: float = SHARE, most: int = MOST, seed: int = 0, doc_id: str = "doc_id",
    text: str = "text", source: str = "source",
) -> DataFrame:
    """One row per document: id, size, source, source_size, target, taken, passes.

    passes lists, for each time the mix reads the document, how many words it takes and at which
    progress it starts to (0 to 1). A source's documents stand in the order of a hash of seed and
    id (then id, then size), from its first to its last, again and again, until the target, rounded to words, is
    reached: the document met there is cut. So taken words of a source add up to its target, and no
    document is read more than `most` times. Documents of no words and those behind the target have no passes.

    Null texts have size 0, null sources are a source of their own, ids may be null or repeat (rows
    alike in id, size and source may swap places). Running sums go over buckets of the hash, some
    thousand rows each, and over the buckets of a source, so that no source is held by one task.
    """
    spark = docs.sparkSession
    # Sixty bits of the hash.
    key = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(docs[doc_id].cast("string"), F.lit(""))), 256), 1, 15), 16, 10).cast("long")
    size = F.coalesce(F.regexp_count(docs[text].cast("string"), F.lit(WORDS)), F.lit(0)).cast("long")
    sized = cut_lineage(docs.select(docs[doc_id].alias("id"), docs[source].cast("string").alias("source"), size.alias("size"), key.alias("key")))
    sums = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    path = scratch_path(spark, "targets")
    goals = targets(sums.select("source", "size"), schedules, share, most)
    rows_of = sums.select(F.col("source").alias("of"), "rows")
    goals.join(rows_of, goals["source"].eqNullSafe(rows_of["of"])).drop("of").write.parquet(path)
    goals = spark.read.parquet(path).withColumnRenamed("source", "of").withColumnRenamed("size", "source_size")
    # As many leading bits of the key as make buckets of the wanted size.
    bits = F.greatest(F.lit(0), F.ceil(F.log2(F.col("rows") / BUCKET_ROWS))).cast("int")
    rows = sized.join(goals, sized["source"].eqNullSafe(goals["of"])).withColumn("bucket", F.call_function("shiftright", F.col("key"), F.lit(60) - bits))
    within = Window.partitionBy("source", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum("size").over(within), F.lit(0)))
    buckets = sized.join(goals.select("of", "rows"), sized["source"].eqNullSafe(goals["of"]))
    buckets = buckets.groupBy("of", F.call_function("shiftright", F.col("key"), F.lit(60) - bits).alias("number")).agg(F.sum("size").alias("here"))
    ahead = Window.partitionBy("of").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(F.col("of").alias("whose"), "number", F.coalesce(F.sum("here").over(ahead), F.lit(0)).alias("ahead"))
    rows = rows.join(buckets, rows["source"].eqNullSafe(buckets["whose"]) & (rows["bucket"] == buckets["number"]))
    rows = rows.withColumn("start", F.col("start") + F.col("ahead"))
    goal = F.round("target").cast("long")
    passes = []
    for i in range(most):
        start = F.col("start") + F.col("source_size") * i
        words = F.least(F.col("size"), F.greatest(goal - start, F.lit(0)))
        share_done = start / F.col("target")
        at = F.lit(None).cast("double")
        for turn, schedule in enumerate(schedules):
            at = F.when(F.col("turn") == turn, progress(share_done, schedule)).otherwise(at)
        passes.append(F.when(words > 0, F.struct(words.alias("words"), at.alias("position"))))
    rows = rows.withColumn("passes", F.array_compact(F.array(*passes)))
    return rows.select(
        F.col("id").alias(doc_id), "size", F.col("source").alias(source), "source_size", "target",
        F.aggregate("passes", F.lit(0).cast("long"), lambda n, p: n + p["words"]).alias("taken"), "passes",
    )


def mix(planned: DataFrame) -> DataFrame:
    """The mix in training order: one row per reading of a document, with words and position.

    Sorted by ranges of the position, so every task holds one stretch of training. Rows at the same
    position go by their other columns.
    """
    keep = [c for c in planned.columns if c != "passes"]
    rows = planned.select(*keep, F.explode("passes").alias("reading")).select(*keep, "reading.*")
    return rows.orderBy("position", *keep, "words")


_ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(sha256('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
  FROM documents),
sums AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, ([1.0, 2.0, 3.0]::DOUBLE[])[(place % 3 = 2)::INT + 2 * (place % 3 = 0)::INT + 3 * (place % 3 = 1)::INT] AS weight,
    (place - 1) % 3 AS turn, 2.0::DOUBLE * source_size AS cap
  FROM sums),
-- In order of how soon a source is full, the level that the rest reaches when those before it are full.
filled AS (
  SELECT *, coalesce(sum(cap) OVER w, 0)::DOUBLE AS full_before, coalesce(sum(weight) OVER w, 0)::DOUBLE AS weight_before,
    sum(weight) OVER ()::DOUBLE AS weights, sum(source_size) OVER ()::DOUBLE AS total
  FROM weighed WINDOW w AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT max((1.5::DOUBLE * total - full_before) / (weights - weight_before)) AS level FROM filled),
goals AS (
  SELECT source, source_size, turn, least(cap, weight * level) AS target FROM filled, level),
placed AS (
  SELECT s.doc_id, s.size, g.source_size, g.target, g.turn, round(g.target)::BIGINT AS goal,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source),
taken AS (
  SELECT *, least(size, greatest(goal - start, 0)) + least(size, greatest(goal - start - source_size, 0)) AS taken FROM placed),
shares AS (
  SELECT *, CASE WHEN least(size, greatest(goal - start, 0)) > 0 THEN start / target END AS done FROM taken)
SELECT doc_id, size, source_size, target, taken,
  round(CASE turn
    WHEN 0 THEN (4.5 - sqrt(4.5 * 4.5 - 2 * 3.0 * 3.0 * done)) / 3.0
    WHEN 1 THEN (sqrt(0.5 * 0.5 + 2 * 1.0 * done) - 0.5) / 1.0
    ELSE CASE WHEN done <= 0.5 THEN (sqrt(1.0 + 2 * 4.0 * 2.0 * done) - 1.0) / 4.0
         ELSE 1.0 - (sqrt(1.0 + 2 * 4.0 * 2.0 * (1.0 - done)) - 1.0) / 4.0 END
    END, 6) AS position
FROM shares
"""


@query("op11_curriculum_mix", _ORACLE)
def op11(spark, folder):
    """All documents with what the mix takes of them, in order of their first reading."""
    planned = plan(table(spark, folder, "documents"))
    first = F.round(F.get("passes", F.lit(0))["position"], 6)
    return planned.select("doc_id", "size", "source_size", "target", "taken", first.alias("position")).orderBy(F.col("position").asc_nulls_last(), "doc_id")
