"""A stored inverted index: many keyword searches without reading the texts again.

Documents are added in segments; a segment is committed when it is complete and never changed.

    target/segments/<name>/postings/bucket=<b>   term, block, n, best, rows: array of (doc, count)
    target/segments/<name>/docs                  doc, block
    target/log/<number>                          the segment's name and number of documents

Documents of a segment lie in blocks: of nearly the same length, then by hash, some `BLOCK` in each, fewer
where texts are very long. A posting row holds one term in one block, so even a word of all documents never fills a task, and `best`,
its highest count there, bounds what the block can add to a score. A search reads the bounds of its words'
buckets, scores the k most promising blocks of every query, and then all others whose bound reaches
the k-th score found, ties included. The results are exact.

Scores are whole millionths, so that no order of summing changes them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sinks.commits import Conflict, commit, committed, content

BUCKETS = 64
BLOCK = 512
_TASK_CHARS = 1 << 24
_UNIT = 1_000_000
_BANDS_PER_DOUBLING = 4


class RepeatedDocument(ValueError):
    """A document id is null, given twice, or in the index already."""


def words(text: str | Column) -> Column:
    """The words (letters and digits) of a text in lower case, in order; none for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)")), F.array().cast("array<string>"))


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """An array that is made once per row, however often `use` names it."""
    return F.flatten(F.transform(F.array(value), use))


def word_counts(text: str | Column) -> Column:
    """Array of (term, count), by term: counted within the row, without a shuffle."""

    def runs(a: Column) -> Column:
        places = F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))
        begins = F.filter(places, lambda i: (i == 0) | (a[i] != a[F.greatest(i - 1, F.lit(0))]))
        return _bind(begins, lambda at: F.transform(at, lambda p, j: F.struct(
            a[p].alias("term"), (F.coalesce(F.get(at, j + 1), F.size(a)) - p).cast("long").alias("count"))))

    return _bind(F.sort_array(words(text)), runs)


def _bucket(term: str | Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def segments(spark: SparkSession, target: str) -> dict[str, int]:
    """The complete segments and how many documents they hold."""
    lines = (content(spark, f"{target}/log", n) for n in committed(spark, f"{target}/log"))
    return {name: int(held) for name, held in (line.split() for line in lines)}


def _posted(placed: DataFrame, tasks: int) -> DataFrame:
    """One row per term and block. A block's texts go to one task: they are smaller than their words with counts."""
    found = placed.repartition(tasks, "block").select("doc", "block", F.explode(word_counts("text")).alias("w"))
    return found.select("doc", "block", "w.*").groupBy("term", "block").agg(
        F.count("*").alias("n"), F.max("count").alias("best"), F.sort_array(F.collect_list(F.struct("doc", "count"))).alias("rows"))


def add(target: str, docs: DataFrame, doc: str, text: str) -> int:
    """Add documents as a new segment; how many there are. Earlier segments are not read but for their ids.

    Null and empty texts are documents without words. A null id, or an id that is repeated or there
    already, raises `RepeatedDocument`, and nothing is added. If another segment is committed meanwhile,
    the ids are compared with it too.
    """
    spark = docs.sparkSession
    name = uuid.uuid4().hex
    home = f"{target}/segments/{name}"
    rows = docs.select(F.col(doc).alias("doc"), F.col(text).alias("text"))
    band = F.floor(F.log2(F.coalesce(F.length("text"), F.lit(0)) + 1.0) * _BANDS_PER_DOUBLING).cast("long")
    # At most four bands for each doubling of a text's length.
    seen = rows.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).collect()
    sizes, chars = {r["band"]: r["n"] for r in seen}, {r["band"]: r["chars"] or 0 for r in seen}
    parts = F.lit(1)
    for number, held in sizes.items():
        parts = F.when(band == number, max(-(-held // BLOCK), -(-chars[number] // _TASK_CHARS))).otherwise(parts)
    placed = rows.withColumn("block", F.shiftleft(band, 40) + F.pmod(F.xxhash64("doc"), parts.cast("long")))
    placed.select("doc", "block").write.parquet(f"{home}/docs")
    fresh = spark.read.parquet(f"{home}/docs")
    if not fresh.groupBy("doc").count().where("doc IS NULL OR count > 1").isEmpty():
        raise RepeatedDocument(f"{doc} holds nulls or repeated values")
    posted = _posted(placed, max(spark.sparkContext.defaultParallelism, -(-sum(chars.values()) // _TASK_CHARS)))
    # Few files for each bucket, a large bucket split; terms are sorted, so that a file's parts can be
    # left out by their smallest and largest term.
    posted = posted.withColumn("bucket", _bucket("term")).hint("rebalance", "bucket")
    posted.sortWithinPartitions("bucket", "term", "block").write.partitionBy("bucket").parquet(f"{home}/postings")
    total, compared = sum(sizes.values()), set()
    while True:
        number = max(committed(spark, f"{target}/log"), default=0) + 1
        others = [s for s in segments(spark, target) if s not in compared]
        if others:
            held = spark.read.parquet(*[f"{target}/segments/{s}/docs" for s in others])
            if not held.join(fresh, "doc", "left_semi").isEmpty():
                raise RepeatedDocument(f"{doc} holds values that are in the index")
            compared.update(others)
        try:
            commit(spark, f"{target}/log", number, f"{name} {total}")
            return total
        except Conflict:
            continue


def _postings(spark: SparkSession, target: str, names: list[str], buckets: list[int]) -> DataFrame:
    """Posting rows of some buckets; a block's number is made one of the whole index by its segment."""
    parts = None
    for place, name in enumerate(sorted(names)):
        part = spark.read.parquet(f"{target}/segments/{name}/postings").where(F.col("bucket").isin(buckets))
        part = part.withColumn("block", F.struct(F.lit(place).alias("segment"), F.col("block").alias("part")))
        parts = part if parts is None else parts.unionByName(part)
    return parts


def search(spark: SparkSession, target: str, queries: DataFrame, query: str, text: str, k: int) -> DataFrame:
    """(query, doc, score, matched, place): the k best documents of every query, ties by smaller document id.

    The score adds, for each different word of the query, its count in the document times its rarity
    ln((1 + documents) / (1 + documents with the word)) + 1, rounded to millionths. `matched` counts the
    different words found; documents with none have no row. Rows of the same query id are one query.
    """
    held = segments(spark, target)
    total = sum(held.values())
    # In a struct, so that a null id is a query like others.
    asked = queries.select(F.struct(F.col(query).alias("id")).alias("query"), F.explode(F.array_distinct(words(text))).alias("term")).distinct()
    asked = cut_lineage(asked)
    buckets = sorted(r["b"] for r in asked.select(_bucket("term").alias("b")).distinct().collect())
    names = [n for n, docs in held.items() if docs]
    key = queries.select(F.col(query).alias("query")).schema["query"].dataType
    if not buckets or not names:
        id_type = "bigint" if not held else spark.read.parquet(f"{target}/segments/{next(iter(held))}/docs").schema["doc"].dataType.simpleString()
        return spark.createDataFrame([], f"query {key.simpleString()}, doc {id_type}, score double, matched bigint, place int")
    stored = _postings(spark, target, names, buckets)
    # Only bounds are read here; the documents' counts are another column.
    bounds = stored.join(asked.select("term").distinct(), "term", "left_semi").select("term", "block", "n", "best")
    seen = bounds.groupBy("term").agg(F.sum("n").alias("held"))
    rarity = F.log((F.lit(total) + 1.0) / (F.col("held") + 1.0)) + 1
    weighed = cut_lineage(asked.join(seen.select("term", F.round(rarity * _UNIT).cast("long").alias("weight")), "term"))
    limit = F.sum(F.col("best") * F.col("weight")).alias("limit")
    limits = cut_lineage(bounds.join(weighed, "term").groupBy("query", "block").agg(limit))
    # A block that is listed holds a document at least, so k blocks hold k.
    ahead = Window.partitionBy("query").orderBy(F.desc("limit"), "block")
    first = cut_lineage(limits.withColumn("_at", F.row_number().over(ahead)).where(F.col("_at") <= k).select("query", "block"))
    one = cut_lineage(_best(_scored(stored, weighed, first), k))
    reached = one.where(F.col("place") == k).select("query", F.col("points").alias("least"))
    rest = limits.join(reached, ["query"], "left").where(F.col("limit") >= F.coalesce("least", F.lit(0)))
    rest = rest.join(first, ["query", "block"], "left_anti").select("query", "block")
    found = _best(one.drop("place").unionByName(_best(_scored(stored, weighed, rest), k).drop("place")), k)
    return found.select(F.col("query.id").alias("query"), "doc", (F.col("points") / _UNIT).alias("score"), "matched", "place")


def _scored(stored: DataFrame, weighed: DataFrame, visits: DataFrame) -> DataFrame:
    """query, doc, points, matched for all documents in the blocks that a query visits."""
    wanted = visits.join(weighed, "query").select("query", "term", "weight", "block")
    met = stored.select("term", "block", "rows").join(wanted, ["term", "block"])
    each = met.select("query", "weight", F.inline("rows"))
    return each.groupBy("query", "doc").agg(
        F.sum(F.col("count") * F.col("weight")).alias("points"), F.count("*").alias("matched"))


def _best(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("points"), "doc")
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
