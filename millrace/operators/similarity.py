"""Exact nearest neighbours by cosine.

A few queries are sent to all tasks, which read the items once. For more of them items are gathered in
clusters around some of their own, and each query meets the clusters that may hold one of its best: first
those nearest to it, then all whose bound (from centre and radius) reaches the k-th score so far.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import cut_lineage, scratch_path

# Up to this many queries are sent to the tasks; more are rows, in blocks of this many.
QUERY_BLOCK = 1024
# Centres of clusters, which every task gets; items of a cluster in one unit of work, at most about.
CENTRES = 1024
UNIT = 4096
# Slack of a bound against rounding.
SLACK = 1e-7
# Scores are compared at this many decimals, so that copies of a vector tie.
SCORE_PLACES = 10


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
    return np.divide(rows, length, out=rows.copy(), where=length > 0)


def _matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = np.asarray(column.flatten(), dtype=np.float64)
    if len(flat) != len(column) * width:
        raise ValueError(f"every vector must have {width} values")
    return flat.reshape(len(column), width)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best rows: highest score, then smallest id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        above, at = np.flatnonzero(scores > cut), np.flatnonzero(scores == cut)
        at = at[np.argsort(ids[at], kind="stable")][: k - len(above)]
        rows = np.concatenate([above, at])
    else:
        rows = np.arange(len(scores))
    return rows[np.lexsort((ids[rows], -scores[rows]))]


def _narrow(df: DataFrame, name: str, vector: str, to: str) -> DataFrame:
    return df.select(F.col(name).alias(to), F.col(vector).cast("array<double>").alias("v")).where("v is not null")


def top_items(
    items: DataFrame, queries: DataFrame, k: int,
    item_id: str = "item_id", item_vector: str = "vector",
    query_id: str = "query_id", query_vector: str = "vector",
) -> DataFrame:
    """query_id, item_id, score, place: the k items of highest cosine score for each query.

    Ties go to the smaller id. Vectors are finite and of one length; null vectors take no part. A query id that
    occurs twice gets its k items once, over all its rows.

    Up to QUERY_BLOCK queries: every task scores its items against all queries and passes on k items
    per query. More: see `search`. No pair beyond the k best leaves a task.
    """
    item_type, query_type = (df.schema[c].dataType for df, c in ((items, item_id), (queries, query_id)))
    narrow, asked = _narrow(items, item_id, item_vector, "item_id"), _narrow(queries, query_id, query_vector, "query_id")
    some = asked.limit(QUERY_BLOCK + 1).collect()
    if len(some) > QUERY_BLOCK:
        found, _ = search(narrow, asked, k)
    elif some:
        matrix = _unit(np.array([row[1] for row in some], dtype=np.float64))
        schema = f"query_id {query_type.simpleString()}, item_id {item_type.simpleString()}, score double"
        found = narrow.mapInArrow(_scorer([row[0] for row in some], matrix, k, to_arrow_type(query_type)), schema)
    else:
        found = asked.join(narrow.select("item_id"), F.lit(False)).select("query_id", "item_id", F.lit(0.0).alias("score"))
    return _ranked(found, "query_id", k)


def _ranked(found: DataFrame, by: str, k: int) -> DataFrame:
    w = Window.partitionBy(by).orderBy(F.desc("score"), "item_id")
    return found.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def _gather(items: DataFrame, centres: np.ndarray, path: str):
    """Write the items with their cluster; for each cluster its rows and least cosine to the centre.

    The last cluster is for vectors of length zero, which have no angle.
    """
    width = centres.shape[1]
    kind = items.schema["item_id"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(_matrix(batch.column(1), width))
            cosine = unit @ centres.T
            near = cosine.argmax(axis=1)
            near[~unit.any(axis=1)] = len(centres)
            at = np.minimum(near, len(centres) - 1)
            rows = pa.FixedSizeListArray.from_arrays(pa.array(unit.ravel()), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), rows, pa.array(near, pa.int32()), pa.array(cosine[np.arange(len(at)), at])], names=["item_id", "v", "cluster", "cosine"]
            )

    items.mapInArrow(assign, f"item_id {kind}, v array<double>, cluster int, cosine double").write.parquet(path)
    stored = items.sparkSession.read.parquet(path)
    sizes, least = np.zeros(len(centres) + 1, dtype=np.int64), np.ones(len(centres) + 1)
    for r in stored.groupBy("cluster").agg(F.count("*").alias("n"), F.min("cosine").alias("least")).collect():
        sizes[r["cluster"]], least[r["cluster"]] = r["n"], r["least"]
    return stored.drop("cosine"), sizes, least


def _bounds(unit: np.ndarray, centres: np.ndarray, sizes: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The highest cosine that any item of each cluster may have with each query."""
    angle = np.arccos(np.clip(unit @ centres.T, -1, 1)) - np.arccos(np.clip(least[:-1], -1, 1))
    bounds = np.hstack([np.cos(np.maximum(angle, 0)), np.zeros((len(unit), 1))])
    return np.where(sizes > 0, bounds + SLACK, -2.0)


def _visits(queries: DataFrame, choose, columns: str) -> DataFrame:
    """q, v, cluster: the clusters that `choose` picks for each query."""
    names = [c.split()[0] for c in columns.split(", ")]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows, cluster = choose(batch)
                out = pa.table(batch).take(pa.array(rows)).select(["q", "v"]).append_column("cluster", pa.array(cluster, pa.int32()))
                yield from out.select(names).to_batches()

    return queries.mapInArrow(pick, columns)


def _meet(stored: DataFrame, visits: DataFrame, sizes: np.ndarray, k: int, path: str) -> tuple[DataFrame, int]:
    """q, item_id, score: the k best of each unit that a query visits; and the number of pairs scored.

    The items of a large cluster are dealt to units, the queries of a much visited one to blocks; a
    unit meets a block in one task.
    """
    spark = stored.sparkSession
    visits.write.parquet(path)
    visits = spark.read.parquet(path)
    asked = {r["cluster"]: r["n"] for r in visits.groupBy("cluster").agg(F.count("*").alias("n")).collect()}
    pairs = sum(int(sizes[c]) * n for c, n in asked.items())
    rows = [(c, max(1, -(-int(sizes[c]) // UNIT)), max(1, -(-n // QUERY_BLOCK))) for c, n in asked.items()]
    table = spark.createDataFrame(rows, "cluster int, units int, blocks int")
    kind = stored.schema["item_id"].dataType.simpleString()
    left = visits.join(table, "cluster").select(
        "cluster", F.explode(F.sequence(F.lit(0), F.col("units") - 1)).alias("unit"), F.pmod(F.xxhash64("q"), "blocks").cast("int").alias("block"), "q", "v")
    right = stored.join(table, "cluster").select(
        "cluster", F.pmod(F.xxhash64("item_id", "v"), "units").cast("int").alias("unit"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "item_id", "v")
    right = right.withColumnRenamed("v", "w")

    def score(queries: pa.Table, items: pa.Table) -> pa.Table:
        out_q, out_i, out_s = [], [], []
        if len(queries) and len(items):
            width = len(queries["v"][0])
            ids = items["item_id"].to_numpy()
            scores = np.round(_matrix(items["w"], width) @ _matrix(queries["v"], width).T, SCORE_PLACES)
            for j, q in enumerate(queries["q"].to_pylist()):
                best = _best(scores[:, j], ids, k)
                out_q += [q] * len(best)
                out_i.append(best)
                out_s.append(scores[best, j])
        at = pa.array(np.concatenate(out_i) if out_i else np.zeros(0, dtype=np.int64))
        return pa.table({"q": pa.array(out_q, pa.int64()), "item_id": items["item_id"].combine_chunks().take(at), "score": np.concatenate(out_s) if out_s else np.zeros(0)})

    keys = ["cluster", "unit", "block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, f"q bigint, item_id {kind}, score double"), pairs


def search(items: DataFrame, queries: DataFrame, k: int) -> tuple[DataFrame, float]:
    """query_id, item_id, score of the k best items per query row at least; the share of all pairs that was scored.

    items (item_id, v) are read once and written by cluster: as many as the root of their number, CENTRES
    at most, around items drawn by a hash. Queries (query_id, v) stay rows on the cluster. First every
    query meets its most promising clusters, until these hold k items; its k-th score is then
    a bound, and it meets every other cluster whose bound reaches it, so nothing is missed.
    """
    spark = items.sparkSession
    home = scratch_path(spark, "search")
    asked = cut_lineage(queries.withColumn("q", F.monotonically_increasing_id()))
    n = items.count()
    drawn = items.orderBy(F.xxhash64("v"), "item_id").limit(max(1, min(CENTRES, int(np.sqrt(n))))).collect()
    none = asked.join(items.select("item_id"), F.lit(False)).select("query_id", "item_id", F.lit(0.0).alias("score"))
    if not drawn:
        return none, 0.0
    centres = np.unique(_unit(np.array([r["v"] for r in drawn], dtype=np.float64)), axis=0)
    stored, sizes, least = _gather(items, centres, f"{home}/items")
    width = centres.shape[1]

    def first(batch: pa.RecordBatch):
        unit = _unit(_matrix(batch.column("v"), width))
        bounds = _bounds(unit, centres, sizes, least)
        order = np.argsort(-bounds, axis=1, kind="stable")
        held = np.cumsum(sizes[order], axis=1)
        take = (held - sizes[order] < k) & (sizes[order] > 0)
        rows, at = np.nonzero(take)
        return rows, order[rows, at]

    def rest(batch: pa.RecordBatch):
        unit = _unit(_matrix(batch.column("v"), width))
        bounds = _bounds(unit, centres, sizes, least)
        seen, reached = first(batch), np.array(batch.column("least").to_numpy(zero_copy_only=False), dtype=float)
        bounds[seen] = -2.0
        return np.nonzero((bounds > -2.0) & ~(bounds < reached[:, None]))

    unit_rows = _units(asked, width)
    columns = "q long, v array<double>, cluster int"
    one, pairs = _meet(stored, _visits(unit_rows, first, columns), sizes, k, f"{home}/first")
    one = cut_lineage(_ranked(one, "q", k))
    bound = one.where(F.col("place") == k).select(F.col("q").alias("of"), F.col("score").alias("least"))
    known = unit_rows.join(bound, F.col("q") == F.col("of"), "left").select("q", "v", F.coalesce("least", F.lit(-2.0)).alias("least"))
    two, more = _meet(stored, _visits(known, rest, columns), sizes, k, f"{home}/rest")
    found = one.drop("place").unionByName(two).join(asked.select("q", "query_id"), "q")
    total = n * asked.count()
    return found.select("query_id", "item_id", "score"), (pairs + more) / total if total else 0.0


def _units(rows: DataFrame, width: int) -> DataFrame:
    """q, v: the rows' vectors at length one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _unit(_matrix(batch.column("v"), width))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(unit.ravel()), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("q"), rows], names=["q", "v"])

    return rows.select("q", "v").mapInArrow(work, "q long, v array<double>")


def _scorer(names: list, matrix: np.ndarray, k: int, name_type: pa.DataType):
    width = matrix.shape[1]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list = [None] * len(names)
        kinds = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            kinds = batch.schema.field(0).type
            scores = np.round(_unit(_matrix(batch.column(1), width)) @ matrix.T, SCORE_PLACES)
            for q in range(len(names)):
                s, i = scores[:, q], ids
                if best[q] is not None:
                    s, i = np.concatenate([best[q][0], s]), np.concatenate([best[q][1], i])
                rows = _best(s, i, k)
                best[q] = (s[rows], i[rows])
        for q, kept in enumerate(best):
            if kept is not None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[q]] * len(kept[0]), type=name_type), pa.array(kept[1], type=kinds), pa.array(kept[0])],
                    names=["query_id", "item_id", "score"],
                )

    return score


def best_query(
    items: DataFrame, queries: DataFrame,
    item_id: str = "item_id", item_vector: str = "vector",
    query_id: str = "query_id", query_vector: str = "vector",
) -> DataFrame:
    """item_id, query_id, score: the query that fits each item best, ties to the smaller id.

    Up to QUERY_BLOCK queries are sent to the tasks, which score every item against all of them. With
    more, items look for their nearest query as `search` does; item ids must then be unique.
    """
    item_type, query_type = (df.schema[c].dataType for df, c in ((items, item_id), (queries, query_id)))
    narrow, asked = _narrow(items, item_id, item_vector, "item_id"), _narrow(queries, query_id, query_vector, "query_id")
    some = asked.orderBy("query_id").limit(QUERY_BLOCK + 1).collect()
    if len(some) > QUERY_BLOCK:
        found, _ = search(asked.withColumnRenamed("query_id", "item_id"), narrow.withColumnRenamed("item_id", "query_id"), 1)
        return _ranked(found, "query_id", 1).select(F.col("query_id").alias("item_id"), F.col("item_id").alias("query_id"), "score")
    if not some:
        return narrow.join(asked.select("query_id"), F.lit(False)).select("item_id", "query_id", F.lit(0.0).alias("score"))
    matrix = _unit(np.array([row[1] for row in some], dtype=np.float64))
    schema = f"item_id {item_type.simpleString()}, query_id {query_type.simpleString()}, score double"
    return narrow.mapInArrow(_assigner([row[0] for row in some], matrix, to_arrow_type(query_type)), schema)


def _assigner(names: list, matrix: np.ndarray, name_type: pa.DataType):
    width = matrix.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.round(_unit(_matrix(batch.column(1), width)) @ matrix.T, SCORE_PLACES)
            best = scores.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([names[i] for i in best], type=name_type),
                    pa.array(scores[np.arange(len(best)), best]),
                ],
                names=["item_id", "query_id", "score"],
            )

    return assign


# Groups held in a task before their partial sums are passed on.
PARTIAL_GROUPS = 4096


def mean_vectors(df: DataFrame, by: str, vector: str, name: str = "vector") -> DataFrame:
    """The mean vector of each group; vectors of a group must have the same length.

    Each task adds up its vectors per group first, so a hot group sends a few partial sums only.
    """
    kind = df.schema[by].dataType
    schema = f"g {kind.simpleString()}, n bigint, v array<double>"
    key_type = to_arrow_type(kind)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict = {}

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(list(sums), key_type), pa.array([n for n, _ in sums.values()], pa.int64()),
                 pa.array([v.tolist() for _, v in sums.values()], pa.list_(pa.float64()))],
                names=["g", "n", "v"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            width = len(batch.column(1)[0])
            rows = _matrix(batch.column(1), width)
            keys = batch.column(0).to_pylist()
            order: dict = {}
            codes = np.array([order.setdefault(k, len(order)) for k in keys])
            by_code = np.argsort(codes, kind="stable")
            starts = np.searchsorted(codes[by_code], np.arange(len(order)))
            totals, sizes = np.add.reduceat(rows[by_code], starts), np.bincount(codes)
            for key, code in order.items():
                n, total = sums.get(key, (0, 0.0))
                sums[key] = (n + int(sizes[code]), total + totals[code])
            if len(sums) > PARTIAL_GROUPS:
                yield out()
                sums.clear()
        if sums:
            yield out()

    narrow = df.select(by, F.col(vector).cast("array<double>").alias("v")).where("v is not null")
    long = narrow.mapInArrow(partial, schema).select("g", "n", F.posexplode("v").alias("pos", "x"))
    means = long.groupBy("g", "pos").agg((F.sum("x") / F.sum("n")).alias("x"))
    ordered = F.sort_array(F.collect_list(F.struct("pos", "x")))  # one entry per position
    return means.groupBy(F.col("g").alias(by)).agg(F.transform(ordered, lambda s: s["x"]).alias(name))
