"""Merge on read: a keyed table that batches append to and readers fold.

A batch writes the last row of each of its keys and nothing else, whatever the size of the table. Keys
are hashed to buckets. A reader folds a bucket's base and the batches since, by key. Compaction writes
the fold of a bucket as its new base once the batches outgrow the old one, and leaves other buckets alone.

    target/batches/batch=<n>/bucket=<b>   changes; complete with _SUCCESS, written again if a batch is repeated
    target/base/gen=<g>/bucket=<b>        folded rows
    target/manifest/gen=<g>               bucket, base (its gen), upto (the last batch in it)

The newest complete manifest decides what is read, so readers never see half a compaction.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.keys import row_hash
from ..operators.history import HISTORY_COLUMNS
from ..operators.shape import last_per_key
from .ingest import finish

BUCKETS = 64
# A bucket is compacted once its batches hold this share of its base's rows.
RATIO = 0.5


@dataclass(frozen=True)
class Store:
    """Where a table is, its keys, and the columns that make a new version.

    With `history` every version is kept (valid_from, valid_to, updated_at, scd_id), else the last
    one (row_hash, created_at, updated_at).
    """

    target: str
    keys: tuple[str, ...]
    check: tuple[str, ...]
    history: bool = True
    buckets: int = BUCKETS


def _complete(spark: SparkSession, folder: str, name: str) -> list[int]:
    """Numbers of the sub-folders `name=<n>` that were written completely, ascending."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}=*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found or [])


def batches(spark: SparkSession, store: Store) -> list[int]:
    """The numbers of the complete batches, ascending."""
    return _complete(spark, f"{store.target}/batches", "batch")


def write_batch(store: Store, changes: DataFrame, batch: int, run_time: str) -> None:
    """Append a batch: at most one row per key."""
    bucket = F.pmod(F.xxhash64(*store.keys), F.lit(store.buckets)).cast("int")
    rows = changes.withColumns({"run": F.lit(run_time), "bucket": bucket})
    rows.write.mode("overwrite").partitionBy("bucket").parquet(f"{store.target}/batches/batch={batch}")


def _manifest(spark: SparkSession, store: Store) -> tuple[int, dict[int, tuple[int, int]]]:
    """The newest generation and, for each bucket that has a base, (its generation, last batch in it)."""
    gens = _complete(spark, f"{store.target}/manifest", "gen")
    if not gens:
        return -1, {}
    rows = spark.read.parquet(f"{store.target}/manifest/gen={gens[-1]}").collect()
    return gens[-1], {r["bucket"]: (r["base"], r["upto"]) for r in rows}


def _any_of(parts: dict[int, list[int]], column: str, compare: Callable[[Column, int], Column]) -> Column:
    """Rows whose bucket is listed under a number that `compare` accepts for `column`. Prunes folders."""
    tests = [F.col("bucket").isin(buckets) & compare(F.col(column), n) for n, buckets in parts.items()]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _sources(spark: SparkSession, store: Store) -> tuple[DataFrame | None, DataFrame]:
    """Base rows that count, and the changes not yet in a base."""
    _, places = _manifest(spark, store)
    written = batches(spark, store)
    if not written:
        raise ValueError(f"no batch was written to {store.target}")
    since = defaultdict(list)
    for bucket in range(store.buckets):
        since[places.get(bucket, (-1, -1))[1]].append(bucket)
    changes = spark.read.option("basePath", f"{store.target}/batches").parquet(*[f"{store.target}/batches/batch={b}" for b in written])
    changes = changes.where(_any_of(since, "batch", lambda c, n: c > n))
    if not places:
        return None, changes
    bases = defaultdict(list)
    for bucket, (base, _) in places.items():
        bases[base].append(bucket)
    read = spark.read.option("basePath", f"{store.target}/base").parquet(*[f"{store.target}/base/gen={g}" for g in bases])
    return read.where(_any_of(bases, "gen", lambda c, n: c == n)).drop("gen"), changes


def _fold_history(store: Store, base: DataFrame | None, changes: DataFrame) -> DataFrame:
    attributes = [c for c in changes.columns if c not in ("batch", "bucket", "run")]
    at = F.col("run").cast("timestamp_ntz")
    scd_id = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in store.keys], F.col("run")))
    columns = [*attributes, "bucket"]
    rows = changes.select(*columns, at.alias("valid_from"), scd_id.alias("scd_id"), F.col("batch").cast("long").alias("_seq"))
    if base is not None:
        rows = rows.unionByName(base.where("valid_to IS NULL").select(*columns, "valid_from", "scd_id", F.lit(-1).cast("long").alias("_seq")))
    by_key = Window.partitionBy("bucket", *store.keys).orderBy("_seq")
    values = F.struct(*store.check)
    # A row that repeats the version before it makes none of its own.
    rows = rows.withColumn("_new", (F.row_number().over(by_key) == 1) | ~values.eqNullSafe(F.lag(values).over(by_key)))
    kept = rows.where("_new").withColumn("valid_to", F.lead("valid_from").over(by_key))
    kept = kept.withColumn("updated_at", F.coalesce("valid_to", "valid_from")).select(*attributes, *HISTORY_COLUMNS, "bucket")
    if base is not None:
        kept = kept.unionByName(base.where("valid_to IS NOT NULL").select(*kept.columns))
    return kept


def _fold_latest(store: Store, base: DataFrame | None, changes: DataFrame) -> DataFrame:
    attributes = [c for c in changes.columns if c not in ("batch", "bucket", "run")]
    at = F.col("run").cast("timestamp_ntz")
    columns = [*attributes, "row_hash", "created_at", "updated_at", "bucket"]
    rows = changes.withColumn("row_hash", row_hash(list(store.check))).withColumns({"created_at": at, "updated_at": at})
    rows = rows.select(*columns, F.col("batch").cast("long").alias("_seq"))
    if base is not None:
        rows = rows.unionByName(base.select(*columns, F.lit(-1).cast("long").alias("_seq")))
    key = Window.partitionBy("bucket", *store.keys)
    by_time = key.orderBy("_seq")
    new = (F.row_number().over(by_time) == 1) | ~F.col("row_hash").eqNullSafe(F.lag("row_hash").over(by_time))
    rows = rows.withColumn("_new", new).withColumns({
        "created_at": F.min("created_at").over(key),
        "updated_at": F.max(F.when(F.col("_new"), F.col("updated_at"))).over(key),
        "_last": F.max("_seq").over(key),
    })
    return rows.where("_seq = _last").select(*columns)


def _folded(spark: SparkSession, store: Store) -> DataFrame:
    base, changes = _sources(spark, store)
    return (_fold_history if store.history else _fold_latest)(store, base, changes)


def read(spark: SparkSession, store: Store) -> DataFrame:
    """The table after all complete batches.

    A key has at most one change per batch, so even a key of very many events brings few rows.
    """
    return _folded(spark, store).drop("bucket")


def compact(spark: SparkSession, store: Store, ratio: float = RATIO) -> list[int]:
    """Give buckets whose changes hold more than `ratio` of their base's rows a new base; those buckets.

    Buckets without a base are compacted with their first change.
    """
    gen, places = _manifest(spark, store)
    last = batches(spark, store)[-1]
    base, changes = _sources(spark, store)
    counts = changes.groupBy("bucket").agg(F.count("*").alias("fresh"))
    if base is not None:
        counts = counts.join(base.groupBy("bucket").agg(F.count("*").alias("held")), "bucket", "left")
        counts = counts.where(F.col("fresh") > ratio * F.coalesce("held", F.lit(0)))
    due = sorted(r["bucket"] for r in counts.select("bucket").collect())
    if not due:
        return []
    _folded(spark, store).where(F.col("bucket").isin(due)).write.mode("overwrite").partitionBy("bucket").parquet(f"{store.target}/base/gen={gen + 1}")
    places = {**places, **{b: (gen + 1, last) for b in due}}
    rows = [(b, g, n) for b, (g, n) in places.items()]
    spark.createDataFrame(rows, "bucket int, base long, upto long").coalesce(1).write.mode("overwrite").parquet(f"{store.target}/manifest/gen={gen + 1}")
    return due


def merge_into(
    stream: DataFrame, store: Store, checkpoint: str, order: Sequence[str], run_time: Callable[[int], str], every: int = 8,
    ratio: float = RATIO, wait: float | None = None,
) -> DataFrame:
    """Append every available batch of `stream` to the store, compacting after each `every` batches; the table.

    Within a batch the last row of each key, in the given order, counts. A repeated batch writes its
    own folder again; a bucket that already holds it reads it no more.
    """
    spark = stream.sparkSession

    def apply(changes: DataFrame, batch: int) -> None:
        write_batch(store, last_per_key(changes, store.keys, order), batch, run_time(batch))
        if batch % every == every - 1:
            compact(spark, store, ratio)

    query = (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    finish(query, wait)
    return read(spark, store)
