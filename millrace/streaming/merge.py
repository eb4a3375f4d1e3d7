"""Streaming merge of changes into a history or into a last-version table.

Every batch writes a folder named after its batch id and reads the folder of the batch before, so
a batch that is run again after a failure gives the same result. Rows of a history that are closed
are written once, in the batch that closed them; only open rows are carried on.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import row_hash
from ..operators.history import snapshot, upsert
from ..operators.shape import last_per_key
from .ingest import finish

Merge = Callable[[DataFrame | None, DataFrame, int], DataFrame]


def history_merge(keys: Sequence[str], check: Sequence[str], run_time: Callable[[int], str]) -> Merge:
    """Keep every version. A batch holds changed rows only, so absent keys stay open."""

    def merge(old: DataFrame | None, changes: DataFrame, batch: int) -> DataFrame:
        rows = snapshot(old, changes, keys, run_time(batch), check, close_deleted=False)
        return rows.withColumn("open", F.col("valid_to").isNull().cast("int"))

    return merge


def upsert_merge(keys: Sequence[str], hashed: Sequence[str], run_time: Callable[[int], str]) -> Merge:
    """Keep the last version."""

    def merge(old: DataFrame | None, changes: DataFrame, batch: int) -> DataFrame:
        fresh = changes.withColumn("row_hash", row_hash(hashed))
        if old is None:
            at = F.lit(run_time(batch)).cast("timestamp_ntz")
            merged = fresh.withColumns({"created_at": at, "updated_at": at})
        else:
            merged = upsert(old, fresh, keys, "row_hash", run_time(batch), keep_absent=True)
        return merged.withColumn("open", F.lit(1))

    return merge


def _folder(target: str, batch: int) -> str:
    return f"{target}/batch={batch:09d}"


def last_batch(spark: SparkSession, target: str) -> int | None:
    """The newest batch folder of a target that was written completely."""
    jvm = spark.sparkContext._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(f"{target}/batch=*/_SUCCESS")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern)
    batches = [int(s.getPath().getParent().getName().split("=")[1]) for s in found or []]
    return max(batches, default=None)


def read_open(spark: SparkSession, target: str, batch: int) -> DataFrame:
    return spark.read.parquet(_folder(target, batch)).where("open = 1").drop("open")


def read_merged(spark: SparkSession, target: str) -> DataFrame:
    """Open rows of the last batch and the closed rows of all batches."""
    last = last_batch(spark, target)
    rows = spark.read.parquet(target)
    return rows.where((F.col("batch") == last) | (F.col("open") == 0)).drop("batch", "open")


def merge_stream(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], merge: Merge,
    wait: float | None = None,
) -> DataFrame:
    """Merge every available batch into `target`; returns the merged table.

    Within a batch the last row of each key, in the given order, counts.
    """
    spark = stream.sparkSession

    def apply(changes: DataFrame, batch: int) -> None:
        old = read_open(spark, target, batch - 1) if batch else None
        merged = merge(old, last_per_key(changes, keys, order), batch)
        merged.write.mode("overwrite").partitionBy("open").parquet(_folder(target, batch))

    query = (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    finish(query, wait)
    return read_merged(spark, target)
