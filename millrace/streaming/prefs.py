"""Online preference learning: the values are a keyed table that each batch appends to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prefs import ALPHA, GAMMA, learn_values
from . import store
from .ingest import finish


def prefs_stream(
    feedback: DataFrame, n_items: int, order: Sequence[str], target: str, checkpoint: str,
    alpha: float = ALPHA, gamma: float = GAMMA, every: int = 8, wait: float | None = None,
) -> DataFrame:
    """Fold feedback (user_id, item_id, reward, *order) as it arrives; returns user_id, item_id, q.

    Batches must come in order; inside a batch Spark sorts each user's rows, spilling where it must,
    and streams them through the fold. The values, one row per user and item, are a merge-on-read store
    at `target`: a batch reads those of the users it names and appends the values it changed; after
    each `every` batches the store is compacted. A batch that was written completely is not learned
    again when it is repeated. Rows without a user count as one user, rows without an item as one item.
    """
    spark = feedback.sparkSession
    table = store.Store(target, ("user_id", "item_id"), ("q",), history=False)

    def values() -> DataFrame:
        return store.read(spark, table).select("user_id", "item_id", "q")

    def apply(rows: DataFrame, batch: int) -> None:
        written = store.batches(spark, table)
        if batch not in written:
            known = None
            if written:
                users = rows.select(F.col("user_id").alias("_user")).distinct()
                known = values().join(users, F.col("user_id").eqNullSafe(F.col("_user")), "left_semi")
            store.write_batch(table, learn_values(rows, n_items, order, alpha, gamma, known), batch, "1970-01-01")
        if batch % every == every - 1:
            store.compact(spark, table)

    query = (
        feedback.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    finish(query, wait)
    return values()
