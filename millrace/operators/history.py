"""Dimension history: snapshots that keep every version, and upserts that keep the last one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HISTORY_COLUMNS = ("valid_from", "valid_to", "updated_at", "scd_id")


def _at(run_time: str) -> Column:
    return F.lit(run_time).cast("timestamp_ntz")


def _scd_id(keys: Sequence[Column], run_time: str) -> Column:
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(run_time)))


def start_history(new: DataFrame, keys: Sequence[str], run_time: str) -> DataFrame:
    """The first snapshot: every row is current."""
    return new.withColumns(
        {
            "valid_from": _at(run_time),
            "valid_to": F.lit(None).cast("timestamp_ntz"),
            "updated_at": _at(run_time),
            "scd_id": _scd_id([F.col(k) for k in keys], run_time),
        }
    )


def snapshot(
    history: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    run_time: str,
    check: Sequence[str] | None = None,
    close_deleted: bool = True,
) -> DataFrame:
    """The history after one more run.

    A key whose checked columns (all of them by default) changed gets its current row closed and
    a new row; a new or reappearing key gets a row; a key that is gone is closed if
    `close_deleted`. One join of the current rows with the new table decides all cases; rows
    closed earlier pass by untouched.
    """
    if history is None:
        return start_history(new, keys, run_time)
    attributes = [c for c in history.columns if c not in HISTORY_COLUMNS]
    check = list(check or [c for c in attributes if c not in keys])
    closed = history.where(F.col("valid_to").isNotNull())
    old = current_rows(history).select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], F.struct(*history.columns).alias("old")
    )
    fresh = new.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.struct(*attributes).alias("new"))
    same_key = None
    for k in keys:
        part = F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}"))
        same_key = part if same_key is None else same_key & part
    joined = old.join(fresh, same_key, "full_outer")

    is_old, is_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    differs = F.lit(False)
    for c in check:
        differs = differs | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    changed = is_old & is_new & differs
    ends = changed | (is_old & ~is_new & F.lit(close_deleted))
    at = _at(run_time)
    kept = F.struct(
        *[F.col(f"old.{c}").alias(c) for c in attributes],
        F.col("old.valid_from").alias("valid_from"),
        F.when(ends, at).alias("valid_to"),
        F.when(ends, at).otherwise(F.col("old.updated_at")).alias("updated_at"),
        F.col("old.scd_id").alias("scd_id"),
    )
    added = F.struct(
        *[F.col(f"new.{c}").alias(c) for c in attributes],
        at.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        at.alias("updated_at"),
        _scd_id([F.col(f"new.{k}") for k in keys], run_time).alias("scd_id"),
    )
    versions = F.array_compact(F.array(F.when(is_old, kept), F.when(changed | (is_new & ~is_old), added)))
    merged = joined.select(F.inline(versions))
    return closed.select(*merged.columns).unionByName(merged)


def current_rows(history: DataFrame) -> DataFrame:
    """The version of each key that is valid now; join facts to this, not to the history."""
    return history.where(F.col("valid_to").isNull())


def rows_as_of(history: DataFrame, moment: str) -> DataFrame:
    """The versions that were valid at a moment."""
    at = _at(moment)
    return history.where((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (F.col("valid_to") > at)))


def upsert(
    old: DataFrame, new: DataFrame, keys: Sequence[str], hash_column: str, run_time: str, keep_absent: bool = False
) -> DataFrame:
    """Keep the last version per key.

    `new` carries a row hash. created_at stays with the key; updated_at moves only where the
    hash differs; keys of `old` that `new` lacks are dropped unless `keep_absent`.
    """
    side = old.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.col(hash_column).alias("_hash"), F.col("created_at").alias("_created"), F.col("updated_at").alias("_updated"),
    )
    same_key = None
    for k in keys:
        part = F.col(k) == F.col(f"_o_{k}")
        same_key = part if same_key is None else same_key & part
    at = _at(run_time)
    same = F.col(f"_o_{keys[0]}").isNotNull() & F.col(hash_column).eqNullSafe(F.col("_hash"))
    merged = new.join(side, same_key, "left").select(
        *[F.col(c) for c in new.columns],
        F.coalesce("_created", at).alias("created_at"),
        F.when(same, F.col("_updated")).otherwise(at).alias("updated_at"),
    )
    if keep_absent:
        absent = old.join(new.select(*keys), list(keys), "left_anti")
        merged = merged.unionByName(absent.select(*merged.columns))
    return merged
