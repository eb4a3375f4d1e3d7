"""As-of joins: facts meet the version that was valid at their time."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Time slices into which the rows of a key are cut.
SLICES = 64
ACCURACY = 1000


def _cuts(times: DataFrame, slices: int) -> list:
    """Moments that cut all times into slices of about the same number of rows."""
    if slices < 2:
        return []
    shares = [k / slices for k in range(1, slices)]
    found = times.agg(F.percentile_approx("_time", shares, ACCURACY)).first()[0]
    return sorted(set(found or []))


def as_of_join(
    facts: DataFrame, versions: DataFrame, keys: Sequence[str], fact_time: str, version_time: str, columns: Sequence[str],
    valid_to: str | None = None, before: bool = False, slices: int = SLICES,
) -> DataFrame:
    """All facts, with `columns` of the last version of their key that starts no later than the fact.

    `before` asks for a version that starts earlier than the fact; `valid_to` names a column of the versions from
    which on they hold no more (null: still valid). Facts without such a version, and facts whose
    key or time is null, get nulls. Of versions of a key that start at the same time the greatest by
    `columns` counts. `columns` must not be names of facts; both times have the same type.

    Facts are first reduced to their distinct (key, time), so no wide row is sorted. These are sorted
    together with the versions, within slices of time, and every row takes the last version
    before it. A slice hands its last version on to the later ones of the key, over at most `slices` rows
    per key, so that a key of any size is spread over many tasks. No interval is taken apart and
    no pair of a fact and a version is made that is not in the result.
    """
    extra = [c for c in [valid_to] if c and c not in columns]
    held = F.struct(F.col(version_time).alias("_from"), *[F.col(c) for c in [*columns, *extra]])
    sound = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    points = facts.where(sound & F.col(fact_time).isNotNull()).select(*keys, F.col(fact_time).alias("_time")).distinct()
    starts = versions.where(sound & F.col(version_time).isNotNull()).select(*keys, F.col(version_time).alias("_time"), held.alias("_version"))
    rows = points.withColumn("_version", F.lit(None).cast(starts.schema["_version"].dataType)).unionByName(starts)
    cuts = [F.lit(c).cast(starts.schema["_time"].dataType) for c in _cuts(rows.select("_time"), slices)]
    slice_of = F.size(F.filter(F.array(*cuts), lambda c: c <= F.col("_time"))) if cuts else F.lit(0)
    rows = rows.withColumns({"_slice": slice_of, "_is_fact": F.col("_version").isNull()})

    # At the same moment versions come first, or facts do.
    turn = F.desc("_is_fact") if before else F.asc("_is_fact")
    within = Window.partitionBy(*keys, "_slice").orderBy("_time", turn, "_version").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = rows.withColumn("_found", F.last("_version", ignorenulls=True).over(within)).where("_is_fact")
    lasts = rows.where("NOT _is_fact").groupBy(*keys, "_slice").agg(F.max("_version").alias("_last"))
    # Slices of a key with facts but no version take what is handed on, too.
    stops = lasts.unionByName(seen.select(*keys, "_slice").distinct(), allowMissingColumns=True).groupBy(*keys, "_slice").agg(F.max("_last").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    handed = stops.withColumn("_handed", F.last("_last", ignorenulls=True).over(earlier)).drop("_last")

    found = seen.join(handed, [*keys, "_slice"], "left").select(*keys, "_time", F.coalesce("_found", "_handed").alias("_found"))
    if valid_to:
        ended = F.col(f"_found.{valid_to}") <= F.col("_time")
        found = found.withColumn("_found", F.when(~F.coalesce(ended, F.lit(False)), F.col("_found")))
    right = found.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_time", *[F.col(f"_found.{c}").alias(c) for c in columns])
    same = [facts[k] == right[f"_k{i}"] for i, k in enumerate(keys)] + [facts[fact_time] == right["_time"]]
    return facts.join(right, same, "left").select(*[facts[c] for c in facts.columns], *columns)
