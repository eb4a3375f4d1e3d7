"""Exact order statistics without sorting the table.

Spark's own exact `percentile` brings every distinct value into one task. Here each pass counts
the rows in a fixed number of slices around the wanted ranks; the next pass looks only inside the
slices that hold them. A pass is one scan with a small aggregate for all columns together, and a
value that repeats in a third of the rows ends the search at once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from math import ceil, inf, isfinite
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SLICES = 2048
# Slices per power of two in the first pass of `group_quantiles`; the smallest number is 2 ** -1074.
COARSE = 32
LEAST_POWER = -1074


@dataclass(frozen=True)
class Slice:
    """A range of values of one column, with the number of rows below it."""

    column: int
    low: float
    high: float
    below: int

    @property
    def width(self) -> float:
        return (self.high - self.low) / SLICES


def exact_quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> dict[str, list[float]]:
    """{column: probabilities} to {column: values}: the value at rank ceil(p * n), at least 1.

    Nulls and NaN are left out; infinities are values like others. Several passes read `df`; cut the lineage of an expensive one first.
    """
    names = list(wanted)
    pairs = [F.struct(F.lit(i).alias("c"), F.col(n).cast("double").alias("v")) for i, n in enumerate(names)]
    values = df.select(F.inline(F.array(*pairs))).where("v is not null and not isnan(v)")
    endless = {"minus": F.col("v") == float("-inf"), "plus": F.col("v") == float("inf")}
    finite = F.when(F.abs("v") < float("inf"), F.col("v"))
    ranges = values.groupBy("c").agg(
        F.count("v").alias("n"), F.min(finite).alias("lo"), F.max(finite).alias("hi"),
        *[F.count_if(c).alias(k) for k, c in endless.items()],
    ).collect()
    ranks = {r.c: [max(1, ceil(round(p * r.n, 6))) for p in wanted[names[r.c]]] for r in ranges}
    found: dict[tuple[int, int], float] = {}
    todo = {}
    for r in ranges:
        found.update({(r.c, k): -inf for k in ranks[r.c] if k <= r.minus})
        found.update({(r.c, k): inf for k in ranks[r.c] if k > r.n - r.plus})
        left = sorted({k for k in ranks[r.c] if r.minus < k <= r.n - r.plus})
        if left:
            todo[Slice(r.c, r.lo, r.hi, r.minus)] = left
    while todo:
        for s in [s for s in todo if s.low == s.high]:
            found.update({(s.column, r): s.low for r in todo.pop(s)})
        todo = _narrow(values, todo) if todo else {}
    return {names[c]: [found[c, r] for r in rs] for c, rs in ranks.items()}


def _narrow(values: DataFrame, todo: Mapping[Slice, list[int]]) -> dict[Slice, list[int]]:
    """One pass: cut every open slice into pieces and keep those that hold a wanted rank."""
    slices = list(todo)
    number, piece = F.lit(None).cast("int"), F.lit(None).cast("int")
    for i, s in enumerate(slices):
        inside = (F.col("c") == s.column) & F.col("v").between(s.low, s.high)
        if isfinite(s.high - s.low) and s.width > 0:
            step = F.floor((F.col("v") - F.lit(s.low)) / F.lit(s.width))
        elif s.width > 0:  # the range itself is beyond the largest number
            step = F.floor((F.col("v") / 4 - F.lit(s.low / 4)) / F.lit(s.high / 4 - s.low / 4) * SLICES)
        else:  # neighbours among the smallest numbers
            step = F.floor((F.col("v") - F.lit(s.low)) / F.lit(s.high - s.low))
        step = F.least(step, F.lit(SLICES - 1))
        number = F.when(inside, i).otherwise(number)
        piece = F.when(inside, step.cast("int")).otherwise(piece)
    counts = (
        values.select("v", number.alias("s"), piece.alias("p"))
        .where("s is not null")
        .groupBy("s", "p")
        .agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .collect()  # at most SLICES rows per wanted rank
    )
    kept: dict[Slice, list[int]] = {}
    for i, s in enumerate(slices):
        below = s.below
        for row in sorted((r for r in counts if r.s == i), key=lambda r: r.p):
            inside = [r for r in todo[s] if below < r <= below + row.n]
            if inside:
                kept[Slice(s.column, row.lo, row.hi, below)] = inside
            below += row.n
    return kept


def describe(df: DataFrame, column: str, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, sample deviation, smallest, exact quantiles and largest value of a column."""
    cuts = exact_quantiles(df, {column: probabilities}).get(column, [None] * len(probabilities))
    value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))  # NaN is no value
    return df.agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("sd"),
        F.min(value).alias("low"),
        *[F.lit(v).cast("double").alias(f"q{round(p * 100)}") for p, v in zip(probabilities, cuts)],
        F.max(value).alias("high"),
    )


def _same(keys: Sequence[str], others: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, others)], F.lit(True))


def _holding(pieces: DataFrame, keys: Sequence[str], ranks: Column, below: Column | int) -> DataFrame:
    """The pieces (keys, _piece, _n, _lo, _hi) that hold a wanted rank, with these ranks and the rows below."""
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0))
    counted = pieces.withColumn("_upto", below + upto)
    inside = F.filter(ranks, lambda r: (r["rank"] > F.col("_upto") - F.col("_n")) & (r["rank"] <= F.col("_upto")))
    return counted.withColumn("_ranks", inside).where(F.size("_ranks") > 0).withColumn("_below", F.col("_upto") - F.col("_n"))


def group_quantiles(df: DataFrame, by: Sequence[str], column: str, probabilities: Sequence[float]) -> DataFrame:
    """by..., p, value: in each group the value at rank ceil(p * n), at least 1.

    All groups are narrowed together, and their ranges are a table. The first pass counts each group's
    rows per slice of a logarithmic scale that all groups share; each later one joins the rows to the
    slices that hold a wanted rank and cuts these into SLICES pieces. So a task holds at most one count
    per slice of a group, never its rows. From the third pass on only the rows inside open
    slices are read. Nulls and NaN are left out, infinities are values like others, a null in `by` is a
    group like others, and a group without values has no row.
    """
    keys = [f"_k{i}" for i in range(len(by))]
    held = [f"_o{i}" for i in range(len(by))]
    v = F.col("_v")
    values = df.select(*[F.col(c).alias(k) for c, k in zip(by, keys)], F.col(column).cast("double").alias("_v"))
    values = values.where(v.isNotNull() & ~F.isnan(v))
    far = F.when(v > 0, 1 << 30).otherwise(-(1 << 30))
    size = F.when(v == 0, 0.0).otherwise(F.log2(F.abs(v)) - LEAST_POWER + 1)
    place = F.when(F.abs(v) < inf, F.floor(F.signum(v) * size * COARSE).cast("int")).otherwise(far)
    measures = [F.count("_v").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    pieces = values.groupBy(*keys, place.alias("_piece")).agg(*measures)
    total = F.sum("_n").over(Window.partitionBy(*keys))
    ranks = F.array(*[
        F.struct(F.lit(float(p)).alias("p"), F.greatest(F.lit(1), F.ceil(F.round(F.lit(float(p)) * F.col("_total"), 6))).alias("rank"))
        for p in probabilities
    ])
    state = cut_lineage(_holding(pieces.withColumn("_total", total), keys, ranks, 0).select(*keys, "_lo", "_hi", "_below", "_ranks"))
    found, narrowed = [], 0
    while True:
        done = F.col("_lo") == F.col("_hi")
        found.append(state.where(done).select(*keys, F.inline("_ranks"), F.col("_lo").alias("value")))
        left = state.where(~done)
        if left.isEmpty():
            break
        left = left.select(*[F.col(k).alias(o) for k, o in zip(keys, held)], F.col("_lo").alias("_from"), F.col("_hi").alias("_to"), "_below", "_ranks")
        inside = values.join(left.drop("_below", "_ranks"), _same(keys, held) & v.between(F.col("_from"), F.col("_to"))).drop(*held)
        if narrowed:
            inside = cut_lineage(inside)
            values = inside.select(*keys, "_v")
        span = F.col("_to") - F.col("_from")
        share = F.when(span < inf, (v - F.col("_from")) / span).otherwise((v / 4 - F.col("_from") / 4) / (F.col("_to") / 4 - F.col("_from") / 4))
        piece = F.least(F.floor(share * SLICES), F.lit(SLICES - 1)).cast("int")
        pieces = inside.groupBy(*keys, F.col("_from").alias("_in"), piece.alias("_piece")).agg(*measures)
        pieces = pieces.join(left.withColumnRenamed("_ranks", "_wanted"), _same([*keys, "_in"], [*held, "_from"])).drop(*held, "_from", "_to")
        pieces = pieces.withColumnRenamed("_below", "_start")
        state = _holding(pieces, [*keys, "_in"], F.col("_wanted"), F.col("_start"))
        state = cut_lineage(state.select(*keys, "_lo", "_hi", "_below", "_ranks"))
        narrowed += 1
    out = reduce(DataFrame.unionByName, found)
    return out.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "p", "value")


def describe_by(df: DataFrame, by: Sequence[str], column: str, probabilities: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """`describe` for each group: by..., n, mean, sd, low, one column per probability, high."""
    value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    names = {float(p): f"q{round(p * 100)}" for p in probabilities}
    held = [f"_o{i}" for i in range(len(by))]
    cuts = group_quantiles(df, by, column, probabilities).groupBy(*[F.col(c).alias(o) for c, o in zip(by, held)]).agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(n) for p, n in names.items()])
    base = df.groupBy(*by).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"),
        F.min(value).alias("low"), F.max(value).alias("high"),
    )
    return base.join(cuts, _same(list(by), held), "left").select(*by, "n", "mean", "sd", "low", *names.values(), "high")
