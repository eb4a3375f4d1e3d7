"""Preference learning from feedback."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import seeded_number, seeded_uniform

# Learning rate, discount, exploration rate and the two rewards.
ALPHA = 0.1
GAMMA = 0.9
EPSILON = 0.1
REWARD_YES = 1
REWARD_NO = -4


class Values:
    """The learned values of one user. Items never acted on count as zero."""

    __slots__ = ("q", "n_items", "alpha", "gamma", "_top")

    def __init__(self, n_items: int, alpha: float, gamma: float, q: dict | None = None):
        self.q = q or {}
        self.n_items, self.alpha, self.gamma = n_items, alpha, gamma
        self._top = None

    def top(self) -> float:
        if self._top is None:
            known = max(self.q.values()) if self.q else 0.0
            self._top = max(known, 0.0) if len(self.q) < self.n_items else known
        return self._top

    def learn(self, item, reward: float) -> None:
        before, top = self.q.get(item, 0.0), self.top()
        after = before + self.alpha * (reward + self.gamma * top - before)
        self.q[item] = after
        # The largest value has to be searched again only if this item held it and fell,
        # or if this item was the last one that still counted as zero.
        if after >= top:
            self._top = after
        elif before == top or len(self.q) == self.n_items:
            self._top = None


def reward_of(liked: Column) -> Column:
    return F.when(liked, F.lit(float(REWARD_YES))).otherwise(F.lit(float(REWARD_NO)))


def learn_values(
    feedback: DataFrame, n_items: int, order: Sequence[str], alpha: float = ALPHA, gamma: float = GAMMA, known: DataFrame | None = None
) -> DataFrame:
    """user_id, item_id, q after all feedback (columns user_id, item_id, reward, *order).

    Each step depends on the one before it, so a user's rows are folded in order. They are
    streamed through the task batch by batch from Spark's sort, which spills; the memory needed is
    one value per item of one user, however much feedback that user gave. `n_items` is the size
    of the catalogue. With `known` (user_id, item_id, q) learning goes on from these values, and only
    items that the feedback names are returned.
    """
    types = {f.name: f.dataType.simpleString() for f in feedback.schema.fields}
    schema = f"user_id {types['user_id']}, item_id {types['item_id']}, q double"
    rows = feedback.select("user_id", "item_id", F.col("reward").cast("double").alias("reward"), *order, F.lit(True).alias("_new"))
    if known is not None:
        before = known.select("user_id", "item_id", F.col("q").alias("reward"), F.lit(False).alias("_new"))
        rows = rows.unionByName(before, allowMissingColumns=True)
    ordered = rows.repartition("user_id").sortWithinPartitions("user_id", "_new", *order).select("user_id", "item_id", "reward", "_new")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        user, values, named, kinds, started = None, None, {}, None, False

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array([user] * len(named), kinds[0]), pa.array(list(named), kinds[1]), pa.array([values.q[i] for i in named], pa.float64())],
                names=["user_id", "item_id", "q"],
            )

        for batch in batches:
            kinds = (batch.schema.field(0).type, batch.schema.field(1).type)
            for u, item, reward, new in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not started or u != user:
                    if named:
                        yield rows()
                    user, values, named, started = u, Values(n_items, alpha, gamma), {}, True
                if new:
                    values.learn(item, reward)
                    named[item] = True
                else:
                    values.q[item] = reward
        if named:
            yield rows()

    return ordered.mapInArrow(fold, schema)


def nonzero(values: DataFrame) -> DataFrame:
    """The preferences that feedback has moved."""
    return values.where(F.col("q") != 0)


def choose(candidates: DataFrame, by: Sequence[str], seed: int, epsilon: float = EPSILON) -> DataFrame:
    """One item per group: usually the highest q (ties to the smaller id), sometimes any.

    `candidates` holds the `by` columns, item_id and q. The draw is a hash of the group key and
    the seed, so a run can be repeated.
    """
    explore = seeded_uniform(seed, *by) < epsilon
    draw = seeded_number(seed + 1, *by, "item_id")
    marked = candidates.withColumn("explored", explore)
    order = [F.when(F.col("explored"), draw).asc(), F.desc("q"), F.col("item_id")]
    w = Window.partitionBy(*by).orderBy(*order)
    return marked.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def with_values(candidates: DataFrame, values: DataFrame) -> DataFrame:
    """Candidates (user_id, item_id, ...) with the user's value of each, zero if unknown."""
    return candidates.join(values, ["user_id", "item_id"], "left").withColumn("q", F.coalesce("q", F.lit(0.0)))
