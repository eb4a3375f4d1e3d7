"""What the operators of this folder share: registration, row ids, settings, connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Rows of text that go to Python at once; the texts of a batch have to fit in a task's memory.
BATCH_ROWS = 1000


def prepare(spark: SparkSession) -> SparkSession:
    """The settings these operators want."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, oracle: str | None = None):
    """Register `fn(spark, folder) -> DataFrame`."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(prepare(spark), folder)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn

    return register


def unused(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of df has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def remainder(id_column, modulus: int):
    """crc32 of the id as text, modulo. A null id counts as the empty text."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % modulus


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node that links reach from each node that has a link.

    Large-star and small-star steps in turn, until nothing changes. Each step takes the smallest
    neighbour of a node, combined in the map tasks, and joins it back to the node's edges, which
    AQE splits where a node has many. Every step's edges are checkpointed.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    pairs = cut_lineage(pairs)
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        small = cut_lineage(small.where("u <> v").distinct())
        same = ["count(*) AS n", "bit_xor(xxhash64(u, v)) AS x"]
        old, new = pairs.selectExpr(*same).first(), small.selectExpr(*same).first()
        if tuple(old) == tuple(new):
            return small.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                small.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        pairs = small
