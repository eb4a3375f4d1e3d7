"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from ..sources.registry import Tables

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}




class Inputs(Tables):
    """The given tables of one folder, also as attributes: `t.orders`."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark, folder, TABLE_NAMES)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self[name]
        raise AttributeError(name)


def query(name: str, oracle: str | None = None):
    """Register `fn(t: Inputs) -> DataFrame` under a name."""

    def register(fn: Callable[[Inputs], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Inputs(tune(spark), folder))

        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn

    return register
