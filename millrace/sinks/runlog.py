"""The run log: one row per step and table."""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = (
    "step string, process string, status string, source string, table_name string, "
    "etl_date timestamp_ntz, execution_time double, error_msg string"
)


class RunLog:
    """Collects the entries of one run and appends them in one write."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.rows = spark, path, []

    def run(self, step: str, process: str, source: str, table: str, work: Callable[[], object]) -> object:
        """Do the work and note success or failure; a failure is raised again."""
        begun, clock = datetime.now(), time.monotonic()
        try:
            result = work()
        except Exception:
            self.rows.append((step, process, "fail", source, table, begun, time.monotonic() - clock, traceback.format_exc()))
            self.flush()
            raise
        self.rows.append((step, process, "success", source, table, begun, time.monotonic() - clock, None))
        return result

    def flush(self) -> None:
        if self.rows:
            self.spark.createDataFrame(self.rows, LOG_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            self.rows = []

    def __enter__(self) -> "RunLog":
        return self

    def __exit__(self, *_) -> None:
        self.flush()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(path)


def summary(log: DataFrame) -> DataFrame:
    """Entries and seconds per step and status."""
    return log.groupBy("step", "status").agg(
        F.count(F.lit(1)).alias("entries"), F.sum("execution_time").alias("execution_time"),
        F.max("etl_date").alias("etl_date"),
    )
