"""Incremental ingest of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def file_stream(
    spark: SparkSession, path: str, schema: StructType, source: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.format(source).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def ingest_available(
    spark: SparkSession, path: str, schema: StructType, sink: str, checkpoint: str,
    source: str = "parquet", files_per_batch: int | None = None, wait: float | None = None,
) -> None:
    """Append every file not seen before to the sink, then stop. Exactly once per file."""
    query = (
        file_stream(spark, path, schema, source, files_per_batch)
        .writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    finish(query, wait)


def finish(query, wait: float | None = None) -> None:
    """Wait for an available-now query; with a limit, stop it when the time is over."""
    if wait is None:
        query.awaitTermination()
    elif not query.awaitTermination(wait):
        query.stop()
        raise TimeoutError("the stream did not finish in time")
