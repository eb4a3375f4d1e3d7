"""Streaming quality gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.quality import split_by
from .ingest import finish


def rule_failures(rules: dict[str, Column]) -> Column:
    """Names of the rules a row breaks; a rule that is null counts as broken."""
    marks = [F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in rules.items()]
    return F.filter(F.array(*marks), lambda m: m.isNotNull())


def gate_stream(
    stream: DataFrame, failures: Column, good: str, bad: str, checkpoint: str, wait: float | None = None
) -> None:
    """Good rows to one folder, bad rows with the broken rules to another.

    Each batch overwrites its own folders, so a repeated batch adds nothing twice.
    """

    def split(rows: DataFrame, batch: int) -> None:
        fine, broken = split_by(rows, failures)
        fine.write.mode("overwrite").parquet(f"{good}/batch={batch:09d}")
        broken.write.mode("overwrite").parquet(f"{bad}/batch={batch:09d}")

    query = (
        stream.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    finish(query, wait)
