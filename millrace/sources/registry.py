"""Named tables."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from .readers import read_table


class Tables(Mapping):
    """Tables of one folder, read when first asked for: `tables["orders"]`."""

    def __init__(self, spark: SparkSession, location: str, names: Sequence[str], source: str = "parquet"):
        self.spark, self.location, self.source = spark, location, source
        self._names = list(names)
        self._read: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._read:
            self._read[name] = read_table(self.spark, name, self.source, self.location)
        return self._read[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def register(self, prefix: str = "") -> list[str]:
        """Temporary views for SQL users."""
        for name in self:
            self[name].createOrReplaceTempView(prefix + name)
        return [prefix + n for n in self]
