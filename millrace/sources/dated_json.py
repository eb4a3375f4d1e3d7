"""A data source for services that return JSON records for a range of dates.

Each slice of dates is one partition, fetched on an executor. Options:

url       address with {start} and {end} in it (http, https or file)
start     first date, inclusive
end       last date, inclusive
days      dates per slice (default 1)
timeout   seconds per request (default 60)
missing   "skip" treats an address that does not exist as an empty reply
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date, timedelta
from urllib.error import HTTPError, URLError
from urllib.request import urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


class DateSlice(InputPartition):
    def __init__(self, start: str, end: str):
        super().__init__((start, end))
        self.start, self.end = start, end


class DatedJson(DataSource):
    @classmethod
    def name(cls) -> str:
        return "dated_json"

    def reader(self, schema: StructType) -> DataSourceReader:
        return DatedJsonReader(schema, self.options)


class DatedJsonReader(DataSourceReader):
    def __init__(self, schema: StructType, options):
        self.names = schema.names
        self.url = options["url"]
        self.start, self.end = date.fromisoformat(options["start"]), date.fromisoformat(options["end"])
        self.days = int(options.get("days", 1))
        self.timeout = float(options.get("timeout", 60))
        self.skip_missing = options.get("missing") == "skip"

    def partitions(self) -> list[DateSlice]:
        slices, at = [], self.start
        while at <= self.end:
            last = min(at + timedelta(days=self.days - 1), self.end)
            slices.append(DateSlice(at.isoformat(), last.isoformat()))
            at = last + timedelta(days=1)
        return slices

    def read(self, partition: DateSlice) -> Iterator[tuple]:
        try:
            with urlopen(self.url.format(start=partition.start, end=partition.end), timeout=self.timeout) as reply:
                records = json.load(reply)
        except (HTTPError, URLError) as error:
            gone = isinstance(error, HTTPError) and error.code == 404
            if self.skip_missing and (gone or isinstance(getattr(error, "reason", None), FileNotFoundError)):
                return
            raise
        for record in records or []:
            yield tuple(record.get(n) for n in self.names)


def read_dated_json(spark: SparkSession, schema: StructType | str, url: str, start: str, end: str, **options) -> DataFrame:
    """The records of all dates; dates without records add no rows."""
    spark.dataSource.register(DatedJson)
    reader = spark.read.format("dated_json").schema(schema)
    return reader.options(url=url, start=start, end=end, **{k: str(v) for k, v in options.items()}).load()
