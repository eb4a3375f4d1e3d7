"""Writing tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import Suite
from ..sources.readers import EmptyTable
from .commits import commit, committed, content

# Tables with these prefixes belong to the warehouse layer.
WAREHOUSE_PREFIXES = ("dim_", "fct_", "bridge_")


class CheckFailed(RuntimeError):
    """The checks of a load did not pass; nothing was published."""


def write_table(
    df: DataFrame, location: str, name: str, mode: str = "overwrite", source: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """One table to a folder, a catalog database (`source="catalog"`) or a database.

    A failed overwrite raises, so nothing is ever appended to old rows. A jdbc overwrite keeps the
    table definition (truncate).
    """
    if source == "catalog":
        df.write.mode(mode).saveAsTable(f"{location}.{name}" if location else name)
        return
    writer = df.write.mode(mode).format(source).options(**(options or {}))
    if source == "jdbc":
        writer.option("dbtable", f"{location}.{name}" if location else name).option("truncate", "true").save()
    else:
        writer.save(f"{location}/{name}")


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """A catalog table bucketed and sorted by its join keys.

    Tables with the same buckets are joined on these keys without a shuffle. Rows are spread by the
    keys first, so that each bucket is one file.
    """
    spread = df.repartition(buckets, *keys)
    spread.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def copy_tables(tables: Mapping[str, DataFrame], location: str, **where) -> list[str]:
    """Full extraction: every table as it is to the staging layer."""
    return stage_tables(tables, location, **where)


def stage_tables(
    tables: Mapping[str, DataFrame], location: str, mode: str = "overwrite", at_once: int = 4, **where
) -> list[str]:
    """All tables to the staging layer; an empty table is an error.

    Rows are counted as they are written. A few tables are written at a time, so that small ones do
    not leave the cluster idle.
    """

    def stage(name: str) -> None:
        seen = Observation()
        write_table(tables[name].observe(seen, F.count(F.lit(1)).alias("rows")), location, name, mode, **where)
        if not seen.get["rows"]:
            raise EmptyTable(f"{name} holds no rows")

    with ThreadPoolExecutor(at_once) as pool:
        return [name for name, _ in zip(tables, pool.map(stage, tables))]


def warehouse_name(name: str, facts: frozenset[str] = frozenset()) -> str:
    """The table name in the warehouse: fct_ for facts, dim_ for the rest."""
    if name.startswith(WAREHOUSE_PREFIXES):
        return name
    return ("fct_" if name in facts else "dim_") + name


def load_warehouse(
    tables: Mapping[str, DataFrame], location: str, facts: frozenset[str] = frozenset(),
    checks: Callable[[Mapping[str, DataFrame]], Suite] | None = None,
) -> list[str]:
    """Replace the warehouse tables, all or none.

    The tables are written below a new version of the folder, `checks` (a suite made from the
    written tables, by their warehouse names) run on them, and only then the version is committed
    under the number after the one that was newest at the start. Readers (`published_table`) see
    the old tables until then, and go on seeing them if a table or a check fails. Of two loads that
    start from the same version the second raises `Conflict` and publishes nothing.
    """
    names = {warehouse_name(n, facts): df for n, df in tables.items()}
    spark = next(iter(names.values())).sparkSession
    number = max(committed(spark, f"{location}/published"), default=0) + 1
    version = uuid.uuid4().hex
    home = f"{location}/versions/{version}"
    for name, df in names.items():
        write_table(df, home, name, "errorifexists")
    if checks is not None and not checks({n: spark.read.parquet(f"{home}/{n}") for n in names}).passed():
        raise CheckFailed("the checks of the written tables did not pass; nothing was published")
    commit(spark, f"{location}/published", number, version)
    return list(names)


def published_table(spark: SparkSession, location: str, name: str, number: int | None = None) -> DataFrame:
    """A table of the version published last, or of an earlier number that was kept.

    A reader that takes several tables passes one number for all of them, so that they belong together.
    """
    numbers = committed(spark, f"{location}/published")
    if not numbers:
        raise ValueError(f"nothing is published in {location}")
    version = content(spark, f"{location}/published", numbers[-1] if number is None else number)
    return spark.read.parquet(f"{location}/versions/{version}/{name}")


def drop_old_versions(spark: SparkSession, location: str, keep: int = 2, unpublished_hours: float = 24.0) -> list[str]:
    """Delete the tables of versions that no reader needs; the names of the versions deleted.

    The last `keep` published versions stay. A version that was never published may belong to a load
    that still runs, so it goes only when nothing was added to it for `unpublished_hours`. The numbers
    stay taken.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    numbers = committed(spark, f"{location}/published")
    known = {content(spark, f"{location}/published", n): n for n in numbers}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{location}/versions")
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    oldest = (time.time() - unpublished_hours * 3600) * 1000
    dropped = []
    for status in system.listStatus(path) if system.exists(path) else []:
        name = status.getPath().getName()
        if name in known:
            idle = known[name] not in numbers[-keep:]
        else:
            written = [s.getModificationTime() for s in system.listStatus(status.getPath())]
            idle = max([status.getModificationTime(), *written]) < oldest
        if idle and system.delete(status.getPath(), True):
            dropped.append(name)
    return sorted(dropped)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with header, one per partition."""
    df.write.mode("overwrite").csv(path, header=True)
