"""Reading tables from files, catalogs and databases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro", "text")


class EmptyTable(ValueError):
    """A table that must hold rows is empty."""


def require_rows(df: DataFrame, name: str) -> DataFrame:
    """The table itself, or an error if it is empty. Stops at the first row."""
    if df.isEmpty():
        raise EmptyTable(f"{name} holds no rows")
    return df


def read_table(
    spark: SparkSession, name: str, source: str = "parquet", location: str | None = None,
    options: Mapping[str, str] | None = None, schema: T.StructType | str | None = None,
) -> DataFrame:
    """One table of a file folder, a catalog (`source="catalog"`) or a database (`source="jdbc"`).

    For jdbc the options carry url, driver and credentials; add partitionColumn, lowerBound,
    upperBound and numPartitions (see `jdbc_slices`) so that a large table is not one task.
    """
    if source == "catalog":
        return spark.table(f"{location}.{name}" if location else name)
    reader = spark.read.format(source).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    if source == "jdbc":
        return reader.option("dbtable", name).load()
    if source not in FILE_FORMATS:
        raise ValueError(f"unsupported source type: {source}")
    return reader.load(f"{location}/{name}" if "." in name else f"{location}/{name}.{source}")


def read_tables(spark: SparkSession, names: Sequence[str], allow_empty: bool = False, **where) -> dict[str, DataFrame]:
    """Several tables by name; an empty one is an error unless allowed."""
    tables = {n: read_table(spark, n, **where) for n in names}
    if not allow_empty:
        for name, df in tables.items():
            require_rows(df, name)
    return tables


def jdbc_slices(column: str, low: int, high: int, parts: int, fetch: int = 10_000) -> dict[str, str]:
    """Options for a parallel database read over a numeric or date key."""
    return {
        "partitionColumn": column, "lowerBound": str(low), "upperBound": str(high),
        "numPartitions": str(parts), "fetchsize": str(fetch),
    }


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """table_name of every table of a catalog database; without one, temporary views count too."""
    found = [(t.name,) for t in spark.catalog.listTables(database) if database is None or not t.isTemporary]
    return spark.createDataFrame(found, "table_name string")


def database_tables(spark: SparkSession, options: Mapping[str, str], schema: str = "public") -> DataFrame:
    """table_name of every table of a schema in a SQL database."""
    query = f"SELECT table_name FROM information_schema.tables WHERE table_schema = '{schema}'"
    return spark.read.format("jdbc").options(**options).option("query", query).load()


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path and id (file name without suffix) of the files of a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("id"))


def read_csv(spark: SparkSession, path: str | Sequence[str], infer: bool = True, multi_line: bool = False) -> DataFrame:
    """CSV with header; types inferred, or all text.

    `multi_line` allows line breaks inside quotes; such a file cannot be split between tasks.
    """
    return spark.read.csv(path, header=True, inferSchema=infer, multiLine=multi_line, quote='"', escape='"')


def read_csv_folder(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every CSV file of a folder as a table named after the file."""
    files = list_files(spark, folder, "*.csv").collect()  # names only
    return {row.id: read_csv(spark, row.path) for row in files}


def read_csv_skipping_bad_rows(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows that do not fit the schema are left out.

    Values are checked against the columns in use, so all of them are read.
    """
    return spark.read.csv(path, header=True, schema=schema, mode="DROPMALFORMED", quote='"', escape='"')


def read_csv_strict(spark: SparkSession, path: str, schema: T.StructType | str, not_null: Sequence[str] = ()) -> DataFrame:
    """CSV into a declared schema; a row that does not fit stops the job, as does a missing key."""
    df = spark.read.csv(path, header=True, schema=schema, mode="FAILFAST", quote='"', escape='"', enforceSchema=False)
    for c in not_null:
        broken = F.raise_error(F.lit(f"null in {c}")).cast(df.schema[c].dataType)
        df = df.withColumn(c, F.when(F.col(c).isNull(), broken).otherwise(F.col(c)))
    return df


def high_water_mark(df: DataFrame, column: str = "created_at") -> Column:
    """The largest value of a column, as a scalar subquery."""
    return df.agg(F.max(column)).scalar()


def rows_after(df: DataFrame, column: str, loaded: DataFrame) -> DataFrame:
    """Rows newer than anything already loaded; all of them if nothing is."""
    mark = high_water_mark(loaded, column)
    return df.where(mark.isNull() | (F.col(column) > mark))
