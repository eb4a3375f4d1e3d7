"""A log of numbered commits in a shared folder: a number is taken once, whoever comes first.

A commit is one small file that appears whole. On a file system of the machine (or one mounted there)
it is linked under its number, elsewhere Hadoop renames it without overwriting. Both refuse a number
that is there. An object store whose rename is not atomic gives no such promise.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import SparkSession

_NAME = re.compile(r"\d{20}")


class Conflict(RuntimeError):
    """Another writer took the number first."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def committed(spark: SparkSession, folder: str) -> list[int]:
    """The numbers taken, ascending."""
    _, path, system = _hadoop(spark, folder)
    if not system.exists(path):
        return []
    names = (s.getPath().getName() for s in system.listStatus(path))
    return sorted(int(n) for n in names if _NAME.fullmatch(n))


def content(spark: SparkSession, folder: str, number: int) -> str:
    """The line written with a commit."""
    _, path, system = _hadoop(spark, f"{folder}/{number:020d}")
    stream = system.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def commit(spark: SparkSession, folder: str, number: int, line: str) -> None:
    """Take a number, or raise `Conflict` and leave everything as it was."""
    # Hidden names are not listed by Spark's readers.
    draft, final = f"{folder}/.{uuid.uuid4().hex}", f"{folder}/{number:020d}"
    jvm, path, system = _hadoop(spark, draft)
    stream = system.create(path, False)
    stream.write(line.encode())
    stream.close()
    try:
        if system.getUri().getScheme() == "file":
            local = jvm.org.apache.hadoop.fs.Path(f"{folder}").toUri().getPath()
            os.link(f"{local}/{os.path.basename(draft)}", f"{local}/{number:020d}")
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            context.rename(path, jvm.org.apache.hadoop.fs.Path(final), options)
    except Exception as error:
        # Whatever went wrong, a number that is there now was taken by someone else.
        if number in committed(spark, folder):
            raise Conflict(f"commit {number} in {folder} was taken by another writer") from error
        raise
    finally:
        system.delete(path, False)
