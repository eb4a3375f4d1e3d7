"""Checks on tables. Row checks of one table share a single scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .lookups import missing_keys

FAR_DATE = "9999-12-31"


@dataclass(frozen=True)
class RowCheck:
    """A check decided by one row: `broken` is true for a failing row."""

    name: str
    broken: Column


@dataclass(frozen=True)
class TableCheck:
    """A check that needs grouping or another table: `failures` holds the failing rows or keys."""

    name: str
    failures: DataFrame


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null:{column}", F.col(column).isNull())


def not_negative(column: str) -> RowCheck:
    return RowCheck(f"not_negative:{column}", F.col(column).try_cast("double") < 0)


def date_order(first: str, second: str) -> RowCheck:
    """The first date may not come after the second; a missing date counts as the far future."""
    far = F.lit(FAR_DATE).cast("date")
    a = F.coalesce(F.col(first).cast("date"), far)
    b = F.coalesce(F.col(second).cast("date"), far)
    return RowCheck(f"date_order:{first},{second}", a > b)


def rule(name: str, holds: Column) -> RowCheck:
    """A CHECK constraint: null passes, as in SQL."""
    return RowCheck(f"rule:{name}", ~holds)


def pattern(column: str, regex: str) -> RowCheck:
    return RowCheck(f"pattern:{column}", ~F.col(column).rlike(regex))


def schema_checks(df: DataFrame, schema: T.StructType, limits: Mapping[str, int] | None = None) -> list[RowCheck]:
    """Declared nullability, type and text length of each column as row checks."""
    checks = []
    for f in schema.fields:
        kind = f.dataType.simpleString()
        if f.name not in df.columns:
            checks.append(RowCheck(f"present:{f.name}", F.lit(True)))
            continue
        if not f.nullable:
            checks.append(not_null(f.name))
        if df.schema[f.name].dataType != f.dataType:
            bad = F.col(f.name).isNotNull() & F.col(f.name).try_cast(kind).isNull()
            checks.append(RowCheck(f"type:{f.name}:{kind}", bad))
        if limits and f.name in limits:
            checks.append(RowCheck(f"length:{f.name}", F.length(f.name) > limits[f.name]))
    return checks


def unique(df: DataFrame, *columns: str) -> TableCheck:
    """Keys that occur more than once; rows without the key are left out.

    The grouping is that of `primary_key`, so that a report with both does it once.
    """
    grouped = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return TableCheck(f"unique:{','.join(columns)}", grouped.where("n > 1").dropna(subset=list(columns)))


def primary_key(df: DataFrame, *columns: str) -> TableCheck:
    """Keys that are null in a part or occur more than once."""
    missing = None
    for c in columns:
        missing = F.col(c).isNull() if missing is None else missing | F.col(c).isNull()
    bad = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).where(missing | (F.col("n") > 1))
    return TableCheck(f"primary_key:{','.join(columns)}", bad)


def foreign_key(df: DataFrame, parent: DataFrame, on: Mapping[str, str]) -> TableCheck:
    """Distinct key values without a parent row, found after the child keys were grouped."""
    keys = df.select(*on).dropna().groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
    return TableCheck(f"foreign_key:{','.join(on)}", missing_keys(keys, parent, on))


def password_failures(column: str) -> Column:
    """The broken rules of the password policy, an empty array for a good one."""
    c = F.coalesce(F.col(column), F.lit(""))
    rules = {
        "at least 8 characters": F.length(c) >= 8,
        "at least 1 digit": c.rlike("[0-9]"),
        "at least 1 capital letter": c.rlike("[A-Z]"),
        "at least 1 small letter": c.rlike("[a-z]"),
    }
    messages = [F.when(~holds, F.lit(text)) for text, holds in rules.items()]
    return F.filter(F.array(*messages), lambda m: m.isNotNull())


def split_by(df: DataFrame, failures: Column, name: str = "failures") -> tuple[DataFrame, DataFrame]:
    """(good rows, bad rows with the messages)."""
    marked = df.withColumn(name, failures)
    return marked.where(F.size(name) == 0).drop(name), marked.where(F.size(name) > 0)


@dataclass
class Suite:
    """The checks of several tables; `report` gives one row per check."""

    rows: dict[str, tuple[DataFrame, list[RowCheck]]] = field(default_factory=dict)
    tables: dict[str, list[TableCheck]] = field(default_factory=dict)

    def add(self, table: str, df: DataFrame, row_checks: Sequence[RowCheck] = (), table_checks: Sequence[TableCheck] = ()):
        self.rows[table] = (df, list(row_checks))
        self.tables[table] = list(table_checks)
        return self

    def report(self) -> DataFrame:
        """table_name, check_name, failures, passed."""
        parts = []
        for table, (df, checks) in self.rows.items():
            if checks:
                counts = df.agg(*[F.count_if(c.broken).alias(f"c{i}") for i, c in enumerate(checks)])
                pairs = [F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("failures")) for i, c in enumerate(checks)]
                parts.append(counts.select(F.lit(table).alias("table_name"), F.inline(F.array(*pairs))))
            for check in self.tables.get(table, []):
                parts.append(
                    check.failures.agg(F.count(F.lit(1)).alias("failures")).select(
                        F.lit(table).alias("table_name"), F.lit(check.name).alias("check_name"), "failures"
                    )
                )
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out.withColumn("passed", F.col("failures") == 0)

    def passed(self) -> bool:
        """True if no check fails; the report has one row per check."""
        return self.report().where(~F.col("passed")).isEmpty()


def has_null_key(df: DataFrame, column: str) -> bool:
    """Whether any key is null; stops at the first one found."""
    return not df.where(F.col(column).isNull()).limit(1).isEmpty()


def cascade_delete(
    tables: Mapping[str, DataFrame], references: Sequence[tuple[str, str, str, str]], root: str, removed: DataFrame
) -> dict[str, DataFrame]:
    """What is left after rows of `root` go and their dependants follow.

    `references` lists (child table, child column, parent table, parent column), parents first.
    `removed` holds the keys of the root rows to delete.
    """
    names = list(removed.columns)
    gone = {root: tables[root].join(removed, names, "left_semi")}
    left = {**tables, root: tables[root].join(removed, names, "left_anti")}
    for child, child_column, parent, parent_column in references:
        if parent not in gone:
            continue
        keys = gone[parent].select(F.col(parent_column).alias(child_column)).dropna().distinct()
        hit = left[child].join(keys, child_column, "left_semi")
        gone[child] = gone[child].unionByName(hit) if child in gone else hit
        left[child] = left[child].join(keys, child_column, "left_anti")
    return left


def blocked_deletes(children: DataFrame, child_column: str, removed: DataFrame, parent_column: str) -> DataFrame:
    """NO ACTION: the root rows that may not go because a child row refers to them."""
    used = children.select(F.col(child_column).alias(parent_column)).distinct()
    return removed.join(used, parent_column, "left_semi")


@dataclass(frozen=True)
class Reference:
    """`columns` of `child` refer to `parent_columns` of `parent`; a null part refers to nothing."""

    child: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass
class Cascade:
    """Per table the rows that stay and the keys that go, and per NO ACTION reference the rows that forbid it."""

    left: dict[str, DataFrame]
    gone: dict[str, DataFrame]
    blocked: dict[Reference, DataFrame]


def cascade_graph(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], references: Sequence[Reference],
    removed: Mapping[str, DataFrame], no_action: Sequence[Reference] = (),
) -> Cascade:
    """Delete rows of any tables and all rows that depend on them, whatever graph the references form.

    Tables may refer to themselves and to each other in a circle. `keys` names the columns that identify
    a row of each table (rows that share a key go together; a null is a value like others), `removed`
    holds the keys to delete. Tables that form a circle are followed in rounds, parents before children; a
    table in no circle is read once. Each round looks only for rows that refer to what the round before found,
    as distinct values, and ends when there are none; so the rounds are as many as the longest
    chain within a circle, and a parent of very many children adds one value to a semi join. A reference in
    `no_action` does not spread the delete: children that stay and refer to a row that goes are
    returned, and a caller who finds any has to give up the delete.
    """
    cited = {name: sorted({c for r in [*references, *no_action] if r.parent == name for c in r.parent_columns}) for name in tables}
    slim = {name: list(dict.fromkeys([*keys[name], *cited[name]])) for name in tables}
    gone: dict[str, list[tuple[int, DataFrame]]] = {name: [] for name in tables}

    def found(inside: Sequence[Reference], parents: Mapping[str, DataFrame]) -> dict[str, list[DataFrame]]:
        hits: dict[str, list[DataFrame]] = {}
        for r in inside:
            if r.parent in parents:
                hits.setdefault(r.child, []).append(_referring(tables[r.child], r, parents[r.parent]).select(*slim[r.child]))
        return hits

    for circle in _circles(list(tables), references):
        # Whatever the tables before spread to this circle is known in full, so it is looked up once.
        above = {r.parent: reduce(DataFrame.unionByName, [df for _, df in gone[r.parent]])
                 for r in references if r.child in circle and r.parent not in circle and gone[r.parent]}
        hits = found([r for r in references if r.child in circle], above)
        for name in circle:
            if name in removed:
                wanted = removed[name].select(*keys[name])
                hits.setdefault(name, []).append(_matching(tables[name], wanted, keys[name], "left_semi").select(*slim[name]))
        inside = [r for r in references if r.child in circle and r.parent in circle]
        while hits:
            fresh = {}
            for name, parts in hits.items():
                new = reduce(DataFrame.unionByName, parts).distinct()
                if gone[name]:
                    known = reduce(DataFrame.unionByName, [df for _, df in gone[name]])
                    new = _matching(new, known, keys[name], "left_anti")
                new = _written(new)
                if not new.isEmpty():
                    fresh[name] = new
            for name, new in fresh.items():
                gone[name] = _appended(gone[name], new)
            hits = found(inside, fresh)
    all_gone = {
        name: reduce(DataFrame.unionByName, [df for _, df in parts], tables[name].select(*slim[name]).limit(0))
        for name, parts in gone.items()
    }
    left = {name: _matching(df, all_gone[name], keys[name], "left_anti") if gone[name] else df for name, df in tables.items()}
    blocked = {r: _referring(left[r.child], r, all_gone[r.parent]) for r in no_action}
    return Cascade(left, {name: df.select(*keys[name]).distinct() for name, df in all_gone.items()}, blocked)


def _circles(names: Sequence[str], references: Sequence[Reference]) -> list[list[str]]:
    """The tables, those that refer to each other in a circle together, parents before children."""
    below = {n: {n} for n in names}
    for _ in names:
        for r in references:
            for reached in below.values():
                if r.parent in reached:
                    reached.add(r.child)
    # What reaches more tables comes first; tables of one circle reach the same ones.
    circles: dict[frozenset[str], list[str]] = {}
    for n in sorted(names, key=lambda n: -len(below[n])):
        circles.setdefault(frozenset(below[n]), []).append(n)
    return list(circles.values())


def _written(df: DataFrame) -> DataFrame:
    """The rows, read from a table in the shared folder, so that a round's plan starts anew."""
    path = scratch_path(df.sparkSession, "cascade")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _appended(parts: list[tuple[int, DataFrame]], new: DataFrame) -> list[tuple[int, DataFrame]]:
    """Parts with one more. Two of the same age become one, so n rounds leave log(n) parts and write a row log(n) times."""
    parts = [*parts, (0, new)]
    while len(parts) > 1 and parts[-1][0] == parts[-2][0]:
        (age, a), (_, b) = parts[-2:]
        parts = [*parts[:-2], (age + 1, _written(a.unionByName(b)))]
    return parts


def _matching(df: DataFrame, others: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join on columns of the same names, null equal to null."""
    held = [f"_other_{i}" for i in range(len(columns))]
    values = others.select(*[F.col(c).alias(h) for c, h in zip(columns, held)]).distinct()
    return df.join(values, reduce(and_, [F.col(c).eqNullSafe(F.col(h)) for c, h in zip(columns, held)]), how)


def _referring(children: DataFrame, reference: Reference, parents: DataFrame) -> DataFrame:
    held = [f"_parent_{i}" for i in range(len(reference.columns))]
    values = parents.select(*[F.col(c).alias(h) for c, h in zip(reference.parent_columns, held)]).dropna().distinct()
    return children.join(values, reduce(and_, [F.col(c) == F.col(h) for c, h in zip(reference.columns, held)]), "left_semi")
