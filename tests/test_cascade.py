"""Deletes over graphs of references against a plain search."""

import random

from conftest import rows
from millrace.operators.quality import Reference, cascade_graph


def test_circles_chains_and_nulls(spark):
    draw = random.Random(3)
    # a: a chain, a self loop, a hot parent, random links, nulls; b refers to a by two columns and a to b.
    a = [(i, i - 1 if 0 < i < 12 else None, None) for i in range(12)] + [(20, 20, None), (21, 20, None)]
    a += [(30 + i, 5, None) for i in range(40)] + [(100 + i, draw.choice([None, draw.randrange(100, 160)]), draw.choice([None, None, draw.randrange(40)])) for i in range(60)]
    b = [(i, draw.choice([None, draw.randrange(100, 160)]), 7) for i in range(40)]
    tables = {
        "a": spark.createDataFrame([(i, p, o, 7) for i, p, o in a], "id int, parent int, origin int, kind int"),
        "b": spark.createDataFrame(b, "no int, a_id int, a_kind int"),
    }
    references = [
        Reference("a", ("parent",), "a", ("id",)), Reference("a", ("origin",), "b", ("no",)),
        Reference("b", ("a_id", "a_kind"), "a", ("id", "kind")),
    ]
    for start in ([8, 105], [20], [None]):
        gone = {("a", i) for i in start if i in {r[0] for r in a}}
        while True:
            more = {("a", i) for i, p, o in a if ("a", p) in gone or ("b", o) in gone} | {("b", n) for n, x, _ in b if ("a", x) in gone}
            if more <= gone:
                break
            gone |= more
        removed = spark.createDataFrame([(i,) for i in start], "id int")
        result = cascade_graph(tables, {"a": ["id"], "b": ["no"]}, references, {"a": removed})
        got = {("a", r[0]) for r in result.gone["a"].collect()} | {("b", r[0]) for r in result.gone["b"].collect()}
        assert got == gone
        left = {("a", r["id"]) for r in result.left["a"].collect()} | {("b", r["no"]) for r in result.left["b"].collect()}
        assert left == ({("a", r[0]) for r in a} | {("b", r[0]) for r in b}) - gone


def test_null_keys_and_blocked_rows(spark):
    p = spark.createDataFrame([(1, "x"), (None, "y"), (2, "z")], "id int, v string")
    c = spark.createDataFrame([(10, 1), (11, None), (12, 2), (13, 1)], "id int, p int")
    reference = Reference("c", ("p",), "p", ("id",))
    removed = {"p": spark.createDataFrame([(None,), (1,)], "id int"), "c": spark.createDataFrame([(13,)], "id int")}
    result = cascade_graph({"p": p, "c": c}, {"p": ["id"], "c": ["id"]}, [], removed, [reference])
    assert rows(result.left["p"]) == [(2, "z")]  # a null key is a key, but nothing refers to it
    assert rows(result.blocked[reference]) == [(10, 1)]
    empty = cascade_graph({"p": p, "c": c.limit(0)}, {"p": ["id"], "c": ["id"]}, [reference], {"p": p.limit(0)}, [reference])
    assert empty.left["p"].count() == 3 and empty.blocked[reference].count() == 0 and empty.gone["c"].count() == 0
