"""Tables compared row by row."""

import pytest

from millrace.operators.reconcile import reconcile

COLUMNS = "k int, v string, w string"


def test_rows_are_paired_by_key(spark):
    left = [(1, "a", None), (1, "a", None), (2, "b", "x"), (3, "c", "y"), (None, "n", ""), (7, "12:3", "4")]
    right = [(1, "a", None), (1, "z", None), (2, "b", "x"), (4, "d", "y"), (None, "n", None), (7, "12", "3:4")]
    make = lambda rows: spark.createDataFrame(rows, COLUMNS)
    report = lambda *a: tuple(reconcile(*a).first())
    assert report(make(left), make(right), ["k"]) == (2, 3, 1, 1)
    assert report(make(left), make(right)) == (2, 0, 4, 4)
    assert report(make(left), make(left).select("w", "k", "v"), ["k"]) == (6, 0, 0, 0)
    assert report(make([]), make([]), ["k"]) == (0, 0, 0, 0) and report(make([]), make(right), ["k"]) == (0, 0, 0, 6)
    with pytest.raises(ValueError):
        reconcile(make(left), make(right).drop("w"))


def test_only_keys(spark):
    a, b = (spark.createDataFrame([(i,) for i in rows], "k int") for rows in ([1, 1, 2], [1, 2, 2, 3]))
    assert tuple(reconcile(a, b, ["k"]).first()) == (2, 0, 1, 2)
