"""Profiles from fingerprints against counts of the values."""

import random
from collections import Counter

import pytest

from millrace.operators import profile


@pytest.mark.parametrize("ties", [0, 1000])
def test_modes_and_distinct_values(spark, monkeypatch, ties):
    monkeypatch.setattr(profile, "MOST_TIES", ties)  # as a join, as a list
    draw = random.Random(1)
    rows = [(draw.choice([None, "", "b", "a"]), f"x{i}", draw.choice(["p", "q"]) if i < 40 else None, draw.choice([None, 1.5, 2.5]), None) for i in range(60)]
    rows += [("b", "x1", "q", 1.5, None), ("a", "x0", "p", -0.0, None)]
    df = spark.createDataFrame(rows, "some string, most string, halves string, d double, none string")
    found = {r.column_name: r for r in profile.profile_tables({"t": df, "u": df.limit(0)}).where("table_name = 't'").collect()}
    for i, f in enumerate(df.schema):
        counts = Counter(r[i] for r in rows)
        top = max(counts.values())
        best = min((v for v, n in counts.items() if n == top), key=lambda v: (v is not None, v))
        got = found[f.name]
        assert got.distinct_values == len([v for v in counts if v is not None]) and got.num_rows == len(rows)
        assert got.duplicate_count == len(rows) - got.distinct_values
        assert got["mode"] == (best if f.dataType.simpleString() == "string" else None)
        assert got.null_percentage == 100.0 * sum(r[i] is None or r[i] == "" for r in rows) / len(rows)


def test_an_empty_table(spark):
    got = profile.profile_table(spark.createDataFrame([], "a int, s string"), "t").collect()
    assert [(r.num_rows, r.distinct_values, r.duplicate_count, r["mode"], r.null_percentage) for r in got] == [(0, 0, 0, None, 0.0)] * 2
