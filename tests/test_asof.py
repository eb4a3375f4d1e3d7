"""As-of joins against a search through all versions."""

import datetime as dt
import random

import pytest

from millrace.operators.asof import as_of_join

VERSIONS = "k int, start timestamp_ntz, stop timestamp_ntz, name string"


def day(i):
    return None if i is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=i)


def plain(facts, versions, before, ends):
    out = []
    for i, k, t in facts:
        fits = [v for v in versions if k is not None and t is not None and v[0] == k and v[1] is not None and (v[1] < t if before else v[1] <= t)]
        best = max(fits, key=lambda v: (v[1], v[3] is not None, v[3] or ""), default=None)
        if ends and best and best[2] is not None and best[2] <= t:
            best = None
        out.append((i, k, t, best and best[3], best and best[1]))
    return sorted(out, key=str)


@pytest.mark.parametrize("slices", [1, 5, 64])
@pytest.mark.parametrize("before", [False, True])
@pytest.mark.parametrize("ends", [False, True])
def test_the_valid_version_is_found(spark, slices, before, ends):
    draw = random.Random(slices)
    key = lambda: draw.choice([None, 1, 1, 1, 1, 2, 3, 4])
    facts = [(i, key(), day(draw.choice([None, *range(60)]))) for i in range(300)]
    versions, seen = [], set()
    for n in range(60):
        k, at = key(), draw.choice([None, *range(60)])
        if (k, at) not in seen:
            seen.add((k, at))
            versions.append((k, day(at), day(at + draw.randrange(1, 30)) if at is not None and draw.random() < 0.6 else None, draw.choice([None, f"v{n}"])))
    f = spark.createDataFrame(facts, "id int, k int, t timestamp_ntz")
    v = spark.createDataFrame(versions, VERSIONS)
    found = as_of_join(f, v, ["k"], "t", "start", ["name", "start"], "stop" if ends else None, before, slices)
    assert found.columns == ["id", "k", "t", "name", "start"]
    assert sorted([tuple(r) for r in found.collect()], key=str) == plain(facts, versions, before, ends)


def test_versions_that_start_together(spark):
    f = spark.createDataFrame([(1, 1, day(5))], "id int, k int, t timestamp_ntz")
    v = spark.createDataFrame([(1, day(2), None, "a"), (1, day(2), None, "b")], VERSIONS)
    assert as_of_join(f, v, ["k"], "t", "start", ["name"]).first().name == "b"


def test_empty_sides(spark):
    f = spark.createDataFrame([(1, 1, day(5))], "id int, k int, t timestamp_ntz")
    v = spark.createDataFrame([], VERSIONS)
    assert [tuple(r) for r in as_of_join(f, v, ["k"], "t", "start", ["name"], "stop").collect()] == [(1, 1, day(5), None)]
    assert as_of_join(f.limit(0), v, ["k"], "t", "start", ["name"]).isEmpty()
