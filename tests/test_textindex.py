"""Searches by the stored index against counting all words of all texts."""

import math
import random
import re
from collections import Counter

import pytest

from millrace.operators import textindex


def brute(docs, queries, k):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    counts = {d: Counter(split(t)) for d, t in docs}
    held = Counter(w for c in counts.values() for w in c)
    weight = {w: round((math.log((len(docs) + 1) / (n + 1)) + 1) * 1_000_000) for w, n in held.items()}
    out = {}
    for q, text in queries:
        terms = set(split(text))
        scored = [(-sum(c[t] * weight[t] for t in terms if t in c), d, sum(t in c for t in terms)) for d, c in counts.items()]
        for place, (points, d, matched) in enumerate(sorted(s for s in scored if s[2])[:k]):
            out[q, place + 1] = (d, -points, matched)
    return out


def found(df):
    return {(r["query"], r["place"]): (r["doc"], round(r["score"] * 1_000_000), r["matched"]) for r in df.collect()}


def texts(n, seed=1):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Éa", "ночь", "x9"]
    return [(i, " ".join(draw.choices(vocabulary, weights=[1 / (j + 1) for j in range(63)], k=draw.choice([0, 3, 8, 40, 300])))) for i in range(n)]


def test_searches_are_exact_after_a_segment_is_added(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "BLOCK", 8)
    target, columns = str(tmp_path / "index"), "doc_id long, text string"
    docs = texts(300) + [(300, None), (301, ""), (302, "w0. W0, w0! _w0_"), (303, "ÉA éa")] + [(i, "w1 w2 ночь") for i in range(304, 404)]
    queries = [(0, "w0"), (1, "w1 w2 ночь"), (2, "W50, w59; x9 éa"), (3, "nothing"), (4, None), (5, "w0 w1 w2 w3 w4 w5 w0"), (None, "w7")]
    asked = spark.createDataFrame(queries, "q long, text string")
    look = lambda k: found(textindex.search(spark, target, asked, "q", "text", k))
    assert look(3) == {}
    assert textindex.add(target, spark.createDataFrame(docs[:350], columns), "doc_id", "text") == 350
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}
    assert look(7) == brute(docs[:350], queries, 7)
    textindex.add(target, spark.createDataFrame(docs[350:], columns), "doc_id", "text")
    assert all(p.stat().st_mtime_ns == at for p, at in before.items())
    for k in (1, 500):
        assert look(k) == brute(docs, queries, k)


def test_ids_come_once_and_empty_segments_do_no_harm(spark, tmp_path):
    target, columns = str(tmp_path / "index"), "doc_id string, text string, doc int, term string"
    make = lambda *ids: spark.createDataFrame([(i, "one two", 1, "x") for i in ids], columns)
    assert textindex.add(target, make(), "doc_id", "text") == 0
    asked = spark.createDataFrame([(1, "two")], "q int, text string")
    assert textindex.search(spark, target, asked, "q", "text", 2).isEmpty()
    textindex.add(target, make("a", "b"), "doc_id", "text")
    for bad in (make("c", "c"), make("d", None), make("e", "b")):
        with pytest.raises(textindex.RepeatedDocument):
            textindex.add(target, bad, "doc_id", "text")
    assert sum(textindex.segments(spark, target).values()) == 2
    rows = textindex.search(spark, target, asked, "q", "text", 2).orderBy("place").collect()
    assert [(r["doc"], r["matched"]) for r in rows] == [("a", 1), ("b", 1)]


def test_weak_blocks_are_not_scored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(textindex, "BLOCK", 4)
    target = str(tmp_path / "index")
    docs = [(i, "rare " * (40 if i < 4 else 1) + "filler " * (200 if i < 4 else 2)) for i in range(200)]
    textindex.add(target, spark.createDataFrame(docs, "doc_id long, text string"), "doc_id", "text")
    visits, scored = [], textindex._scored
    monkeypatch.setattr(textindex, "_scored", lambda s, w, v: visits.append(v.count()) or scored(s, w, v))
    asked = spark.createDataFrame([(1, "rare")], "q int, text string")
    assert found(textindex.search(spark, target, asked, "q", "text", 2)) == brute(docs, [(1, "rare")], 2)
    assert sum(visits) <= 4  # of some 50 blocks
