"""Operators 11 to 13 against plain versions, operator 8 on odd tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from conftest import SMALL
from edge_cases import documents, edge_docs, no_docs, session  # noqa: F401
from pyspark.sql import functions as F

from millrace.llm import audit, curriculum, manifest
from millrace.llm.base import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(df):
    return [r.asDict() for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def null_first(x):
    return (x is not None, x if x is not None else 0)


# Operator 13


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    out = []
    for c in ("doc_id", "source", "lang", "n_chars", "text"):
        v = row[c] if c != "n_chars" or row[c] is None else row[c] + more
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return h(*out)


def tree(nodes):
    """All levels, from the leaves to one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([h(*row[i : i + 2]) for i in range(0, len(row), 2)])
    return levels


def way(levels, i, start):
    """The siblings above place i and what `start` folds into."""
    proof = []
    for row in levels[:-1]:
        pair = row[i - i % 2 : i - i % 2 + 2]
        if len(pair) == 2:
            proof.append(pair[1 - i % 2])
            pair[i % 2] = start
        else:
            pair = [start]
        start, i = h(*pair), i // 2
    return proof, start


def plain_manifest(rows, hit):
    parts = defaultdict(list)
    for r in rows:
        parts[r["lang"]].append(r)
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = {}
    for p in names:
        parts[p].sort(key=lambda r: (null_first(r["doc_id"]), leaf_of(r)))
        trees[p] = tree([leaf_of(r) for r in parts[p]])
    top = tree([trees[p][-1][0] for p in names])
    out = []
    for j, p in enumerate(names):
        for i, r in enumerate(parts[p]):
            low, folded = way(trees[p], i, leaf_of(r, int(hit(r))))
            high, folded = way(top, j, folded)
            out.append((r["doc_id"], leaf_of(r), trees[p][-1][0], top[-1][0], h(*low, *high), folded, folded == top[-1][0]))
    return sorted(out, key=str)


@pytest.mark.parametrize("levels", [1, 3, 10])
def test_manifest(session, edge_docs, levels):
    odd = lambda r: r["doc_id"] is not None and r["doc_id"] % 3 == 1
    many = documents(session, [f"text {i}" for i in range(37)], langs=[["en", "de", None, "", "z"][min(i % 7, 4)] for i in range(37)])
    lone = documents(session, ["only"], langs=[None])
    for docs in [edge_docs, many, lone, table(session, SMALL, "documents")]:
        change = F.when(docs["doc_id"] % 3 == 1, docs["n_chars"] + 1).otherwise(docs["n_chars"])
        found = manifest.manifest(docs, tampered={"n_chars": change}, levels=levels)
        assert sorted([tuple(r) for r in found.collect()], key=str) == plain_manifest(plain(docs), odd)


def test_manifest_verifies_what_was_not_changed(session):
    docs = table(session, SMALL, "documents")
    assert manifest.manifest(docs).where("NOT verified").isEmpty()
    shuffled = docs.orderBy(F.rand(3)).repartition(5)
    roots = {r[0] for d in (docs, shuffled) for r in manifest.manifest(d).select("root").distinct().collect()}
    assert len(roots) == 1
    # A null stays null when one is added to it: nothing was changed.
    nulls = documents(session, ["a", "b"]).withColumn("n_chars", F.lit(None).cast("long"))
    assert manifest.manifest(nulls, tampered={"n_chars": nulls["n_chars"] + 1}).where("verified").count() == 2


def test_manifest_of_nothing(session, no_docs):
    found = manifest.manifest(no_docs)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"] and found.isEmpty()


def test_positions_of_a_hot_key(session):
    rows = session.range(5000).selectExpr("IF(id % 3 = 0, id % 11, NULL) AS k", "hash(id) AS o", "id")
    found = manifest.positions(rows.repartition(16), ["k"], ["o", "id"], "place", "total").collect()
    groups = defaultdict(list)
    for r in found:
        groups[r["k"]].append(r)
    for rs in groups.values():
        rs.sort(key=lambda r: r["place"])
        assert [r["place"] for r in rs] == list(range(len(rs))) and {r["total"] for r in rs} == {len(rs)}
        assert [(r["o"], r["id"]) for r in rs] == sorted((r["o"], r["id"]) for r in rs)


# Operator 12


def plain_fails(rows):
    smallest = {}
    for r in rows:
        if r["doc_id"] is not None:
            t = r["text"] or ""
            smallest[t] = min(smallest.get(t, r["doc_id"]), r["doc_id"])
    out = []
    for r in rows:
        t = r["text"] or ""
        words = WORD.findall(t)
        fails = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": r["doc_id"] is not None and smallest[t] < r["doc_id"],
        }
        out.append((r, {f for f, bad in fails.items() if bad}))
    return out


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    parts = defaultdict(list)
    for r, fails in plain_fails(rows):
        parts[r["source"] or ""].append((r["doc_id"], fails))
    out = []
    for part, docs in parts.items():
        by_filter, steps = Counter(), []
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [(i, x) for i, x in left if f in x]
                left = [(i, x) for i, x in left if f not in x]
                by_filter[f] += len(gone)
                failing = sum(f in x for _, x in docs)
                steps.append((
                    part, "".join(order), step, len(left), len(gone), failing - len(gone), sum(x == {f} for _, x in docs),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), f,
                ))
        out += [(*s[:-1], by_filter[s[-1]]) for s in steps]
    return sorted(out)


def test_audit(session, edge_docs, no_docs):
    text = "Some WORDS that # differ " + " ".join(f"w{i}" for i in range(60))
    copied = documents(session, [text] * 30 + ["a b"] * 4 + [None, ""], ids=[*range(30), 3, 3, None, 90, 91, 92])
    labels = session.createDataFrame([(0, 1, 0), (0, 0, 1), (3, 1, 1), (8, 1, None), (9, None, 1), (None, 1, 1), (92, 1, 1)], "doc_id long, quality int, toxic int")
    said = [tuple(r) for r in labels.collect()]
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    for docs in [edge_docs, copied]:
        found = audit.audit(audit.combinations(docs, labels), "ABCDE")
        assert found.columns == columns
        assert sorted(tuple(r) for r in found.collect()) == plain_audit(plain(docs), said)
    assert audit.audit(audit.combinations(no_docs, labels), "ABCDE").isEmpty()
    assert audit.audit(audit.combinations(copied, labels.limit(0)), "ABCDE").agg(F.sum("good_lost")).first()[0] == 0


# Operator 11


def plain_targets(sizes, weights, share, most):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, words = {}, set(names), share * sum(sizes.values())
    while free:
        level = (words - sum(out.values())) / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level >= most * sizes[s]}
        if not full:
            return {**out, **{s: weight[s] * level for s in free}}
        out.update({s: float(most * sizes[s]) for s in full})
        free -= full
    return out


def demand(schedule, at):
    """Share of the schedule's integral up to `at`, by small steps."""
    n, done, whole = 20_000, 0.0, 0.0
    for i in range(n):
        t = (i + 0.5) / n
        (a, v), (b, w) = next(p for p in zip(schedule, schedule[1:]) if t <= p[1][0])
        rate = v + (w - v) * (t - a) / (b - a)
        whole += rate
        done += rate if t < at else 0
    return done / whole


def sizes_of(docs):
    out = Counter()
    for r in plain(docs):
        out[r["source"]] += len(WORD.findall(r["text"] or ""))
    return dict(out)


def test_mix(session, edge_docs, monkeypatch):
    monkeypatch.setattr(curriculum, "BUCKET_ROWS", 4)
    hot = documents(session, ["a b c"] * 90 + ["d e"] * 10, sources=["s1"] * 90 + ["s2", "s3", "s4", None, ""] * 2)
    for docs in [edge_docs, hot, table(session, SMALL, "documents")]:
        rows = plain(docs)
        want = plain_targets(sizes_of(docs), [3, 1, 2], 1.5, 2)
        found = curriculum.plan(docs).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in found) == sorted(
            (r["doc_id"] is None, r["doc_id"] or 0, len(WORD.findall(r["text"] or ""))) for r in rows
        )
        taken = Counter()
        for r in found:
            assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-12) and r["taken"] <= 2 * r["size"]
            assert r["taken"] == sum(p["words"] for p in r["passes"])
            assert r["source_size"] == sizes_of(docs)[r["source"]]
            taken[r["source"]] += r["taken"]
        assert all(abs(taken[s] - t) <= 0.5 for s, t in want.items())
        again = curriculum.plan(docs.repartition(7)).collect()
        assert Counter(str(r) for r in found) == Counter(str(r) for r in again)


def test_mix_follows_the_schedules(session):
    """At any progress, a source has delivered what its schedule says, to within a document."""
    docs = session.range(3000).selectExpr("id AS doc_id", "concat('s', id % 3) AS source", "repeat('w ', 1 + id % 5) AS text")
    planned = curriculum.plan(docs)
    found = curriculum.mix(planned).collect()
    assert [r["position"] for r in found] == sorted(r["position"] for r in found)
    assert sum(r["words"] for r in found) == planned.agg(F.sum("taken")).first()[0]
    for turn, schedule in enumerate(curriculum.SCHEDULES):
        mine = [r for r in found if r["source"] == f"s{turn}"]
        for at in (0.1, 0.5, 0.8):
            words = sum(r["words"] for r in mine if r["position"] < at)
            assert abs(words - mine[0]["target"] * demand(schedule, at)) <= 8


def test_mix_of_nothing(session, no_docs):
    assert curriculum.plan(no_docs).isEmpty() and curriculum.mix(curriculum.plan(no_docs)).isEmpty()
    empty = documents(session, [None, ""])
    assert [(r["taken"], r["target"], r["passes"]) for r in curriculum.plan(empty).collect()] == [(0, 0.0, [])] * 2


# Operator 8 on odd tables, and the registered queries of 11 to 13


def test_url_rules_on_odd_tables(session):
    from millrace.llm import urls

    pages = session.createDataFrame(
        [(1, "http://A.example.org/es/x", "h", "p"), (1, "http://A.example.org/es/x", "h", "p"), (None, None, None, None), (2, "no host", "", "")],
        "page_id long, url string, host string, rule string",
    )
    found = sorted([tuple(r) for r in urls.judge(pages).collect()], key=str)
    assert found == sorted([
        (1, "a.example.org", "/es/x", "example.org/es/", "block"), (1, "a.example.org", "/es/x", "example.org/es/", "block"),
        (None, "", "", None, "allow"), (2, "", "", None, "allow"),
    ], key=str)
    assert urls.judge(pages.limit(0)).isEmpty()


def test_registered_digests_are_whole(session):
    from millrace.llm.queries import QUERIES

    docs = table(session, SMALL, "documents").count()
    for name in ("op11_curriculum_mix", "op13_merkle_manifest"):
        assert QUERIES[name](session, SMALL).select("doc_id").distinct().count() == docs
    counted = QUERIES["op12_filter_audit"](session, SMALL).groupBy("part").count().collect()
    assert {r["count"] for r in counted} == {600}
