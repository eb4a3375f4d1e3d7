"""Operators 1, 2 and 3 and the pipeline against plain versions."""

import zlib

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from edge_cases import edge_docs, no_docs, session  # noqa: F401

from millrace.llm import jaccard, quality, vectors
from millrace.llm.base import components, table


def closure(ids, links):
    """Smallest id reached from each id."""
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def test_components(session):
    rng = np.random.default_rng(2)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2000 + i) for i in range(50)]
    found = {r["node"]: r["component"] for r in components(session.createDataFrame(links, "a long, b long")).collect()}
    nodes = {x for link in links for x in link}
    want = closure(nodes, links)
    assert found == {k: v for k, v in want.items() if k in found}
    assert {k for k in nodes if want[k] != k} <= set(found)
    assert components(session.createDataFrame([], "a long, b long")).count() == 0


def plain_links(vectors_, least=0.9):
    ids = list(vectors_)
    x = np.array([vectors_[i] for i in ids], dtype=float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= least
    return [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near)) if i != j]


def test_vector_links(session, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 64)  # several blocks for one list
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(12, 16))
    sound = {i: (centres[i % 12] + rng.normal(scale=rng.choice([0.05, 0.3, 0.6]), size=16)).tolist() for i in range(600)}
    for i in range(600, 700):
        sound[i] = sound[3]
    sound[700] = [1e300] * 16
    sound[701] = [2e299] * 16
    odd = {800: None, 801: [0.0] * 16, 802: [float("nan")] * 16, 803: [float("inf"), *[1.0] * 15], 804: [None, *[1.0] * 15], 805: []}
    rows = [(i, v, 1) for i, v in {**sound, **odd}.items()] + [(None, sound[3], 2)]
    found = {r["vec_id"]: r for r in vectors.links(session.createDataFrame(rows, "vec_id long, embedding array<double>, n int")).collect()}
    assert len(found) == len(rows)
    scaled = {i: np.array(v) / np.abs(v).max() for i, v in sound.items()}
    links = plain_links(scaled)
    root = closure(sound, links)
    degree = {i: 0 for i in sound}
    for a, _ in links:
        degree[a] += 1
    for i in sound:
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (degree[i], root[i], root[i] == i), i
    for i in odd:
        assert (found[i]["n_links"], found[i]["component_id"], found[i]["kept"]) == (0, i, True)
    assert (found[None]["n_links"], found[None]["component_id"], found[None]["kept"]) == (0, None, True)


def test_coded_vectors():
    """A decoded vector is as far from its vector as the coding error says."""
    rng = np.random.default_rng(8)
    points = rng.normal(size=(700, 20))
    coder = vectors.Quantiser(points[:600], 5)
    left = points - coder.centres[vectors._nearest(points, coder.centres)]
    codes, error = coder.codes(left)
    assert np.allclose(np.sqrt(((left - coder.decoded(codes)) ** 2).sum(axis=1)), error)


def test_vectors_none_or_one(session):
    schema = "vec_id long, embedding array<float>"
    assert vectors.links(session.createDataFrame([], schema)).collect() == []
    assert [tuple(r) for r in vectors.links(session.createDataFrame([(5, [1.0, 2.0])], schema)).collect()] == [(5, 0, 5, True)]
    twice = session.createDataFrame([(5, [1.0, 2.0]), (5, [1.0, 2.0])], schema)
    assert [tuple(r) for r in vectors.links(twice).collect()] == [(5, 1, 5, True)] * 2


def test_vector_recall_on_the_given_table(session):
    found = {r["vec_id"]: r["n_links"] for r in vectors.links(table(session, SMALL, "embeddings")).collect()}
    given = {r["vec_id"]: r["embedding"] for r in table(session, SMALL, "embeddings").collect()}
    assert sum(found.values()) == len(plain_links(given))


def test_quality_held_out(session):
    docs, labels = table(session, "/root/testdata/sf0.01", "documents"), table(session, "/root/testdata/sf0.01", "labels")
    found = {r["doc_id"]: r for r in quality.classify(docs, labels).collect()}
    right = n = 0
    for r in labels.collect():
        row = found[r["doc_id"]]
        assert row["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1 and row["predicted"] == int(row["score"] >= 0.3)
        if row["held_out"]:
            n += 1
            right += row["predicted"] == r["quality"]
    assert right >= 0.93 * n


def test_quality_edges(session, edge_docs, no_docs):
    labels = session.createDataFrame(
        [(5, 1, 0), (6, 0, 0), (8, 1, None), (3, 0, 1), (3, 1, 1), (7, None, None), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int"
    )
    rows = quality.classify(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.classify(no_docs, labels).collect() == []
    assert {r["score"] for r in quality.classify(edge_docs, labels.limit(0)).collect()} == {0.5}
    assert {r["score"] for r in quality.classify(edge_docs, labels.where("quality = 1 AND doc_id > 3")).collect()} == {1.0}


def shingles(text, words):
    found = (text or "").encode().lower().split()
    return {tuple(found[i : i + words]) for i in range(len(found) - words + 1)} or ({tuple(found)} if found else set())


def plain_components(rows, words, least):
    sets = {i: shingles(t, words) for i, t in rows}
    ids = sorted(sets)
    links = [
        (a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b])
    ]
    return sets, closure(ids, links)


def families(seed):
    """Families of near copies of many sizes, texts that share passages, short texts."""
    rng = np.random.default_rng(seed)
    lexicon = [f"w{i}" for i in range(3000)]
    passage = rng.choice(lexicon, 30).tolist()
    texts = []
    for size, length in ((40, 60), (25, 150), (3, 400), (2, 30), (12, 12), (6, 9)):
        base = rng.choice(lexicon, length).tolist()
        for k in range(size):
            copy = list(base)
            for at in rng.integers(0, length, rng.integers(0, max(2, length // 20))):
                copy[at] = str(rng.choice(lexicon))
            texts.append(copy)
    for k in range(60):
        own = rng.choice(lexicon, rng.integers(3, 80)).tolist()
        at = rng.integers(0, len(own))
        texts.append(own[:at] + passage + own[at:])
    for k in range(40):
        texts.append(rng.choice(lexicon[:4], rng.integers(1, 8)).tolist())
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("rare, least, words", [(48, 85, 4), (2, 85, 4), (2, 80, 5), (1, 90, 3)])
def test_similar_texts(session, monkeypatch, rare, least, words):
    """Small bounds make most tokens frequent, so that combinations and blocks have to find the links."""
    monkeypatch.setattr(jaccard, "RARE", rare)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 8)
    monkeypatch.setattr(jaccard, "BLOCK_ROWS", 16)
    monkeypatch.setattr(jaccard, "UNIT_PAIRS", 16)
    rows = families(rare + least)
    found = {r["doc_id"]: r for r in jaccard.similar_texts(session.createDataFrame(rows, "doc_id long, text string"), words=words, least=least).collect()}
    sets, root = plain_components(rows, words, least)
    for i, s in sets.items():
        assert (found[i]["n_shingles"], found[i]["component_id"]) == (len(s), root[i]), i
    assert len(set(root.values())) < len(rows)


def test_signatures_keep_every_pair():
    """Whenever two sets are similar and every token is frequent, they have a signature in common."""
    rng = np.random.default_rng(11)
    for least in (80, 85, 95):
        shape = jaccard.Shape(least)
        for _ in range(300):
            n = int(rng.integers(4, 300))
            tokens = np.unique(rng.integers(0, 2**63, n + 100, dtype=np.uint64))
            a = np.sort(rng.choice(tokens, n, replace=False))
            lost, new = rng.choice(a, rng.integers(0, shape.missing(n) + 1), replace=False), rng.choice(np.setdiff1d(tokens, a), rng.integers(0, max(1, n // 10)), replace=False)
            b = np.union1d(np.setdiff1d(a, lost), new)
            common = len(np.intersect1d(a, b))
            if not shape.alike(common, len(a), len(b)) or len(lost) + len(new) == 0:
                continue
            one, two = (shape.signatures(len(s), s[: shape.prefix(len(s))]) for s in (a, b))
            assert len(np.intersect1d(one, two)), (least, len(a), len(b), common)


def test_sketches_differ_no_more_than_their_sets():
    rng = np.random.default_rng(12)
    tokens = rng.integers(0, 2**63, 6000, dtype=np.uint64)
    sets = [np.unique(rng.choice(tokens[: 2 * n], n)) for n in (1, 3, 40, 500, 1030, 1100, 2500, 3000) for _ in range(3)]
    a, b = (x.ravel() for x in np.indices((len(sets), len(sets))))
    found = jaccard.Sketches([jaccard.sketch(s) for s in sets]).differences(a, b)
    wanted = np.array([len(np.setxor1d(sets[i], sets[j])) for i, j in zip(a, b)])
    assert (found <= wanted).all() and (found[a == b] == 0).all()
    small = (wanted > 0) & (wanted < 100)
    assert small.any() and (found[small] > 0.5 * wanted[small]).all()


def test_pairs_of_a_family_are_not_listed():
    """Near copies of one text, most too far from each other to link: hardly more pairs than links are left to list."""
    rng = np.random.default_rng(13)
    base, shape = rng.integers(0, 2**63, 150, dtype=np.uint64), jaccard.Shape(85)
    sets = []
    for _ in range(300):
        copy, at = base.copy(), rng.integers(0, 150, rng.integers(0, 50))
        copy[at] = rng.integers(0, 2**63, len(at), dtype=np.uint64)
        sets.append(np.unique(copy))
    n, count = np.array([len(s) for s in sets]), len(sets)
    columns = [[True] * count, list(range(count)), [s[: jaccard.KEYS].tobytes() for s in sets], [jaccard.sketch(s) for s in sets]]
    a, b = np.triu_indices(count, 1)
    found = jaccard._Members(n, *[pa.array(c) for c in columns]).open(shape, a, b)
    alike = shape.alike(np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b)]), n[a], n[b])
    apart = np.array([not len(np.intersect1d(sets[i][: jaccard.KEYS], sets[j][: jaccard.KEYS])) for i, j in zip(a, b)])
    assert (found[alike] == apart[alike]).all() and alike.sum() > 1000
    assert (found & ~alike).sum() < 0.02 * (~alike & apart).sum()
    joined = jaccard._Members(n, *[pa.array(c) for c in [columns[0], [7] * count, *columns[2:]]])
    assert not joined.open(shape, a, b).any()


def test_similar_texts_edges(session, edge_docs, no_docs):
    found = jaccard.similar_texts(edge_docs).collect()
    assert len(found) == edge_docs.count()
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found}
    assert {(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 4), (8, 1, 8), (9, 1, 8), (None, 0, None), (None, 1, None)} <= got
    assert jaccard.similar_texts(no_docs).collect() == []
    kept = jaccard.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id IS NOT NULL").collect()) == [i for i in range(13) if i != 9]
    assert kept.where("doc_id IS NULL").count() == 2
    with pytest.raises(ValueError):
        jaccard.similar_texts(no_docs, least=50)


def test_pipeline(session):
    """Each stage against its operator's own verdicts, and the last against the tokens of what was left."""
    from millrace.llm import language, rules

    docs = table(session, SMALL, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    left = stages["language ID"](session, docs, SMALL).cache()
    assert left.columns == columns
    assert {r[0] for r in left.select("doc_id").collect()} == {r[0] for r in language.identify(docs).where("accepted").select("doc_id").collect()}
    good = stages["quality rules"](session, left, SMALL).cache()
    assert good.columns == columns
    assert {r[0] for r in good.select("doc_id").collect()} == {r[0] for r in rules.judge(left).where("kept").select("doc_id").collect()}
    single = stages["n-gram Jaccard join"](session, good, SMALL).cache()
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    _, root = plain_components(rows, 5, 80)
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == sorted(i for i, c in root.items() if i == c)
    clean = stages["PII"](session, single, SMALL).cache()
    assert clean.columns == columns and clean.count() == single.count()
    last = stages["packing"](session, clean, SMALL)
    assert {r[0] for r in last.select("doc_id").distinct().collect()} == {r["doc_id"] for r in clean.collect()}
    whole = corpus_pipeline.run(session, SMALL)
    assert sorted(map(tuple, whole.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        map(tuple, last.select("doc_id", "start", "length", "ids_crc32").collect())
    )
