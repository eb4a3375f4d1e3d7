"""Operators do the whole of their job: results that a cut would change."""

from collections import Counter

import numpy as np
from edge_cases import session  # noqa: F401

from millrace.llm import language, lm, pii, quality

TEXTS = ["the cat sat on the mat", "the dog sat on the rug", "a cat and a dog", "", "the cat sat"] * 6


def scored(session, texts):
    docs = session.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r for r in lm.score(docs, modulus=1, held_out=1).collect()}


def test_lm_order_of_words_counts(session):
    texts = [*TEXTS, "mat the on sat cat the"]
    found = scored(session, texts)
    assert abs(found[0]["base_score"] - found[len(TEXTS)]["base_score"]) < 1e-9
    assert found[0]["score"] > found[len(TEXTS)]["score"] + 1


def test_lm_pair_counts_are_exact(session, monkeypatch):
    """Over several blocks, and with slices that hold pairs of all of them."""
    monkeypatch.setattr(lm, "BLOCK_BYTES", 60)
    docs = session.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string").coalesce(1)
    stored = lm.blocks(docs, 5, 2, "doc_id", "text").cache()
    held = {i for i, r in enumerate(stored.where("kind = 0").orderBy("block", "place").collect()) if r["held_out"]}
    want = Counter(p for i, t in enumerate(TEXTS) if i not in held for p in zip([None, *t.split()], [*t.split(), None]))
    bits, seen, once = 2, {}, 0
    totals = {}
    for r in lm.pair_counts(stored, bits).collect():
        totals[r["block"], r["slice"]], once = r["totals"], once + r["once"]
    listed = {}
    for r in stored.where("kind = 1").collect():
        listed.setdefault(r["block"], {})[r["place"]] = bytes(r["word"]).decode()
    blocks = stored.where("kind = 2").collect()
    assert len(blocks) > 3 and held
    for r in blocks:
        pairs = lm.Pairs(r["tokens"], r["lengths"], r["prints"])
        keys = pairs.distinct()
        at = lm.slices(keys, bits)
        total = np.concatenate([lm._unpacked(totals.get((r["block"], i), b""), at[i + 1] - at[i]) for i in range(1 << bits)])
        for a, b, n in zip(pairs.before, pairs.after, total[np.searchsorted(keys, pairs.keys())]):
            seen[listed[r["block"]].get(a), listed[r["block"]].get(b)] = n
    assert {p: n for p, n in seen.items() if n} == dict(want)
    assert once == sum(n == 1 for n in want.values())


def test_lm_counts_of_beginnings_are_exact(session, monkeypatch):
    """Every bit knows how often the words that begin alike took each turn, also over the edges of runs."""
    monkeypatch.setattr(lm, "RUN_WORDS", 7)
    draw = np.random.default_rng(3)
    words = {bytes(draw.choice(list(b"abc"), draw.integers(1, 7)).astype(np.uint8)): int(draw.integers(0, 5)) for _ in range(300)}
    code = lm.Code(np.bincount(lm.signs_of(list(words))[0], minlength=257))
    want = Counter()
    for word, n in words.items():
        bits = lm.Bits(code, [word])
        sign = np.repeat(np.arange(len(word) + 1), code.size[lm.signs_of([word])[0]])
        for i, node, turn in zip(sign, bits.node, bits.turn):
            want[word[:i], node, turn] += n
    table = session.createDataFrame([(bytearray(w), n) for w, n in words.items()], "word binary, c bigint")
    runs = lm.sorted_runs(table)
    shared = lm.shared_beginnings(runs)
    seen = set()
    for r in runs.collect():
        part = [bytes(w) for w in r["words"]]
        begun = lm.Begun(code, part, np.array(r["counts"], dtype=float), shared)
        for at, word in enumerate(part):
            bits, (no, yes) = lm.Bits(code, [word]), begun.of(np.array([at]))
            sign = np.repeat(np.arange(len(word) + 1), code.size[lm.signs_of([word])[0]])
            assert [(a, b) for a, b in zip(no, yes)] == [(want[word[:i], k, False], want[word[:i], k, True]) for i, k in zip(sign, bits.node)]
            seen.add(word)
    assert seen == set(words) and len(shared[0])


def test_lm_tables_grow_with_the_contexts(session):
    draw = np.random.default_rng(5)
    words = sorted({bytes(draw.integers(33, 127, 8).astype(np.uint8)) for _ in range(30_000)})
    table = session.createDataFrame([(bytearray(w), 1) for w in words], "word binary, c bigint")
    runs = lm.sorted_runs(table).cache()
    model = lm.learn(runs, lm.shared_beginnings(runs))
    found = np.unique(np.concatenate([lm.Bits(model.code, words).keys[-1]]))
    assert model.slots[-1] > 3 * len(found) > lm.SLOTS[-1]


def test_html_element_anywhere_declares(session):
    """An html element behind a long comment outranks the column."""
    text = "<!-- " + "licence " * 400 + '--><html lang="fr"><body>un deux trois</body></html>'
    docs = session.createDataFrame([(1, text, "de")], "doc_id long, text string, lang string")
    row = docs.select(language._evidence(docs, "text", "lang", None)[1]).first()
    assert row["declared"] == "fr"


def test_turns_over_the_whole_candidate():
    body = "a" * 70 + "1b2c3d4e5f6g7h8"
    votes, features = pii._describe("secret", body, 0, len(body))
    assert votes[3] == "+" and features.endswith("|4")


def test_quality_learns_from_both_labels_with_repeated_ids(session):
    """An id with many texts leaves room for the others, and the voters don't depend on the order of rows."""
    texts = [(1, f"page {i} buy now") for i in range(60)] + [(i, f"a well written text number {i}") for i in range(2, 6)]
    labels = session.createDataFrame([(1, 0), *[(i, 1) for i in range(2, 6)]], "doc_id long, quality int")
    found = []
    for rows in (texts, texts[::-1]):
        docs = session.createDataFrame(rows, "doc_id long, text string").coalesce(1)
        found.append(quality.fit(docs, labels, "doc_id", "text", "quality", 1 << 30, 4))
    assert np.array_equal(found[0].label, found[1].label) and np.allclose(found[0].vectors, found[1].vectors)
    assert set(found[0].label) == {0, 1} and len(found[0].label) == 5
