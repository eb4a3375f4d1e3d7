"""Operators 4, 5, 6, 7, 9 and 10 and the rules on urls against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from conftest import SMALL
from edge_cases import edge_docs, no_docs, session  # noqa: F401
from pyspark.sql import functions as F

from millrace.llm import language, lm, packing, pieces, pii, rules, urls
from millrace.llm.base import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df, column="doc_id"):
    out = defaultdict(list)
    for r in df.collect():
        out[r[column]].append(r)
    return out


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def samples(session, edge_docs):
    return [edge_docs, table(session, SMALL, "documents")]


def plain_measures(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def test_measures(session, edge_docs):
    for docs in samples(session, edge_docs):
        found = by_id(rules.judge(docs))
        want = defaultdict(list)
        for i, t in texts_of(docs):
            want[i].append(plain_measures(t))
        assert {i: sorted(tuple(r[m] for m in rules.MEASURES) for r in rs) for i, rs in found.items()} == {i: sorted(v) for i, v in want.items()}
        for rs in found.values():
            for r in rs:
                assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
                assert not (r["kept"] and r["base_failed"])


def test_host_verdicts(session):
    good = "every word of this line differs from all the other ones in it so that nothing at all seems repeated twice here"
    noisy = " ".join(w + "###" for w in good.split())
    rows = [("bad.example", "short")] * 300 + [("bad.example", good)] + [("noisy.example", noisy)] * 200
    rows += [("noisy.example", good)] * 10 + [("fine.example", good)] * 400 + [("fine.example", noisy)] + [("tiny.example", noisy)]
    docs = session.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id long, text string, source string")
    kept = {(rows[r["doc_id"]], r["kept"]) for r in rules.judge(docs).collect()}
    assert (("bad.example", good), False) in kept  # the whole host is refused
    assert (("noisy.example", noisy), False) in kept and (("noisy.example", good), True) in kept
    assert (("fine.example", good), True) in kept and (("fine.example", noisy), True) in kept
    stage = rules.keep_good(docs)
    assert stage.columns == docs.columns
    assert sorted(r["doc_id"] for r in stage.collect()) == sorted(r["doc_id"] for r in rules.judge(docs).where("kept").collect())


def test_host_rates_are_drawn_to_the_rest(session):
    rows = session.createDataFrame(
        [(f"h{i}", 10 if j < 2 else 100, 600, 0, 0, 0) for i in range(20) for j in range(100)] + [("one", 10, 60, 0, 0, 0)],
        "host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long",
    )
    rate = {r["host"]: r["base_rate"] for r in rules.host_rates(rows, "host").collect()}
    assert 0.02 < rate["one"] < 0.6 and abs(rate["h3"] - 0.02) < 0.01


def test_packing_round_trip(session, edge_docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    for docs in samples(session, edge_docs):
        rows = packing.pack(docs, path, with_ids=True).collect()
        want = Counter((i, tuple(tokenizer.encode(t, add_special_tokens=False).ids + [1])) for i, t in texts_of(docs))
        per_doc, per_sequence = defaultdict(list), defaultdict(list)
        for r in rows:
            per_doc[r["doc_id"]].append(r)
            per_sequence[r["sequence_id"]].append(r)
            assert r["length"] == len(r["ids"])
            assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        for i, ids in want:
            if sum(k == i for k, _ in want.elements()) == 1:
                parts = sorted(per_doc[i], key=lambda r: r["start"])
                assert tuple(x for r in parts for x in r["ids"]) == ids
                assert {r["doc_tokens"] for r in parts} == {len(ids)}
        assert sum(r["length"] for r in rows) == sum(len(ids) for _, ids in want.elements())
        for rs in per_sequence.values():
            end = 0
            for r in sorted(rs, key=lambda r: r["offset"]):
                assert r["offset"] == end
                end += r["length"]
            assert end <= packing.WINDOW


def test_little_padding():
    rng = np.random.default_rng(5)
    for lengths in (rng.integers(1, 2049, 20_000), np.minimum(rng.geometric(0.002, 20_000), 2048), np.full(999, 700)):
        counts = np.bincount(lengths, minlength=2049)
        plan = packing.plan(counts, 2048)
        back = np.zeros_like(counts)
        for used, n in plan:
            assert sum(k * u for k, u in used) <= 2048
            for k, u in used:
                back[k] += n * u
        assert (back == counts).all()
        if len(set(lengths.tolist())) > 1:
            assert sum(n for _, n in plan) * 2048 < 1.02 * lengths.sum()


TRICKY = [
    "", "\n", " ", "  \n  a", "▁▁ x ▁", "a\tb\r\n c", "ﬁ ０１ é ́x", "<s> </s> <0x0A> <unk>", "日本語 テスト", "\x00a \x01",
    "  lead", "trail  ", "a  b   c    d     e                  f", "<|endoftext|> a<|STARTOFTEXT|>b <|ENDOFTEXT|>", "it's we'll 'S don't\x1cfoo bar\x85baz",
    "ΑΣ Σ ς İI", "﻿bom", "̀ ̀̕", "foo.. bar., x_, y_. 3. 4, _. x", "J̌ H̱, İ. Å", "A\x01B c\x01", "\x01", "É, È. ß. ñ, 日本. ا",
]


def test_tokens_equal_the_library():
    import sentencepiece
    from tokenizers import Tokenizer

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for text, (ids, decoded) in zip(TRICKY, pieces.Chunks(path).encode(TRICKY)):
        want = model.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, dtype="<u4").tolist() == want and decoded.decode() == model.decode(want), text
    path = public_tokenizers.path("word_bpe_49k.json")
    plain, words = Tokenizer.from_file(path), packing.WordIds(path)
    for _ in range(2):
        for text, ids in zip(TRICKY, words.encode(TRICKY)):
            assert np.frombuffer(ids, dtype="<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, text
        words.recent, words.older = {"": b""}, words.recent


def test_sentencepiece(session, edge_docs):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for docs in samples(session, edge_docs):
        found = by_id(pieces.encode(docs, path, digests=True))
        for i, t in texts_of(docs):
            ids = model.encode(t, add_bos=True, add_eos=True)
            digests = hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()
            assert any((r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), *digests) for r in found[i])
    row = pieces.encode(docs.limit(1), path).first()
    assert row["n_tokens"] == len(row["ids"]) and row["ids"][0] == 1 and row["ids"][-1] == 2


def test_lm_base_and_held_out(session, edge_docs):
    for docs in samples(session, edge_docs):
        texts = texts_of(docs)
        train = [t for i, t in texts if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
        counts = Counter(w for t in train for w in t.encode().lower().split())
        n, v = sum(counts.values()) + len(train), len(counts) + 1
        found = by_id(lm.score(docs))
        assert sum(map(len, found.values())) == len(texts)
        for i, t in texts:
            words = t.encode().lower().split()
            base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((len(train) + 1) / (n + v + 1))
            known = sum(counts[w] > 0 for w in words) + 1
            assert any(
                abs(r["base_score"] - base) < 1e-6 * abs(base) and (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(words) + 1, known, n)
                for r in found[i]
            )
            for r in found[i]:
                assert r["score"] < 0 and r["held_out"] == (zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2)
    held = [r for rs in found.values() for r in rs if r["held_out"] and r["bits_per_byte"]]
    assert sum(r["bits_per_byte"] for r in held) / len(held) < 4  # spelling at random takes 8


def test_lm_is_a_distribution():
    """Over single letters and the stop sign, bit by bit, all turns together have probability one."""
    code = lm.Code(np.arange(257))
    model = lm.Mixer(code, np.random.default_rng(1).integers(0, 50, (2, sum(lm.SLOTS))).astype(np.float32)).freeze()
    assert abs(sum(2.0 ** -float(s) for s in code.size) - 1) < 1e-9
    whole = model.scores([bytes([c]) for c in range(256)], np.zeros(256)) / 1.0
    assert (whole < 0).all() and (10**whole).sum() < 1


def test_lm_learns_what_repeats():
    words = [b"alpha", b"beta", b"gamma"]
    code = lm.Code(np.bincount(lm.signs_of(words * 50)[0], minlength=257))
    counts = np.zeros((2, sum(lm.SLOTS)), dtype=np.float32)
    bits = lm.Bits(code, words)
    for slot in bits.slots:
        np.add.at(counts[0], slot[~bits.turn], 50)
        np.add.at(counts[1], slot[bits.turn], 50)
    seen, unseen = lm.Mixer(code, counts).freeze().scores([b"alpha", b"aqzpx"], np.zeros(2))
    assert seen > unseen + 2


def test_language_on_known_and_unknown_texts(session, edge_docs):
    docs = table(session, SMALL, "documents")
    found = by_id(language.identify(docs))
    right = sum(found[r["doc_id"]][0]["language"] == r["lang"] for r in docs.collect())
    assert right >= 0.97 * docs.count()
    assert sum(rs[0]["accepted"] for rs in found.values()) >= 0.97 * docs.count()
    edges = by_id(language.identify(edge_docs))
    assert sum(map(len, edges.values())) == edge_docs.count()
    for i in (0, 1, 2):
        assert [(r["language"], r["accepted"]) for r in edges[i]] == [("und", False)]
    kept = language.keep_known(edge_docs)
    assert kept.columns == edge_docs.columns
    assert kept.count() == sum(r["accepted"] for rs in edges.values() for r in rs)


def test_language_weighs_host_and_declaration(session):
    docs = table(session, SMALL, "documents").where("lang IN ('en', 'de')").select("doc_id", "text", "lang", F.concat("lang", F.lit(".example.org")).alias("source"))
    odd = session.createDataFrame([(-1, "zq", None, "de.example.org"), (-2, "zq", None, "en.example.org"), (-3, "zq", "de", None)], docs.schema)
    found = by_id(language.identify(docs.unionByName(odd)))
    assert [found[i][0]["language"] for i in (-1, -2, -3)] == ["de", "en", "de"]
    assert language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).where("language <> 'und'").count() == 0


def test_language_of_pages(session):
    pages = session.createDataFrame(
        [(1, "http://a.example.de/x", '<html lang="de-AT"><body>Hallo <b>Welt</b><script>var a;</script></body></html>'), (2, None, None)],
        "page_id long, url string, html string",
    )
    rows = {r["page_id"]: r for r in language.page_evidence(pages).collect()}
    assert rows[1]["lang"] == "de" and rows[1]["source"] == "a.example.de" and rows[1]["text"].split() == ["Hallo", "Welt"]
    assert rows[2]["text"] == "" and rows[2]["source"] == ""


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def digits(s):
        return re.sub(r"[^0-9]", "", s)

    def luhn(d):
        total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        return total % 10 == 0

    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


def test_base_spans_of_random_texts():
    rng = np.random.default_rng(3)
    signs = list("0123 4.5-@ab+()é\n")
    for _ in range(20_000):
        text = "".join(rng.choice(signs, rng.integers(0, 50)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_pii(session, edge_docs):
    for docs in samples(session, edge_docs):
        found = by_id(pii.detect(docs))
        for i, t in texts_of(docs):
            base = plain_spans(t)
            digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in base).encode()).hexdigest()
            (row, *_) = [r for r in found[i] if r["base_sha256"] == digest]
            spans = [s for s in row["spans"].split(",") if s]
            assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(spans)
            assert [row[f"n_{k}"] for k in pii.BASE_KINDS] == [sum(b[0] == k for b in base) for k in pii.BASE_KINDS]


def test_pii_learns_secrets(session):
    def key(i, n):
        return hashlib.sha256(str(i).encode()).hexdigest()[:n]

    texts = [f"set token = \"{key(i, 40)}\" and go" for i in range(60)] + [f"the password={key(i, 18)} is" for i in range(60)]
    texts += [f"see chapter abcdefgh{i % 10} of version release{i % 7}" for i in range(60)] + ["nothing at all"] * 5
    found = by_id(pii.detect(documents_of(session, texts)))
    assert all(found[i][0]["spans"].startswith("secret:") for i in range(120))
    assert all(found[i][0]["spans"] == "" for i in range(120, len(texts)))
    masked = {r["doc_id"]: r for r in pii.mask(documents_of(session, texts)).collect()}
    assert masked[0]["text"] == 'set token = "<SECRET>" and go' and masked[0]["n_chars"] == len(masked[0]["text"])
    assert masked[130]["text"] == texts[130]


def documents_of(session, texts):
    return session.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")


def test_masking_keeps_everything_else(session, edge_docs):
    out = pii.mask(edge_docs)
    assert out.columns == edge_docs.columns and out.dtypes == edge_docs.dtypes and out.count() == edge_docs.count()
    rows = by_id(out)
    assert rows[0][0]["text"] is None and rows[12][0]["text"] == "mail me: <EMAIL> <PHONE> now" and rows[12][0]["n_chars"] == 28
    assert pii.masked("ab 1.2.3.4 x", [(1, 3, 10), (3, 5, 12)]) == "ab <IP>"


def test_url_rules(session):
    urls_ = [
        "http://EXAMPLE.org/es/x", "http://a.example.org/en/12?q", "http://example.org/en/2", "http://example.org", "http://notexample.org/es/",
        "https://x.com/de/a", "https://x.com/fr/a#b", "https://x.com/en", "https://com/de/", "no scheme", None, "://", "ftp://h?x/y", "http://org:80/", "http://o/" + "a" * 100_000,
    ]
    pages = session.createDataFrame([(i, u, "h") for i, u in enumerate(urls_)], "page_id long, url string, host string")
    got = {r["page_id"]: (r["host"][:20], r["rule"], r["verdict"]) for r in urls.judge(pages).collect()}
    assert got == {
        0: ("example.org", "example.org/es/", "block"), 1: ("a.example.org", "example.org/en/1", "block"), 2: ("example.org", "org/", "allow"),
        3: ("example.org", None, "allow"), 4: ("notexample.org", "org/", "allow"), 5: ("x.com", "com/de/", "block"), 6: ("x.com", "com/fr/", "allow"),
        7: ("x.com", None, "allow"), 8: ("com", "com/de/", "block"), 9: ("", None, "allow"), 10: ("", None, "allow"), 11: ("", None, "allow"),
        12: ("h", None, "allow"), 13: ("org:80", None, "allow"), 14: ("o", None, "allow"),
    }


def test_empty_tables(session, no_docs):
    word, piece = (public_tokenizers.path(p) for p in ("word_bpe_49k.json", "piece_bpe_32k.model"))
    for found in (
        rules.judge(no_docs), rules.keep_good(no_docs), packing.pack(no_docs, word), pieces.encode(no_docs, piece), lm.score(no_docs),
        language.identify(no_docs), language.keep_known(no_docs), pii.detect(no_docs), pii.mask(no_docs),
    ):
        assert found.collect() == []


@pytest.mark.parametrize("name", ["identify", "judge", "detect"])
def test_only_null_texts(session, name):
    docs = session.createDataFrame([(1, None, None, None), (None, None, None, None)], "doc_id long, text string, lang string, source string")
    run = {"identify": language.identify, "judge": rules.judge, "detect": pii.detect}[name]
    assert run(docs).count() == 2
