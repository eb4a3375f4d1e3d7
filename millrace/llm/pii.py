"""Operator 10: personal data by weak supervision.

Fixed patterns find e-mail addresses, IP addresses, cards and phone numbers. Looser candidates
(keys and passwords, personal numbers, phone numbers without a country, veiled e-mail addresses) are
put to labelers: shapes, a gazetteer of key words, the characters around, the make-up of the
characters, the length. Expectation-maximisation over how often each pattern of votes occurs
estimates how reliable each labeler is; a logistic span classifier is then trained, on features the
labelers do not vote on directly, with the estimated labels, and decides on every candidate.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import query, table, unused
from .text import column, runs

# The kinds and their order in results.
BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("secret", "number", "local_phone", "veiled_email")
KINDS = (*BASE_KINDS, *MORE_KINDS)

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match cannot start within a run of digits: the run's first digit would have matched before.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

_SECRET = re.compile(r"(?<![A-Za-z0-9_/+-])[A-Za-z_/+-]*+[0-9][A-Za-z0-9_/+-]*")
_NUMBER = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.(-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9-])")
_VEILED = re.compile(r"(?i)\b[a-z0-9._%+-]{1,64} ?[\[(] ?at ?[\])] ?[a-z0-9-]{1,64} ?[\[(] ?dot ?[\])] ?[a-z]{2,24}\b")

# Fixed values of the gazetteer labeler.
_TELLING = re.compile(
    r"(?i)(?<![a-z])(?:password|passwd|passphrase|pwd|secret|token|api[_ -]?key|access[_ -]?key|private[_ -]?key|bearer|credential"
    r"|contraseña|passwort|mot de passe|ssn|social security|phone|telephone|telefon|teléfono|téléphone|tel|call|mobile|e-?mail|contact)\W{0,4}$"
)
_INNOCENT = re.compile(r"(?i)(?<![a-z])(?:version|license|licence|chapter|section|page|figure|table|isbn|issue|volume|no|vol|cc)\W{0,3}$")
_SHAPES = {
    "secret": re.compile(r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|sk-[A-Za-z0-9]{20,}"),
    "number": re.compile(r"(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}"),
    "local_phone": re.compile(r"\(?[2-9][0-9]{2}\)?.{1,2}[2-9][0-9]{2}.[0-9]{4}"),
    "veiled_email": re.compile(r"(?s).*"),
}
LABELERS = ("shape", "gazetteer", "context", "characters", "length")
# Shortest key-like token that becomes a candidate.
SECRET_LENGTH = 8
# A candidate becomes a span at this probability.
ACCEPTED = 0.5
# Labelers start as this reliable and keep so many votes of that opinion.
START, START_VOTES = 0.8, 20.0


def _emails(text: str) -> list[tuple[int, int]]:
    """The matches of the e-mail pattern, found from each `@` so that long words cost no more than short ones."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        a = at
        while a > free and text[a - 1] in _LOCAL_CHARS:
            a -= 1
        m = _DOMAIN.match(text, at + 1) if a < at else None
        if m:
            out.append((a, m.end()))
            free = m.end()
        else:
            free = at + 1
        at = text.find("@", max(at + 1, free))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed kinds, by kind and start, in code points."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        # A part of many digits is above 255 unless it is padded with zeros.
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 13 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_digits(m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def _candidates(text: str) -> Iterator[tuple[str, int, int]]:
    for m in _SECRET.finditer(text):
        if len(m[0]) >= SECRET_LENGTH and not m[0].replace("-", "").isdigit():
            yield "secret", m.start(), m.end()
    for m in _NUMBER.finditer(text):
        yield "number", m.start(), m.end()
    for m in _LOCAL_PHONE.finditer(text):
        yield "local_phone", m.start(), m.end()
    if "(" in text or "[" in text:
        for m in _VEILED.finditer(text):
            yield "veiled_email", m.start(), m.end()


def _describe(kind: str, text: str, a: int, b: int) -> tuple[str, str]:
    """Votes of the labelers (`+` personal, `-` not, `.` no opinion) and the classifier's features."""
    body, before, after = text[a:b], text[max(0, a - 24) : a], text[b : b + 1]
    n, digits = b - a, sum("0" <= c <= "9" for c in body)
    letters = sum(c.isalpha() for c in body)
    turns = sum(x.isdigit() != y.isdigit() for x, y in zip(body, body[1:]))
    shape = "+" if _SHAPES[kind].fullmatch(body) else "."
    gazetteer = "+" if _TELLING.search(before) else "-" if _INNOCENT.search(before) else "."
    context = "+" if before[-1:] in ("=", ":", '"', "'") or before[-2:] in (": ", "= ") else "."
    if kind == "secret":
        characters = "+" if turns >= 3 else "-" if turns <= 1 else "."
        length = "+" if n >= 16 else "-" if n < 12 else "."
    else:
        characters = "+" if after in ("", " ", "\n", ".", ",", ";", ")") else "-"
        length = "."
    case = "u" if body.isupper() else "l" if body.islower() else "m" if letters else "n"
    edge = "q" if before[-1:] in ('"', "'") else "=" if before[-1:] in ("=", ":") else " " if before[-1:].isspace() or not before else "x"
    features = f"{kind}|{min(n // 6, 7)}|{min(4 * digits // n, 3)}|{case}|{edge}|{min(turns // 3, 4)}"
    return shape + gazetteer + context + characters + length, features


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, str, str]]]:
    """The base spans and the candidates (kind, start, end, votes, features) that touch none of them."""
    base = base_spans(text)
    loose = _candidates(text)
    starts, ends = [], []  # of what is taken, without overlaps
    for _, a, b in sorted(base, key=lambda s: s[1:]):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    more = []
    for kind, a, b in sorted(loose, key=lambda s: (-KINDS.index(s[0]), s[1])):
        at = bisect_right(ends, a)
        if at < len(starts) and starts[at] < b:
            continue
        starts.insert(at, a)
        ends.insert(at, b)
        more.append((kind, a, b, *_describe(kind, text, a, b)))
    return base, more


def _suspects(texts: pa.Array) -> np.ndarray:
    """Texts with a digit, an `@`, or a bracket: others hold nothing that the patterns could match."""
    telling = np.zeros(256, dtype=bool)
    telling[[*range(0x30, 0x3A), ord("@"), ord("("), ord("[")]] = True
    out = []
    for run in runs(texts):
        hits = np.concatenate([[0], np.cumsum(telling[run.data])])
        out.append(hits[run.offsets[1:]] > hits[run.offsets[:-1]])
    return np.concatenate(out) if out else np.zeros(0, dtype=bool)


_FOUND = "base array<struct<kind:int,a:int,b:int>>, more array<struct<kind:int,a:int,b:int,votes:string,features:string>>"
_BASE_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("a", pa.int32()), ("b", pa.int32())]))
_MORE_TYPE = pa.list_(pa.struct([("kind", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("votes", pa.string()), ("features", pa.string())]))


def candidates(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` with the base spans and candidates of every text."""
    fields = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema], _FOUND])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {k: i for i, k in enumerate(KINDS)}
        for batch in batches:
            texts = column(batch, text)
            base, more = [[]] * len(texts), [[]] * len(texts)
            at = np.flatnonzero(_suspects(texts))
            for i, t in zip(at.tolist(), texts.take(pa.array(at)).to_pylist()):
                found, loose = find(t)
                base[i] = [{"kind": place[k], "a": a, "b": b} for k, a, b in found]
                more[i] = [{"kind": place[k], "a": a, "b": b, "votes": v, "features": f} for k, a, b, v, f in loose]
            yield pa.RecordBatch.from_arrays(
                [*[column(batch, c) for c in keep], pa.array(base, _BASE_TYPE), pa.array(more, _MORE_TYPE)], names=[*keep, "base", "more"]
            )

    return docs.select(*keep, *[c for c in [text] if c not in keep]).mapInArrow(work, fields)


def reliabilities(patterns: dict[str, float], rounds: int = 200) -> tuple[float, np.ndarray, dict[str, float]]:
    """EM over patterns of votes and how often each occurs: (share of personal data, P(vote | class), P(personal | pattern)).

    Votes are taken as independent given the class. A prior of START_VOTES votes for each
    labeler keeps few candidates from deciding anything against the labelers' meaning.
    """
    names = sorted(patterns)
    weight = np.array([patterns[p] for p in names], dtype=float)
    votes = np.array([["-.+".index(c) for c in p] for p in names], dtype=int).reshape(len(names), len(LABELERS))
    middle = 0.3
    start = np.array([
        [(1 - START) * (1 - middle), middle, START * (1 - middle)],  # of personal data
        [START * (1 - middle), middle, (1 - START) * (1 - middle)],
    ])
    start = np.repeat(start[:, None, :], len(LABELERS), axis=1)
    table_, share = start.copy(), 0.5
    posterior = np.zeros(len(names))
    for _ in range(rounds):
        logs = np.log(table_)[:, np.arange(len(LABELERS)), votes].sum(axis=2)
        gap = logs[0] + np.log(share) - logs[1] - np.log(1 - share)
        new = 1 / (1 + np.exp(-np.clip(gap, -500, 500)))
        counts = np.zeros_like(table_)
        for c, w in enumerate((weight * new, weight * (1 - new))):
            for j in range(len(LABELERS)):
                counts[c, j] = np.bincount(votes[:, j], weights=w, minlength=3)
        table_ = counts + START_VOTES * start
        table_ /= table_.sum(axis=2, keepdims=True)
        share = float((weight @ new + 5) / (weight.sum() + 10))
        done = len(new) == 0 or np.abs(new - posterior).max() < 1e-9
        posterior = new
        if done:
            break
    return share, table_, dict(zip(names, posterior.tolist()))


class SpanClassifier:
    """Logistic regression on the parts of a feature text and of a pattern of votes."""

    def __init__(self, rows: list[tuple[str, str, float]], label: dict[str, float], rounds: int = 400):
        self.place: dict[str, int] = {}
        cells, target, weight = [], [], []
        for votes, features, n in rows:
            cells.append([self.place.setdefault(p, len(self.place)) for p in self.parts(votes, features)])
            target.append(label[votes])
            weight.append(n)
        self.weights = np.zeros(len(self.place) + 1)
        if not rows:
            return
        index, y, w = np.array(cells), np.array(target), np.array(weight, dtype=float)
        w /= w.sum()
        power = np.zeros_like(self.weights)
        for _ in range(rounds):  # gradient steps with a scale for each weight
            p = 1 / (1 + np.exp(-self.weights[index].sum(axis=1) - self.weights[-1]))
            gap = w * (p - y)
            gradient = np.bincount(index.ravel(), weights=np.repeat(gap, index.shape[1]), minlength=len(self.weights))
            gradient[-1] = gap.sum()
            gradient += 1e-4 * self.weights
            power += gradient**2
            self.weights -= 0.5 * gradient / np.sqrt(power + 1e-12)

    @staticmethod
    def parts(votes: str, features: str) -> list[str]:
        kind, *rest = features.split("|")
        return [f"v{i}{c}" for i, c in enumerate(votes)] + [f"{kind}|{i}{c}" for i, c in enumerate(rest)]

    def probability(self, votes: str, features: str) -> float:
        total = self.weights[-1] + sum(self.weights[self.place[p]] for p in self.parts(votes, features) if p in self.place)
        return float(1 / (1 + np.exp(-total)))


def train(found: DataFrame) -> SpanClassifier:
    """From the candidates of all documents. Votes and features have a few values each, so the counts
    that come to the driver have at most 3^5 patterns times the sorts of features, whatever the input."""
    each = found.select(F.explode("more").alias("c")).groupBy("c.votes", "c.features").count()
    rows = sorted((r[0], r[1], float(r[2])) for r in each.collect())
    patterns: dict[str, float] = {}
    for votes, _, n in rows:
        patterns[votes] = patterns.get(votes, 0.0) + n
    _, _, label = reliabilities(patterns)
    return SpanClassifier(rows, label)


def _all_spans(base: list[dict], more: list[dict], model: SpanClassifier, memory: dict) -> list[tuple[int, int, int]]:
    out = [(s["kind"], s["a"], s["b"]) for s in base]
    for s in more:
        key = s["votes"], s["features"]
        if key not in memory:
            memory[key] = model.probability(*key) >= ACCEPTED
        if memory[key]:
            out.append((s["kind"], s["a"], s["b"]))
    return sorted(out)


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def detect(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and the digest are of the base spans; `spans` has them and the accepted candidates,
    ordered by kind (email, ip, card, phone, secret, number, local_phone, veiled_email) and start. Null
    and empty texts have none. Rows with the same id are searched one by one. Without candidates in
    the whole table nothing is learned and nothing added.
    """
    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    found = cut_lineage(candidates(rows, ["doc_id"]))
    model = found.sparkSession.sparkContext.broadcast(train(found))
    id_type = docs.schema[doc_id].dataType.simpleString()
    counted = [f"n_{k}" for k in BASE_KINDS]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in batches:
            counts, digests, written = [[] for _ in BASE_KINDS], [], []
            for base, more in zip(column(batch, "base").to_pylist(), column(batch, "more").to_pylist()):
                plain = sorted((s["kind"], s["a"], s["b"]) for s in base)
                for i, c in enumerate(counts):
                    c.append(sum(k == i for k, _, _ in plain))
                digests.append(hashlib.sha256(_written(plain).encode()).hexdigest())
                written.append(_written(_all_spans(base, more, model.value, memory)))
            arrays = [column(batch, "doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests), pa.array(written, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *counted, "base_sha256", "spans"])

    schema = f"doc_id {id_type}, " + ", ".join(f"{c} bigint" for c in counted) + ", base_sha256 string, spans string"
    return found.mapInArrow(work, schema).withColumnRenamed("doc_id", doc_id)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or group of overlapping spans, replaced by the kind of its first one."""
    out, done = [], 0
    joined: list[list[int]] = []
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if joined and a < joined[-1][2]:
            joined[-1][2] = max(joined[-1][2], b)
        else:
            joined.append([k, a, b])
    for k, a, b in joined:
        out += [text[done:a], f"<{KINDS[k].upper()}>"]
        done = b
    return "".join([*out, text[done:]])


def mask(docs: DataFrame, text: str = "text", n_chars: str | None = "n_chars") -> DataFrame:
    """The documents with personal data replaced in their texts and, if there is such a column, n_chars renewed.

    A null text stays null. All other columns and all rows stay as they were.
    """
    body, row = unused(docs, "body", "row")
    texts = docs.select(docs[text].cast("string").alias(body))
    model = docs.sparkSession.sparkContext.broadcast(train(candidates(texts, [], body)))
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias(row), docs[text].cast("string").alias(body))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict = {}
        for batch in batches:
            out = column(batch, body).to_pylist()
            for i in np.flatnonzero(_suspects(column(batch, body))).tolist():
                base, more = find(out[i])
                place = {k: j for j, k in enumerate(KINDS)}
                spans = _all_spans(
                    [{"kind": place[k], "a": a, "b": b} for k, a, b in base],
                    [{"kind": place[k], "a": a, "b": b, "votes": v, "features": f} for k, a, b, v, f in more],
                    model.value, memory,
                )
                out[i] = masked(out[i], spans)
            yield pa.RecordBatch.from_arrays([column(batch, row), pa.array(out, pa.string())], names=[row, body])

    row_type = packed.schema[row].dataType.simpleString()
    done = packed.mapInArrow(work, f"`{row}` {row_type}, `{body}` string")
    size = F.length(body).cast(docs.schema[n_chars].dataType) if n_chars in docs.columns else None
    changed = {text: F.col(body).cast(docs.schema[text].dataType), **({n_chars: size} if size is not None else {})}
    return done.select(*[changed.get(c, F.col(row)[c]).alias(c) for c in docs.columns])


@query("op10_pii")
def op10(spark, folder):
    """Personal data in every document."""
    return detect(table(spark, folder, "documents"))
