"""Operator 4: quality rules by host.

Every document is measured (words, symbols, repeated lines and word windows) and put to some rules.
The failures of each rule are summed by host, the rates of a host are drawn towards what is usual
among all hosts by a beta prior fitted to the hosts' own rates, and the verdict on the host is joined
back to its documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import query, table, unused
from .text import column, runs, sequence_hash, sums

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 8

_SYMBOL = np.zeros(256, dtype=np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_SEPARATORS = " \t\n\x0b\x0c\r".encode()

# Rules beside the base rules, over the measures.
HOST_RULES = {
    "symbols": "n_words > 0 AND 10 * n_symbols > n_words",
    "lines": "n_dup_lines > 0 AND 4 * n_dup_lines > n_words",
    "long_words": "n_words > 0 AND (word_chars > 15 * n_words OR word_chars < 2 * n_words)",
    "repeats": "n_words > 0 AND 10 * n_repeat_words > n_words",
}
# A host whose rate for a rule is surely above this is refused that rule's leniency, see `judge`.
STRICT_RATE = 0.5
# A host nearly all of whose documents fail the base rules is refused whole.
REFUSED_RATE = 0.95


def _repeats(words) -> np.ndarray:
    """Words of each text that lie in a window found twice or more in the text."""
    doc, out = words.doc, np.zeros(len(words.run), dtype=np.int64)
    if len(words) < WINDOW:
        return out
    windows = sequence_hash(words.fingerprints(), WINDOW)
    whole = np.flatnonzero(doc[: len(windows)] == doc[WINDOW - 1 :])
    keys = windows[whole] + doc[whole].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    twin = np.zeros(len(ranked) + 1, dtype=bool)
    twin[1:-1] = ranked[1:] == ranked[:-1]
    again = whole[order[twin[:-1] | twin[1:]]]
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    return np.bincount(doc, weights=np.cumsum(cover[:-1]) > 0, minlength=len(out)).astype(np.int64)


def _duplicate_lines(text: bytes) -> int:
    counts = Counter(text.split(b"\n"))
    return sum(n - 1 for line, n in counts.items() if n > 1 and line.strip(_SEPARATORS))


def measures(run) -> dict[str, np.ndarray]:
    words = run.words()
    data = run.data
    letters = words._inside & ((data & 0xC0) != 0x80)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": sums(letters, run.offsets),
        "n_symbols": sums(_SYMBOL[data], run.offsets),
        "n_dup_lines": np.array([_duplicate_lines(t) for t in run.texts()], dtype=np.int64),
        "n_repeat_words": _repeats(words),
    }


def measure(docs: DataFrame, keep: list[str], text: str = "text", prefix: str = "") -> DataFrame:
    """The columns `keep` and the measures of every text, whose names get `prefix`."""
    names = [prefix + m for m in MEASURES]
    kept = [docs[c] for c in keep]
    (body,) = unused(docs.select(*kept), "body")
    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema] + [f"`{n}` bigint" for n in names])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = column(batch, body)
            parts = [measures(run) for run in runs(texts)]
            arrays = [column(batch, c) for c in keep]
            for m in MEASURES:
                arrays.append(pa.array(np.concatenate([p[m] for p in parts]) if parts else [], type=pa.int64()))
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *names])

    return docs.select(*kept, docs[text].cast("string").alias(body)).mapInArrow(work, out)


def base_failed(prefix: str = "") -> str:
    w, r = f"`{prefix}n_words`", f"`{prefix}n_repeat_words`"
    return f"({w} < 20 OR 100 * {r} > 30 * {w})"


def host_rates(rows: DataFrame, host: str) -> DataFrame:
    """host, docs and, for every rule, the rate of failures after shrinking.

    The prior of a rule is Beta(a, b). Its mean is the rate over all documents; its weight a + b
    comes from the spread of the hosts' raw rates beyond what chance makes (method of moments,
    hosts weighted alike), between 1 and 1,000 documents. A host with few documents is thus
    judged mostly like the rest. Hosts are rows, never gathered; a null host is a host too.
    """
    rules = {"base": base_failed(), **HOST_RULES}
    hosts = rows.groupBy(host).agg(
        F.count("*").alias("docs"), *[F.sum(F.expr(f"int({r})")).alias(n) for n, r in rules.items()]
    )
    hosts = cut_lineage(hosts)
    # One row of figures over the hosts.
    over = hosts.agg(
        F.sum("docs").alias("all_docs"), F.count("*").alias("hosts"), F.avg(1 / F.col("docs")).alias("inverse"),
        *[F.sum(n).alias(f"{n}_all") for n in rules],
        *[F.var_pop(F.col(n) / F.col("docs")).alias(f"{n}_var") for n in rules],
    ).first()
    out = [F.col(host), F.col("docs")]
    for n in rules:
        mean = (over[f"{n}_all"] or 0) / over["all_docs"] if over["all_docs"] else 0.0
        chance = mean * (1 - mean) * (over["inverse"] or 0.0)
        extra = (over[f"{n}_var"] or 0.0) - chance
        weight = 1000.0 if extra <= 0 else min(1000.0, max(1.0, mean * (1 - mean) / extra - 1))
        out.append(((F.col(n) + mean * weight) / (F.col("docs") + weight)).alias(f"{n}_rate"))
    return hosts.select(*out)


def verdicts(rates: DataFrame, host: str) -> DataFrame:
    """host, refused, and for each further rule whether the host is held to it strictly."""
    return rates.select(
        host, (F.col("base_rate") > REFUSED_RATE).alias("host_refused"),
        *[(F.col(f"{n}_rate") > STRICT_RATE).alias(f"strict_{n}") for n in HOST_RULES],
    )


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """One row per document: id, measures, base_failed, host_refused, kept.

    A document that fails a base rule goes. Of the others, all documents of a refused host go (its
    shrunk rate of base failures is above 0.95), and so do documents that fail a further rule on a host whose
    shrunk rate for that rule is above one half, where failing is the custom and not an accident;
    elsewhere a failed further rule is forgiven. Null and empty texts have no words and fail. Rows
    with the same id are judged one by one. An empty table gives an empty result.
    """
    ids, hosts = unused(docs.select(text), "doc_id", "host")
    narrow = docs.select(docs[doc_id].alias(ids), docs[host].cast("string").alias(hosts), docs[text].alias("text"))
    rows = cut_lineage(measure(narrow, [ids, hosts]))
    found = _decide(rows, hosts)
    return found.select(
        F.col(ids).alias(doc_id), *MEASURES, "base_failed", F.col("host_refused"), "kept"
    )


def _decide(rows: DataFrame, host: str, of_hosts: DataFrame | None = None) -> DataFrame:
    found = verdicts(host_rates(rows if of_hosts is None else of_hosts, host), host).withColumnRenamed(host, "verdict_host")
    joined = rows.join(found, rows[host].eqNullSafe(found["verdict_host"]), "left")
    failed = F.expr(base_failed())
    strictly = " OR ".join(f"(strict_{n} AND {r})" for n, r in HOST_RULES.items())
    return joined.withColumn("base_failed", failed).withColumn("kept", ~failed & ~F.col("host_refused") & ~F.expr(f"({strictly})"))


def keep_good(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The documents that `judge` keeps, with all their columns as they were.

    Only host figures are shuffled; the documents are measured once more as they stream by and are
    met by the verdict on their host.
    """
    hosts, row = unused(docs, "host", "row")
    rows = docs.select(docs[host].cast("string").alias(hosts), docs[text].alias("text"))
    figures = measure(rows, [hosts])
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias(row), docs[host].cast("string").alias(hosts), docs[text].alias("text"))
    found = _decide(measure(packed, [row, hosts]), hosts, figures)
    return found.where("kept").select(f"{row}.*")


@query("op4_quality_rules")
def op4(spark, folder):
    """Every document judged by the base rules and by its host's record."""
    return judge(table(spark, folder, "documents"))
