"""Operator 9: language identification by fusing evidence.

The language of a text is judged from four sources at once: the likelihood of its byte trigrams, the
language declared for it (a markup attribute or a catalogue entry), the suffix of its address, and
what its host usually holds. Host priors are smoothed in steps: a host with few documents leans on
its suffix, a rare suffix on the whole corpus. All counts come from grouped sums over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import query, table, unused
from .text import LOWER, column, runs
from .urls import parts

# Trigrams are counted in this many classes.
CLASSES = 1 << 13
# Neighbouring trigrams repeat one another's evidence, so the likelihood is raised to this power.
TEMPER = 0.3
# Documents that a suffix (a host) weighs against the corpus (its suffix).
PRIOR_WEIGHT = 20.0
# Added to every count of a declared language given the true one.
DECLARED_WEIGHT = 1.0
# Prior of a text in no known language, which is modelled as evenly spread trigrams.
UNKNOWN_PRIOR = 0.01
UNKNOWN = "und"
# A language is accepted at this posterior.
ACCEPTED = 0.6

# An `html` element's lang attribute.
_MARKUP = r"(?i)<html[^>]*\slang\s*=\s*[\"']?([a-z]{2})(?![a-z])"


def _classes(run) -> tuple[np.ndarray, np.ndarray]:
    """Class of every trigram of a run and the text it is in."""
    data = LOWER[run.data].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    keys = ((keys * np.uint32(2654435761)) >> np.uint32(32 - CLASSES.bit_length() + 1)).astype(np.int64)
    doc = np.repeat(np.arange(len(run)), np.diff(run.offsets))
    whole = doc[2:] == doc[:-2]
    return keys[whole], doc[2:][whole]


def declared_language(column_):
    """The two-letter primary tag of a declared language, or null. At most 676 values."""
    tag = F.regexp_extract(F.lower(F.trim(column_.cast("string"))), r"^([a-z]{2})(?:$|[-_])", 1)
    return F.when(tag != "", tag)


def suffix_of(host):
    """The last label of a dotted host, else the empty text."""
    return F.regexp_extract(F.coalesce(host, F.lit("")), r"\.([^.:]+)(?::[0-9]+)?$", 1)


class Model:
    """Trigram likelihoods of the languages found among the declared ones."""

    def __init__(self, languages: list[str], counts: np.ndarray, docs: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=1, keepdims=True)
        logs = np.log((counts + 0.5) / (total + 0.5 * CLASSES))
        flat = np.full((1, CLASSES), -math.log(CLASSES))
        self.logs = np.vstack([logs, flat]).astype(np.float32)  # the last one is the unknown language
        self.docs = docs

    def score(self, run) -> np.ndarray:
        """Tempered log-likelihood of each text under each language."""
        keys, doc = _classes(run)
        out = np.zeros((len(run), len(self.logs)))
        for at in range(0, len(run), 256):  # bounded tables of counts
            low, high = np.searchsorted(doc, [at, at + 256])
            n = min(256, len(run) - at)
            cells = np.bincount((doc[low:high] - at) * CLASSES + keys[low:high], minlength=n * CLASSES)
            out[at : at + n] = cells.reshape(n, CLASSES).astype(np.float32) @ self.logs.T
        return TEMPER * out


def learn(rows: DataFrame) -> Model:
    """Counts over all rows (text, declared). Each task sums its texts, then the sums are added up.

    The result has one row of 8,192 counts per declared language, 676 languages at most.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            tags = column(batch, "declared").to_pylist()
            for run in runs(column(batch, "text")):
                keys, doc = _classes(run)
                tag = tags[run.first : run.first + len(run)]
                names = sorted({t for t in tag if t})
                place = {t: i for i, t in enumerate(names)}
                index = np.array([place.get(t, len(names)) for t in tag], dtype=np.int64)
                cells = np.bincount(index[doc] * CLASSES + keys, minlength=(len(names) + 1) * CLASSES)
                for t, row in zip(names, cells.reshape(-1, CLASSES)):
                    totals[t] = totals.get(t, 0) + row
                    docs[t] = docs.get(t, 0) + tag.count(t)
        for t, row in totals.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array([t] * (len(at) + 1)), pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(row[at], docs[t]), pa.int64())],
                names=["declared", "place", "n"],
            )

    sums = rows.select("declared", "text").where("declared IS NOT NULL").mapInArrow(work, "declared string, place int, n bigint")
    found = sums.groupBy("declared", "place").agg(F.sum("n").alias("n")).toArrow()
    tags = found.column("declared").to_pylist()
    languages = sorted(set(tags))
    index = {t: i for i, t in enumerate(languages)}
    counts = np.zeros((len(languages), CLASSES + 1))
    lines = np.array([index[t] for t in tags], dtype=np.int64)
    counts[lines, found.column("place").to_numpy().astype(np.int64)] = found.column("n").to_numpy()
    return Model(languages, counts[:, :-1], counts[:, -1])


def _scored(rows: DataFrame, model: Model, keep: Sequence[str]) -> DataFrame:
    """The columns `keep`, scores (one per language, the unknown last) and whether the text has a word."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    out = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, words = [], []
            for run in runs(column(batch, "text")):
                blocks.append(shared.value.score(run))
                words.append(run.words().counts > 0)
            if not blocks:
                continue
            scores = np.vstack(blocks)
            flat = pa.array(scores.ravel())
            offsets = pa.array(np.arange(len(scores) + 1, dtype=np.int32) * scores.shape[1])
            yield pa.RecordBatch.from_arrays(
                [*[column(batch, c) for c in keep], pa.ListArray.from_arrays(offsets, flat), pa.array(np.concatenate(words))],
                names=[*keep, "scores", "has_words"],
            )

    found = rows.select(*keep, "text").mapInArrow(work, f"{out}, scores array<double>, has_words boolean")
    return found.withColumn("text_place", F.expr("cast(array_position(scores, array_max(scores)) - 1 AS int)"))


def _priors(scored: DataFrame, n: int) -> tuple[DataFrame, list]:
    """(host, prior of each language) for every host, and log P(declared | language) for every declared language."""
    known = scored.where(f"has_words AND text_place < {n}")
    by_host = known.groupBy("host", "suffix", "declared", "text_place").count()
    by_host = cut_lineage(by_host.select("host", "suffix", "declared", "text_place", F.col("count").alias("n")))
    one = [F.sum(F.when(F.col("text_place") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(n)]
    total = by_host.agg(F.lit(0), *one).first()
    corpus = sum(v or 0 for v in total[1:])
    base = [((total[f"n{i}"] or 0) + 1.0) / (corpus + n) for i in range(n)]

    def smoothed(groups: DataFrame, above: list, name: str) -> DataFrame:
        size = sum((F.col(f"n{i}") for i in range(n)), F.lit(0))
        shares = [(F.col(f"n{i}") + PRIOR_WEIGHT * above[i]) / (size + PRIOR_WEIGHT) for i in range(n)]
        return groups.withColumn(name, F.array(*shares) if shares else F.expr("array(cast(0 AS double))"))

    suffixes = smoothed(by_host.groupBy("suffix").agg(*one or [F.lit(0)]), [F.lit(b) for b in base], "above").select("suffix", "above")
    hosts = by_host.groupBy("host", "suffix").agg(*one or [F.lit(0)]).join(suffixes, "suffix")
    hosts = smoothed(hosts, [F.col("above")[i] for i in range(n)], "prior").select(F.col("host").alias("prior_host"), "prior")
    # At most 676 x 676 rows.
    pairs = by_host.where("declared IS NOT NULL").groupBy("declared", "text_place").agg(F.sum("n").alias("n")).collect()
    tags = sorted({r["declared"] for r in pairs})
    seen = {(r["declared"], r["text_place"]): r["n"] for r in pairs}
    size = [sum(seen.get((t, i), 0) for t in tags) for i in range(n)]
    logs = {
        t: [math.log((seen.get((t, i), 0) + DECLARED_WEIGHT) / (size[i] + DECLARED_WEIGHT * (len(tags) + 1))) for i in range(n)]
        for t in tags
    }
    return hosts, [base, logs]


def _fused(scored: DataFrame, languages: list[str], hosts: DataFrame, known: list) -> DataFrame:
    """Adds language, posterior and accepted."""
    base, logs = known
    n = len(languages)
    rows = scored.join(hosts, scored["host"].eqNullSafe(hosts["prior_host"]), "left").drop("prior_host")
    prior = F.coalesce(F.col("prior"), F.array(*[F.lit(b) for b in base]) if n else F.expr("array(cast(0 AS double))"))
    unseen = F.array(*[F.lit(0.0)] * max(n, 1))
    table_ = F.create_map(*[x for t, v in logs.items() for x in (F.lit(t), F.array(*[F.lit(y) for y in v]))]) if logs else None
    rows = rows.withColumn("prior", prior).withColumn("declares", F.coalesce(table_[F.col("declared")], unseen) if logs else unseen)
    share = math.log(1 - UNKNOWN_PRIOR)
    fused = F.expr(
        f"transform(scores, (s, i) -> s + IF(i < {n}, ln(prior[i]) + declares[i] + {share}D, {math.log(UNKNOWN_PRIOR)}D))"
    )
    rows = rows.withColumn("fused", fused).withColumn("top", F.array_max("fused"))
    rows = rows.withColumn("place", F.expr("cast(array_position(fused, top) - 1 AS int)"))
    rows = rows.withColumn("posterior", F.expr("1D / aggregate(fused, 0D, (a, f) -> a + exp(f - top))"))
    names = F.array(*[F.lit(x) for x in [*languages, UNKNOWN]])
    rows = rows.withColumn("language", F.when(F.col("has_words"), F.get(names, F.col("place"))).otherwise(UNKNOWN))
    rows = rows.withColumn("text_language", F.when(F.col("has_words"), F.get(names, F.col("text_place"))).otherwise(UNKNOWN))
    rows = rows.withColumn("posterior", F.when(F.col("has_words"), F.col("posterior")).otherwise(0.0))
    return rows.withColumn("accepted", (F.col("language") != UNKNOWN) & (F.col("posterior") >= ACCEPTED))


def _evidence(docs: DataFrame, text: str, declared: str | None, host: str | None) -> list:
    body = docs[text].cast("string")
    tag = declared_language(docs[declared]) if declared else F.lit(None).cast("string")
    markup = F.when(F.instr(body, "<") > 0, F.regexp_extract(body, _MARKUP, 1))
    tag = F.coalesce(F.lower(F.when(markup != "", markup)), tag)
    name = docs[host].cast("string") if host else F.lit("")
    return [body.alias("text"), tag.alias("declared"), name.alias("host"), suffix_of(name).alias("suffix")]


def identify(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", declared: str | None = "lang", host: str | None = "source",
) -> DataFrame:
    """One row per document: id, declared, text_language, language, posterior, accepted.

    A declaration counts by its two-letter primary tag (an `html` element in the text
    outranks the column), anything else as none. Texts without a word (null and empty ones too) are
    `und` with posterior 0 and are not accepted. Without any declared language all texts are `und`.
    Equal posteriors go to the language first in the alphabet. Rows with the same id are judged one by one.
    """
    (ids,) = unused(docs.limit(0).select(F.lit(0).alias("text"), F.lit(0).alias("declared"), F.lit(0).alias("host")), "id")
    rows = docs.select(docs[doc_id].alias(ids), *_evidence(docs, text, declared, host))
    model = learn(rows)
    scored = cut_lineage(_scored(rows, model, [ids, "declared", "host", "suffix"]))
    found = _fused(scored, model.languages, *_priors(scored, len(model.languages)))
    return found.select(F.col(ids).alias(doc_id), "declared", "text_language", "language", "posterior", "accepted")


def keep_known(docs: DataFrame, text: str = "text", declared: str | None = "lang", host: str | None = "source") -> DataFrame:
    """The documents whose language `identify` accepts, with all their columns as they were."""
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), *_evidence(docs, text, declared, host))
    model = learn(rows)
    small = _scored(rows, model, ["declared", "host", "suffix"])
    priors = _priors(small, len(model.languages))
    found = _fused(_scored(rows, model, ["row", "declared", "host", "suffix"]), model.languages, *priors)
    return found.where("accepted").select("row.*")


def page_evidence(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, text, lang, source of web pages: text without markup, declared language, host."""
    body = F.coalesce(pages[html].cast("string"), F.lit(""))
    bare = F.regexp_replace(body, r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    bare = F.regexp_replace(bare, r"(?s)<[^>]*>", " ")
    host, _ = parts(pages[url])
    return pages.select(
        pages[page_id], bare.alias("text"), F.regexp_extract(body, _MARKUP, 1).alias("lang"), host.alias("source")
    )


@query("op9_language_id")
def op9(spark, folder):
    """The language of every document."""
    return identify(table(spark, folder, "documents"))


@query("language_of_pages")
def pages_language(spark, folder):
    """The same for web pages, with their declared language, address suffix and host."""
    return identify(page_evidence(table(spark, folder, "pages")), "page_id")
