"""Operator 2: a quality classifier by nearest-neighbour voting.

Texts become counts of hashed byte trigrams and a few marks of their make-up (repeated words and
lines, capitals, signs, length). A truncated singular value decomposition of a sample of labelled
texts gives latent axes. The labelled sample's latent vectors go to every task, which computes the
cosines of all its documents with all of them, block by block, and lets the nearest ones vote.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import query, remainder, table
from .text import LOWER, column, mix, runs, sums

# Labelled documents of either label that the classifier is fitted to (those with the smallest hash of the id).
SAMPLE_PER_LABEL = 2000
CLASSES = 2048
AXES = 64
NEIGHBOURS = 32
# Cosines are raised to this power, so that close neighbours weigh much more.
SHARPNESS = 4.0
PREDICTED = 0.3
# Weight of every mark against the length of the trigram part, which is 1.
MARK = 0.35

_SIGNS = np.zeros(256, dtype=bool)
_SIGNS[[ord(c) for c in "#*$%&|<>!{}[]=_~^\\@"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
# Steps of the marks; a value counts for the number of steps it has reached.
_SHARES = np.array([0.001, 0.01, 0.03, 0.06, 0.1, 0.2, 0.3, 0.45, 0.6, 0.75, 0.9])
_SIZES = np.array([1, 3, 8, 20, 50, 120, 300, 1000, 3000])
MARKS = 7 * (len(_SHARES) + 1) + len(_SIZES) + 1
WIDTH = CLASSES + MARKS


def _again(keys: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """Per group, how many keys equal an earlier one of the group."""
    order = np.lexsort((keys, group))
    k, g = keys[order], group[order]
    twin = (k[1:] == k[:-1]) & (g[1:] == g[:-1])
    return np.bincount(g[1:][twin], minlength=groups)


def features(run) -> np.ndarray:
    """One row per text: damped trigram counts of length 1, then marks of its make-up."""
    n = len(run)
    out = np.zeros((n, WIDTH), dtype=np.float32)
    data = run.data
    size = np.diff(run.offsets)
    if len(data) >= 3:
        low = LOWER[data].astype(np.uint32)
        keys = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
        keys = ((keys * np.uint32(2654435761)) >> np.uint32(33 - CLASSES.bit_length())).astype(np.int64)
        doc = np.repeat(np.arange(n), size)
        whole = doc[2:] == doc[:-2]
        cells = np.bincount((doc[2:] * CLASSES + keys)[whole], minlength=n * CLASSES)
        damped = np.log1p(cells.reshape(n, CLASSES)).astype(np.float32)
        damped /= np.maximum(np.linalg.norm(damped, axis=1, keepdims=True), 1e-6)
        out[:, :CLASSES] = damped
    words = run.words()
    prints = words.fingerprints()
    count = words.counts
    line = sums(data == 10, run.offsets) + 1
    # Lines: sums of their words' prints; the line of a word from the line ends before it.
    ends = np.concatenate([[0], np.cumsum(data == 10)])
    number = ends[words.starts]
    new = np.ones(len(words), dtype=bool)
    new[1:] = (number[1:] != number[:-1]) | (words.doc[1:] != words.doc[:-1])
    at = np.flatnonzero(new)
    place = (np.arange(len(words)) - np.repeat(at, np.diff(np.append(at, len(words))))).astype(np.uint64)
    of_lines = np.add.reduceat(mix(prints + place), at) if len(at) else np.zeros(0, dtype=np.uint64)
    next_same = (prints[1:] == prints[:-1]) & (words.doc[1:] == words.doc[:-1])
    doc_of_next = words.doc[1:][next_same]
    several, letters = np.maximum(count, 1), np.maximum(size, 1)
    shares = [
        np.bincount(doc_of_next, minlength=n) / several,
        _again(prints, words.doc, n) / several,
        _again(of_lines, words.doc[at], n) / np.maximum(line, 1),
        sums(_SIGNS[data], run.offsets) / letters,
        sums(_UPPER[data], run.offsets) / letters,
        sums(_DIGIT[data], run.offsets) / letters,
        line / several,
    ]
    start = CLASSES
    for values, steps in [*[(s, _SHARES) for s in shares], (count, _SIZES)]:
        out[np.arange(n), start + np.searchsorted(steps, values, side="right")] = MARK
        start += len(steps) + 1
    return out


class Voters:
    """Latent axes and the labelled sample's vectors on them."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray, share: float):
        self.share = share  # of label 1 among the training labels
        self.one_sided = len(labels) == 0 or labels.min() == labels.max()
        if self.one_sided:
            return
        rows = rows.astype(np.float64)
        self.middle = rows.mean(axis=0)
        centred = rows - self.middle
        values, axes = np.linalg.eigh(centred.T @ centred)
        self.axes = axes[:, ::-1][:, : min(AXES, len(rows))].astype(np.float32)
        self.middle = self.middle.astype(np.float32)
        self.vectors = self.latent(rows.astype(np.float32))
        # A vote weighs as much as its label is more frequent among all labels than in the sample.
        ones = labels.mean()
        self.weight = np.where(labels == 1, share / ones, (1 - share) / (1 - ones)).astype(np.float32)
        self.label = labels.astype(np.float32)

    def latent(self, rows: np.ndarray) -> np.ndarray:
        out = (rows - self.middle) @ self.axes
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-6)

    def score(self, rows: np.ndarray) -> np.ndarray:
        if self.one_sided:
            return np.full(len(rows), self.share)
        out = np.empty(len(rows))
        k = min(NEIGHBOURS, len(self.vectors))
        for a in range(0, len(rows), 256):
            cosines = self.latent(rows[a : a + 256]) @ self.vectors.T
            near = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosines, near, axis=1), 1e-3) ** SHARPNESS * self.weight[near]
            out[a : a + 256] = (votes * self.label[near]).sum(axis=1) / votes.sum(axis=1)
        return np.clip(out, 0.0, 1.0)


def _rows(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for run in runs(column(batch, "text"), 1 << 19):
        yield features(run)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, modulus: int, per_label: int = SAMPLE_PER_LABEL) -> Voters:
    """Voters from labelled documents whose crc32 of the id does not leave remainder 0.

    The share of either label is taken over all of these labels; the texts are at most `per_label` per label.
    """
    known = labels.where(labels[label].isin(0, 1)).select(labels[doc_id].alias("id"), labels[label].cast("int").alias("label"))
    known = known.where((remainder(known["id"], modulus) != 0) & F.col("id").isNotNull())
    known = known.groupBy("id").agg(F.max("label").alias("label"))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    share = counts.get(1, 0) / sum(counts.values()) if counts else 0.5
    chosen = []
    for value in counts:
        chosen += known.where(F.col("label") == value).orderBy(F.xxhash64("id"), "id").limit(per_label).collect()
    spark = docs.sparkSession
    picked = spark.createDataFrame(chosen, known.schema) if chosen else known.limit(0)
    texts = docs.select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text")).join(F.broadcast(picked), "id")
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text"))  # of several texts with an id
    texts = texts.groupBy("id", "label").agg(one.getField("text").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = list(_rows(batch))
            if blocks:
                vectors = [r.tobytes() for r in np.vstack(blocks)]
                yield pa.RecordBatch.from_arrays([column(batch, "id"), column(batch, "label"), pa.array(vectors, pa.binary())], names=["id", "label", "v"])

    id_type = known.schema["id"].dataType.simpleString()
    found = texts.select("id", "label", "text").mapInArrow(work, f"id {id_type}, label int, v binary").collect()
    found.sort(key=lambda r: (r["id"], r["v"]))
    rows = np.frombuffer(b"".join(r["v"] for r in found), dtype=np.float32).reshape(-1, WIDTH)
    return Voters(rows, np.array([r["label"] for r in found], dtype=int), share)


def classify(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", modulus: int = 5,
) -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    Labels of documents whose crc32 of the id is divisible by `modulus` are never looked at
    (held_out). Labels other than 0 and 1 are ignored; of several labels for an id the largest holds. Null texts
    count as empty and get a score like any other. With one label only, or none, every score is the
    share of label 1 (0.5 without labels). Rows with the same id are scored one by one.
    """
    voters = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, doc_id, text, label, modulus))
    id_type = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [voters.value.score(rows) for rows in _rows(batch)]
            if scores:
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "id"), column(batch, "held_out"), pa.array(np.concatenate(scores))], names=["id", "held_out", "score"]
                )

    rows = docs.select(
        docs[doc_id].alias("id"), (remainder(docs[doc_id], modulus) == 0).alias("held_out"), docs[text].cast("string").alias("text")
    )
    found = rows.mapInArrow(work, f"id {id_type}, held_out boolean, score double")
    return found.withColumn("predicted", F.expr(f"int(score >= {PREDICTED})")).withColumnRenamed("id", doc_id)


@query("op2_quality_classifier")
def op2(spark, folder):
    """A quality score for every document."""
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
