"""Operator 5: packing by non-negative least squares.

Documents become token ids, cut into pieces of at most one window. Only the histogram of piece
lengths (as many numbers as a window has tokens) goes to the driver. There, combinations of one to
three lengths that fill a window exactly are listed, their repeat counts solved against the histogram
by non-negative least squares, rounded down, and what is left packed greedily, still as counts. The
plan says which ranks of each length go where; pieces are ranked per length on the cluster.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import query, table
from .text import column

WINDOW = 2048
END_ID = 1
# Words whose ids a task remembers; as many older ones are kept beside them.
REMEMBERED = 300_000
# Rows of one length that are ranked in one task.
RANKED = 100_000
# Combinations that enter the least squares, those of the most frequent lengths first.
COMBINATIONS = 40_000
STEPS = 400


# A mark set between words that are tokenized together.
_MARK = "\x01"
_TOGETHER = 64
# Signs behind something else than a letter or a digit, which may be one token with it.
_RUN_OF_SIGNS = re.compile("[^a-zA-Z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f][.,](?: |$)")
# What keeps A-Z from being lower-cased early: special tokens in capitals, and accents that may join with the letter.
_KEEP_CASE = re.compile("<\\||[\u0300-\u036f]")


class WordIds:
    """Token ids of texts for a tokenizer that lower-cases, drops white space and never joins words across it.

    Words between blanks and line ends are tokenized once each and remembered as bytes, for as long as they
    are among the words met lately. Commas and stops at the end of a word are words of their own here, since
    the tokenizer parts letters and signs.
    """

    _loaded: dict[str, WordIds] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.recent: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        (self.mark,) = self._ids([_MARK])

    @classmethod
    def of(cls, path: str) -> WordIds:
        """The one of this process."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    @staticmethod
    def words(text: str) -> list[str]:
        text = text.replace("\n", " ")
        if not _KEEP_CASE.search(text):
            text = text.encode().lower().decode()  # of bytes: A-Z only
        if not _RUN_OF_SIGNS.search(text):
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text.split(" ")

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _learn(self, words: list[str]) -> None:
        groups = [words[a : a + _TOGETHER] for a in range(0, len(words), _TOGETHER)]
        (mark,) = np.frombuffer(self.mark, dtype="<u4")
        for group, raw in zip(groups, self._ids([f" {_MARK} ".join(g) for g in groups])):
            cuts = np.flatnonzero(np.frombuffer(raw, dtype="<u4") == mark).tolist()
            if len(cuts) + 1 != len(group):  # a word has the mark in it
                self.recent.update(zip(group, self._ids(group)))
                continue
            for word, a, b in zip(group, [-1, *cuts], [*cuts, len(raw) // 4]):
                self.recent[word] = raw[4 * (a + 1) : 4 * b]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian 32 bits."""
        words = [self.words(t) for t in texts]
        if len(self.recent) > REMEMBERED:
            self.recent, self.older = {"": b""}, self.recent
        new = []
        for word in set().union(*words).difference(self.recent):
            known = self.older.get(word)
            if known is None:
                new.append(word)
            else:
                self.recent[word] = known
        for at in range(0, len(new), 10_000):
            self._learn(new[at : at + 10_000])
        get = self.recent.__getitem__
        return [b"".join(map(get, w)) for w in words]


def _portions(texts: list[str], limit: int = 1 << 20) -> Iterator[list[str]]:
    part, size = [], 0
    for t in texts:
        if part and size + len(t) > limit:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def pieces(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens (and ids, as an array, if asked for): the cut documents."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds.of(tokenizer)
        for batch in batches:
            texts = [t or "" for t in column(batch, "text").to_pylist()]
            owner, start, length, crc, whole, ids, at = [], [], [], [], [], [], 0
            for part in _portions(texts):
                for raw in ids_of.encode(part):
                    raw += end
                    n = len(raw) // 4
                    for a in range(0, n, window):
                        cut = raw[4 * a : 4 * (a + window)]
                        owner.append(at)
                        start.append(a)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                        whole.append(n)
                        if with_ids:
                            ids.append(np.frombuffer(cut, dtype="<i4"))
                    at += 1
            arrays = [column(batch, "doc_id").take(pa.array(owner, pa.int64()))]
            arrays += [pa.array(x, pa.int64()) for x in (start, length, crc, whole)]
            if with_ids:
                arrays.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select(docs[doc_id].alias("doc_id"), docs[text].cast("string").alias("text"))
    schema = f"doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
    return rows.mapInArrow(work, schema + (", ids array<int>" if with_ids else ""))


def combinations(counts: np.ndarray, window: int) -> np.ndarray:
    """Rows of three lengths, largest first and 0 for none, that fill a window; the lengths occur."""
    there = counts > 0
    there[0] = False
    lengths = np.flatnonzero(there)
    out = [np.array([[window, 0, 0]])] if window < len(there) and there[window] else []
    two = lengths[(lengths * 2 <= window)]
    two = two[there[window - two]]
    out.append(np.stack([window - two, two, np.zeros_like(two)], axis=1))
    # Of the three, each length is one of the frequent ones or fills up two of them.
    often = lengths[np.argsort(-counts[lengths], kind="stable")][:400]
    a, b = np.meshgrid(often, often)
    a, b = a.ravel(), b.ravel()
    rest = window - a - b
    fits = rest > 0
    a, b, rest = a[fits], b[fits], rest[fits]
    fits = there[rest]
    three = np.unique(np.sort(np.stack([a, b, rest], axis=1)[fits], axis=1)[:, ::-1], axis=0)
    weight = counts[three].min(axis=1) if len(three) else np.zeros(0)
    out.append(three[np.argsort(-weight, kind="stable")][:COMBINATIONS])
    return np.concatenate(out).astype(np.int64)


def solve(combos: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Repeat counts, none negative, that come closest to the histogram (accelerated projected gradient)."""
    n, size = len(combos), len(counts)
    if not n:
        return np.zeros(0)
    inside = combos > 0
    target = counts.astype(float)
    # The squared norm of the matrix, by power iteration.
    v = np.ones(n)
    scale = 1.0
    for _ in range(20):
        made = np.bincount(combos.ravel(), weights=(v[:, None] * inside).ravel(), minlength=size)
        v = (made[combos] * inside).sum(axis=1)
        scale = float(np.linalg.norm(v))
        v /= scale
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(STEPS):
        made = np.bincount(combos.ravel(), weights=(y[:, None] * inside).ravel(), minlength=size)
        gap = made - target
        gap[0] = 0
        step = np.maximum(0.0, y - (gap[combos] * inside).sum(axis=1) / (1.05 * scale))
        u = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = step + (t - 1) / u * (step - x)
        x, t = step, u
    return x


def plan(counts: np.ndarray, window: int) -> list[tuple[list[tuple[int, int]], int]]:
    """[(lengths with how often each, largest first), repeats]: sequences for every piece of the histogram."""
    left = counts.astype(np.int64).copy()
    left[0] = 0
    out = []
    combos = combinations(left.copy(), window)
    times = solve(combos, left)
    for row in np.argsort(-times, kind="stable"):
        n = int(times[row])
        if n < 1:
            break
        used: dict[int, int] = {}
        for length in combos[row]:
            if length:
                used[int(length)] = used.get(int(length), 0) + 1
        n = min([n, *(int(left[k]) // u for k, u in used.items())])
        if n > 0:
            for k, u in used.items():
                left[k] -= n * u
            out.append((sorted(used.items(), reverse=True), n))
    # Greedily: the longest piece, then again and again the longest that still fits.
    lengths = np.flatnonzero(left)
    while len(lengths):
        space, used = window, []
        for k in lengths[::-1].tolist():
            if k <= space:
                u = min(int(left[k]), space // k)
                used.append((k, u))
                space -= k * u
        n = min(int(left[k]) // u for k, u in used)
        for k, u in used:
            left[k] -= n * u
        out.append((used, n))
        lengths = lengths[left[lengths] > 0]
    return out


class Slots:
    """Where the pieces of each length go: ranks from `first` on, `each` of them to a sequence."""

    def __init__(self, planned: list[tuple[list[tuple[int, int]], int]]):
        taken: dict[int, int] = {}
        rows, sequence = [], 0
        for used, n in planned:
            offset = 0
            for length, each in used:
                rows.append((length, taken.get(length, 0), sequence, each, offset))
                taken[length] = taken.get(length, 0) + n * each
                offset += length * each
            sequence += n
        rows.sort()
        self.rows = np.array(rows, dtype=np.int64).reshape(-1, 5)
        self.sequences = sequence

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the piece with this rank among those of its length."""
        keys = (self.rows[:, 0] << 44) + self.rows[:, 1]
        row = self.rows[np.searchsorted(keys, (length << 44) + rank, side="right") - 1]
        q = rank - row[:, 1]
        return row[:, 2] + q // row[:, 3], row[:, 4] + q % row[:, 3] * length


def pack(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids).

    A null or empty text is its end id alone. Rows with the same id are packed one by one. An
    empty table gives no rows.
    """
    cut = cut_lineage(pieces(docs, tokenizer, doc_id, text, window, end_id, with_ids))
    histogram = cut.groupBy("length").count().collect()  # a row per length, no more than the window
    counts = np.zeros(window + 1, dtype=np.int64)
    for length, n in histogram:
        counts[length] = n
    slots = cut.sparkSession.sparkContext.broadcast(Slots(plan(counts, window)))

    # Ranks within a length, from ranks within shares of it.
    shares = max(1, -(-int(counts.sum()) // RANKED))
    rows = cut.withColumn("share", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(shares)))
    sizes = rows.groupBy("length", "share").count()
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "share", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("ahead"))
    order = Window.partitionBy("length", "share").orderBy("doc_id", "start", "ids_crc32")
    ranked = rows.withColumn("within", F.row_number().over(order) - 1).join(sizes, ["length", "share"])
    ranked = ranked.withColumn("rank", F.col("ahead") + F.col("within"))
    columns = cut.columns
    names = [*columns, "sequence_id", "offset"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequence, offset = slots.value.place(column(batch, "length").to_numpy(), column(batch, "rank").to_numpy())
            kept = [column(batch, c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], names=names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    placed = ranked.select(*columns, "rank").mapInArrow(work, f"{fields}, sequence_id bigint, offset bigint")
    return placed.withColumnRenamed("doc_id", doc_id)


@query("op5_packing")
def op5(spark, folder):
    """All documents in sequences of 2,048 tokens."""
    import public_tokenizers

    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
