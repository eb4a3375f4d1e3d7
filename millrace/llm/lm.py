"""Operator 7: scoring by online logistic context mixing.

A text is its words and one end. Every word is spelled out in bits (a Huffman code of its bytes and
a stop sign); each bit is predicted from several hashed contexts of the word so far, the predictions
are mixed in the logistic domain with weights chosen by a gate, and the mixed prediction is refined
by an adaptive table. The bits of a word depend on the word alone, so a word is spelled once, however
often it occurs. The counts behind the whole word so far are exact: words are sorted, so those that
begin alike stand together, and only beginnings that cross an edge between two runs of words are
summed up over runs. The shorter contexts have tables with room for all that occur.

Words (and the end) are then predicted from the word before: the share of the training pairs that
begin with that word, mixed with the score of the word alone. The weight of the latter falls with
the count of the word before as a power law, fitted to the number of pairs that occur once. Pairs
are counted exactly, by 64-bit fingerprints.

How it is spread: documents are cut into blocks. A block lists its distinct words, which are
shuffled by word to be counted and scored, and their figures go back to the block. Its distinct pairs
go out in slices of the fingerprints, one row per block and slice, and their counts come back.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .base import query, remainder, table
from .text import column, mix

# Bytes of text whose distinct words are gathered in one task.
BLOCK_BYTES = 32 << 20
# Words (and bytes) of one run of the sorted words.
RUN_WORDS = 1 << 15
RUN_BYTES = 1 << 19
# Tasks that sum up context counts or learn weights; each one has tables of the same size.
LEARNERS = 16
# Words worked on at once.
STEP_WORDS = 4096

STOP = 256  # the sign behind a word
FALL = 0.3  # the weight of the word alone is a * (count of the word before) ** -FALL
# Slots of each short context, at least: none, one, two and three signs before.
SLOTS = (1 << 12, 1 << 16, 1 << 17, 1 << 18)
ROOM = 4  # slots for each context that occurs
REGISTERS = 12  # bits of a register's place when contexts are counted
INPUTS = len(SLOTS) + 2  # also the whole word so far, and a constant
GATES = 32
BUCKETS = 33
_U = np.uint64


class Code:
    """A Huffman code for 256 bytes and the stop sign: inner nodes passed and turns taken by each."""

    def __init__(self, counts: np.ndarray):
        heap = [(float(c) + 1.0, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        parent: dict[int, tuple[int, int]] = {}
        name = len(counts)
        while len(heap) > 1:
            (a, x), (b, y) = heapq.heappop(heap), heapq.heappop(heap)
            parent[x], parent[y] = (name, 0), (name, 1)
            heapq.heappush(heap, (a + b, name))
            name += 1
        nodes, turns, self.size = [], [], np.zeros(len(counts), dtype=np.int64)
        for sign in range(len(counts)):
            path, at = [], sign
            while at in parent:
                at, turn = parent[at]
                path.append((at - len(counts), turn))
            self.size[sign] = len(path)
            nodes += [p[0] for p in reversed(path)]
            turns += [p[1] for p in reversed(path)]
        self.nodes, self.turns = np.array(nodes, dtype=np.int64), np.array(turns, dtype=bool)
        self.start = np.cumsum(self.size) - self.size


def signs_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All words' bytes, a stop sign behind each, and the length of each with it."""
    data = np.frombuffer(b" ".join(words) + b" ", dtype=np.uint8).astype(np.int64)
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1
    data[np.cumsum(length) - 1] = STOP
    return data, length


_POWER, _NODE = _U(0xD6E8FEB86659FD93), _U(0x9E3779B97F4A7C15)


def beginnings(signs: np.ndarray, length: np.ndarray) -> np.ndarray:
    """A 64-bit fingerprint of the word before each sign."""
    first = np.cumsum(length) - length
    place = np.arange(len(signs)) - np.repeat(first, length)
    with np.errstate(over="ignore"):
        powers = mix(np.arange(int(length.max()), dtype=_U) * _POWER + _U(11)) | _U(1)
        terms = mix((signs + 1).astype(_U)) * powers[place]
        before = np.cumsum(terms) - terms
        return mix(before - np.repeat(before[first], length) + place.astype(_U))


def _paths(code: Code, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of bits of each sign, and where the code lists each bit's node and turn."""
    size = code.size[signs]
    return size, np.repeat(code.start[signs] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


class Bits:
    """The bits of some words: turn taken, word, and slot in the tables for each short context."""

    def __init__(self, code: Code, words: list[bytes], slots: tuple[int, ...] = SLOTS):
        signs, length = signs_of(words)
        first = np.cumsum(length) - length
        place = np.arange(len(signs)) - np.repeat(first, length)
        back = [signs]
        for k in (1, 2, 3):
            past = np.full(len(signs), STOP, dtype=np.int64)
            past[k:] = signs[:-k]
            past[place < k] = STOP
            back.append(past)
        contexts = [
            np.minimum(place, 7).astype(_U),
            back[1].astype(_U) + _U(1000),
            (back[1] * 257 + back[2]).astype(_U) + _U(100_000),
            ((back[1] * 257 + back[2]) * 257 + back[3]).astype(_U) + _U(10_000_000),
        ]
        size, at = _paths(code, signs)
        self.node, self.turn = code.nodes[at], code.turns[at]
        self.word = np.repeat(np.repeat(np.arange(len(words)), length), size)
        self.keys = [mix(np.repeat(mix(context), size) + self.node.astype(_U) * _NODE) for context in contexts]
        self.slots, base = [], 0
        for key, n in zip(self.keys, slots):
            self.slots.append((key >> _U(65 - n.bit_length())).view(np.int64) + base)
            base += n


class Begun:
    """How often the words that begin alike took each turn, for every bit of a run of sorted words.

    `shared` has (beginning, sign, count) of beginnings that other runs have as well.
    """

    def __init__(self, code: Code, words: list[bytes], counts: np.ndarray, shared: tuple[np.ndarray, np.ndarray, np.ndarray]):
        signs, length = signs_of(words)
        starts, sums, place = _summed(beginnings(signs, length), signs, np.repeat(counts, length))
        heads, next_, often = shared
        crossing = np.isin(starts[0], heads)
        here = np.isin(heads, starts[0][crossing])
        begin = np.concatenate([starts[0], heads[here]])
        sign = np.concatenate([starts[1], next_[here]])
        weight = np.concatenate([np.where(crossing, 0, sums), often[here]])
        size, at = _paths(code, sign)
        turn, weight = code.turns[at], np.repeat(weight, size)
        _, cell = np.unique(mix(np.repeat(begin, size) + code.nodes[at].astype(_U) * _NODE), return_inverse=True)
        no = np.bincount(cell, weights=weight * ~turn)[cell].astype(np.float32)
        yes = np.bincount(cell, weights=weight * turn)[cell].astype(np.float32)
        edge = np.cumsum(size) - size
        size = size[place]
        ends = np.append(0, np.cumsum(size))
        at = np.repeat(edge[place] - ends[:-1], size) + np.arange(ends[-1])
        self.no, self.yes = no[at], yes[at]
        self.first = ends[np.append(0, np.cumsum(length))]

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(no, yes) at the bits of the words at these places."""
        size = self.first[places + 1] - self.first[places]
        at = np.repeat(self.first[places] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return self.no[at], self.yes[at]


def _summed(begin: np.ndarray, signs: np.ndarray, weight: np.ndarray):
    """Distinct (beginning, sign), the sum of each, and the place of every row in them."""
    _, first, place = np.unique(mix(begin + signs.astype(_U) * _POWER), return_index=True, return_inverse=True)
    return (begin[first], signs[first]), np.bincount(place, weights=weight), place


class Mixer:
    """The trained model: counts of turns per slot, weights per gate, refinements."""

    def __init__(self, code: Code, counts: np.ndarray, slots: tuple[int, ...] = SLOTS):
        self.code, self.slots = code, slots
        self.counts = counts  # float32, (turns, slots)
        self.weights = np.zeros((GATES, INPUTS))
        self.weights[:, 2:4] = 0.3
        self.weights[:, 4] = 0.5
        self.refine = None  # probability of turn 1 per node and bucket
        self.known = 0.0  # share of the word counts in the last mixture
        self.tokens = 0  # words counted
        self.stretched = None

    @staticmethod
    def _stretch(no: np.ndarray, yes: np.ndarray) -> np.ndarray:
        return np.clip(np.log((yes + np.float32(0.4)) / (no + np.float32(0.4))), -12, 12)

    @staticmethod
    def _gate(three: np.ndarray, whole: np.ndarray) -> np.ndarray:
        """By how often the two longest contexts were seen."""
        return np.minimum(np.log2(whole + 1), 7).astype(np.uint8) * np.uint8(4) + np.minimum(np.log2(three + 1) / 4, 3).astype(np.uint8)

    def freeze(self) -> Mixer:
        """Keep what scoring needs of the counts: the stretched prediction and the gate's part of every slot."""
        no, yes = self.counts
        self.stretched = self._stretch(no, yes).astype(np.float32)
        three = (no + yes)[-self.slots[-1] :]
        self.gates = self._gate(three, np.zeros_like(three))
        self.counts = None
        return self

    def inputs(self, bits: Bits, begun: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions (one row per context, then a constant) and the gate of every bit."""
        stretched = np.empty((INPUTS, len(bits.turn)), dtype=np.float32)
        stretched[-1] = 0.3
        for i, slot in enumerate(bits.slots):
            stretched[i] = self.stretched[slot]
        stretched[-2] = self._stretch(*begun)
        whole = begun[0] + begun[1]
        return stretched, self.gates[bits.slots[-1] - sum(self.slots[:-1])] + self._gate(np.zeros_like(whole), whole)

    def inputs_without(self, bits: Bits, begun: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The same while learning: one occurrence of the word itself is taken out of the counts."""
        stretched = np.empty((INPUTS, len(bits.turn)), dtype=np.float32)
        stretched[-1] = 0.3
        seen = []
        for i, (no, yes) in enumerate([*((self.counts[0][slot], self.counts[1][slot]) for slot in bits.slots), begun]):
            no, yes = np.maximum(no - ~bits.turn, 0), np.maximum(yes - bits.turn, 0)
            stretched[i] = self._stretch(no, yes)
            if i >= len(bits.slots) - 1:
                seen.append(no + yes)
        return stretched, self._gate(*seen)

    def mixed(self, stretched: np.ndarray, gate: np.ndarray) -> np.ndarray:
        total = np.zeros(len(gate))
        for i in range(INPUTS):
            total += self.weights[gate, i] * stretched[i]
        return np.clip(total, -11.5, 11.5)

    @staticmethod
    def _bucket(total: np.ndarray) -> np.ndarray:
        return np.clip(np.rint(total * 1.4) + BUCKETS // 2, 0, BUCKETS - 1).astype(np.int64)

    def scores(self, words: list[bytes], counts: np.ndarray, begun: Begun | None = None) -> np.ndarray:
        """log10 probability of each word with its stop sign; `counts` is how often each was seen.

        Without `begun`, no word began like these.
        """
        out = np.zeros(len(words))
        for at, part in _steps(words):
            bits = Bits(self.code, part, self.slots)
            none = np.zeros(len(bits.turn), dtype=np.float32)
            total = self.mixed(*self.inputs(bits, begun.of(np.arange(at, at + len(part))) if begun else (none, none)))
            p = 1 / (1 + np.exp(-total))
            if self.refine is not None:
                p = (p + self.refine[bits.node, self._bucket(total)]) / 2
            p = np.clip(p, 1e-6, 1 - 1e-6)
            logs = np.log10(np.where(bits.turn, p, 1 - p))
            out[at : at + len(part)] = np.bincount(bits.word, weights=logs, minlength=len(part))
        if not self.known:
            return out
        share = self.known * counts / self.tokens
        spelled = np.log10(1 - self.known) + out
        return np.where(share > 0, np.logaddexp(np.log(np.maximum(share, 1e-300)), spelled * np.log(10)) / np.log(10), spelled)


# Logarithms (base 2) of the ratio of the two last predictions are counted in this many classes.
RATIOS = 129


def _share(counted: np.ndarray) -> float:
    """The share of word counts that makes the words most likely, from counts of ratios (the last class: unseen)."""
    if counted.sum() <= 0:
        return 0.0
    ratio = 2.0 ** (np.arange(RATIOS - 1) - RATIOS // 2)
    share = 0.5
    for _ in range(200):
        part = share * ratio / (share * ratio + 1 - share)
        share = float((counted[:-1] * part).sum() / counted.sum())
    return min(share, 0.999)


def _steps(words: list[bytes], most: int = STEP_WORDS) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of words with a bounded number of bytes (one longer word is a run of its own)."""
    at = 0
    while at < len(words):
        n, size = 0, 0
        while at + n < len(words) and n < most and (n == 0 or size + len(words[at + n]) < 12 * most):
            size += len(words[at + n])
            n += 1
        yield at, words[at : at + n]
        at += n


def _runs(batches: Iterator[pa.RecordBatch], trained: bool = True) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and counts of each run; of the trained words only, if so wished."""
    for batch in batches:
        for words, n in zip(column(batch, "words"), column(batch, "counts")):
            words, n = words.as_py(), np.array(n.as_py(), dtype=float)
            if trained:
                words, n = [w for w, c in zip(words, n) if c > 0], n[n > 0]
            if words:
                yield words, n


def sorted_runs(words: DataFrame) -> DataFrame:
    """run, words, counts: all words (word, c) in order, so many to a row."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial = TaskContext.get().partitionId(), 0
        words, counts = [], []

        def row() -> pa.RecordBatch:
            name = pa.array([(task << 32) + serial], pa.int64())
            return pa.RecordBatch.from_arrays(
                [name, pa.array([words], pa.list_(pa.binary())), pa.array([counts], pa.list_(pa.int64()))], names=["run", "words", "counts"]
            )

        size = 0
        for batch in batches:
            for word, c in zip(column(batch, "word").to_pylist(), column(batch, "c").to_pylist()):
                if words and (len(words) >= RUN_WORDS or size + len(word) > RUN_BYTES):
                    yield row()
                    words, counts, size = [], [], 0
                    serial += 1
                words.append(word)
                counts.append(c)
                size += len(word)
        if words:
            yield row()

    ordered = words.repartitionByRange("word").sortWithinPartitions("word").select("word", "c")
    return ordered.mapInArrow(gather, "run bigint, words array<binary>, counts array<bigint>")


def shared_beginnings(runs: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(beginning, sign, count) of beginnings that words of several runs have.

    Sorted words that begin alike are neighbours, so these are beginnings of a run's first or last word.
    """

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, words, n in zip(*(column(batch, k).to_pylist() for k in ("run", "words", "counts"))):
                signs, length = signs_of(words)
                begin = beginnings(signs, length)
                ends = np.concatenate([begin[: length[0]], begin[-length[-1] :]])
                at = np.isin(begin, ends)
                (begin, signs), sums, _ = _summed(begin[at], signs[at], np.repeat(np.array(n, dtype=float), length)[at])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(sums), name)), pa.array(begin.view(np.int64)), pa.array(signs), pa.array(sums)],
                    names=["run", "begin", "sign", "n"],
                )

    rows = runs.mapInArrow(edges, "run bigint, begin bigint, sign bigint, n double")
    several = rows.groupBy("begin").agg(F.min("run").alias("a"), F.max("run").alias("b")).where("a < b").select("begin")
    found = rows.groupBy("begin", "sign").agg(F.sum("n").alias("n")).join(several, "begin").where("n > 0").toArrow()
    begin, sign, n = (found.column(k).to_numpy() for k in ("begin", "sign", "n"))
    return begin.astype(np.int64).view(_U), sign.astype(np.int64), n


def _distinct(ranks: np.ndarray) -> float:
    """The number of distinct keys (HyperLogLog) behind the largest rank of each register."""
    m = len(ranks)
    found = 0.7213 / (1 + 1.079 / m) * m * m / np.sum(2.0**-ranks)
    none = int((ranks == 0).sum())
    return float(m * np.log(m / none) if found < 2.5 * m and none else found)


def _sum_rows(values: np.ndarray, names: list[str]) -> Iterator[pa.RecordBatch]:
    """(place, values...) of the places where something was counted."""
    at = np.flatnonzero(values.any(axis=0))
    for a in range(0, len(at), 1 << 16):
        part = at[a : a + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), *[pa.array(v[part]) for v in values]], names=["place", *names])


def _collected(rows: DataFrame, size: int, names: list[str]) -> np.ndarray:
    """Sums per place, of at most `size` places."""
    found = rows.groupBy("place").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    out = np.zeros((len(names), size))
    place = found.column("place").to_numpy()
    for i, n in enumerate(names):
        out[i, place] = found.column(n).to_numpy()
    return out


def learn(runs: DataFrame, shared: tuple[np.ndarray, np.ndarray, np.ndarray]) -> Mixer:
    """The model of all training words, in sorted runs; `shared` are the beginnings of several runs."""
    spark = runs.sparkSession
    seen = runs.coalesce(LEARNERS)

    def letters(batches):
        total = np.zeros((1, STOP + 1))
        for part, n in _runs(batches):
            signs, length = signs_of(part)
            total[0] += np.bincount(signs, weights=np.repeat(n, length), minlength=STOP + 1)
        yield from _sum_rows(total, ["n"])

    code = Code(_collected(seen.mapInArrow(letters, "place bigint, n double"), STOP + 1, ["n"])[0])
    shared_code = spark.sparkContext.broadcast(code)

    def ranks(batches):
        best = np.zeros(len(SLOTS) << REGISTERS)
        for words, _ in _runs(batches):
            for _, part in _steps(words):
                for i, key in enumerate(Bits(shared_code.value, part).keys):
                    key = np.unique(mix(key))
                    rest = (key & _U((1 << (64 - REGISTERS)) - 1)).astype(float)
                    rank = 65 - REGISTERS - np.frexp(rest)[1]  # of the leading one; rounding up costs at most one
                    np.maximum.at(best, (key >> _U(64 - REGISTERS)).view(np.int64) + (i << REGISTERS), rank)
        yield from _sum_rows(best[None], ["n"])

    best = np.zeros(len(SLOTS) << REGISTERS)
    for place, n in seen.mapInArrow(ranks, "place bigint, n double").groupBy("place").agg(F.max("n")).collect():
        best[place] = n
    slots = tuple(max(least, 1 << int(np.ceil(np.log2(ROOM * _distinct(r) + 1)))) for least, r in zip(SLOTS, best.reshape(len(SLOTS), -1)))
    size = sum(slots)

    def turns(batches):
        total = np.zeros((2, size))
        for words, counts in _runs(batches):
            for at, part in _steps(words):
                bits = Bits(shared_code.value, part, slots)
                weight = counts[at : at + len(part)][bits.word]
                for turn in (0, 1):
                    hit = bits.turn == bool(turn)
                    for slot in bits.slots:
                        np.add.at(total[turn], slot[hit], weight[hit])
        yield from _sum_rows(total, ["no", "yes"])

    counts = _collected(seen.mapInArrow(turns, "place bigint, no double, yes double"), size, ["no", "yes"]).astype(np.float32)
    tokens = int(runs.agg(F.sum(F.expr("aggregate(counts, 0L, (a, x) -> a + x)"))).first()[0] or 0)
    started = spark.sparkContext.broadcast((Mixer(code, counts, slots), shared))

    def mingled(batches, code, crossing):
        """Words of a run in an order that has nothing to do with their spelling, 512 at a time."""
        for words, n in _runs(batches):
            begun = Begun(code, words, n, crossing)
            order = np.argsort(mix(np.arange(len(words), dtype=_U) + _U(5)))
            for at, part in _steps([words[i] for i in order], 512):
                here = order[at : at + len(part)]
                yield part, n[here], begun.of(here)

    def weights(batches):
        """Online: each run of words is predicted, then the weights take a step, and the refinements count."""
        model, crossing = started.value
        model = Mixer(model.code, model.counts, model.slots)
        power = np.full_like(model.weights, 1e-3)
        refine = np.zeros((2, (STOP + 1) * BUCKETS))
        total, mass, ratios = np.zeros(GATES * INPUTS), 0.0, np.zeros(RATIOS)
        for part, n, at_bits in mingled(batches, model.code, crossing):
            bits = Bits(model.code, part, model.slots)
            stretched, gate = model.inputs_without(bits, at_bits)
            mixed = model.mixed(stretched, gate)
            weight = n[bits.word]
            p = 1 / (1 + np.exp(-mixed))
            spelled = np.bincount(bits.word, weights=np.log2(np.where(bits.turn, p, 1 - p)), minlength=len(part))
            ratio = np.log2(np.maximum(n - 1, 0.5) / tokens) - spelled
            place = np.clip(np.rint(ratio) + RATIOS // 2, 0, RATIOS - 2).astype(np.int64)
            ratios += np.bincount(np.where(n > 1, place, RATIOS - 1), weights=n, minlength=RATIOS)
            gap = (bits.turn - p) * weight
            scale = np.maximum(np.bincount(gate, weights=weight, minlength=GATES), 1e-9)[:, None]
            step = np.stack([np.bincount(gate, weights=gap * s, minlength=GATES) for s in stretched], axis=1) / scale
            power += step**2
            model.weights += 0.03 * step / np.sqrt(power)
            cell = bits.node * BUCKETS + model._bucket(mixed)
            for turn in (0, 1):
                hit = bits.turn == bool(turn)
                refine[turn] += np.bincount(cell[hit], weights=weight[hit], minlength=refine.shape[1])
            total += model.weights.ravel() * n.sum()
            mass += n.sum()
        yield from _sum_rows(refine, ["no", "yes"])
        if mass:
            place = pa.array(-1 - np.arange(len(total) + 1 + RATIOS), pa.int64())
            values = pa.array(np.concatenate([total, [mass], ratios]))
            yield pa.RecordBatch.from_arrays([place, values, values], names=["place", "no", "yes"])

    learned = seen.mapInArrow(weights, "place bigint, no double, yes double").groupBy("place").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes")).collect()
    refine, rest = np.zeros((2, (STOP + 1) * BUCKETS)), np.zeros(GATES * INPUTS + 1 + RATIOS)
    for place, no, yes in learned:
        if place >= 0:
            refine[:, place] = no, yes
        else:
            rest[-1 - place] = no
    model = Mixer(code, counts, slots)
    total, mass, ratios = rest[: GATES * INPUTS], rest[GATES * INPUTS], rest[GATES * INPUTS + 1 :]
    if mass:
        model.weights = (total / mass).reshape(GATES, INPUTS)
    model.known, model.tokens = _share(ratios), tokens
    middle = 1 / (1 + np.exp(-(np.arange(BUCKETS) - BUCKETS // 2) / 1.4))
    no, yes = refine.reshape(2, STOP + 1, BUCKETS)
    model.refine = (yes + 2 * middle) / (no + yes + 2)
    return model.freeze()


def fingerprint(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


# Fingerprints of the start and the end of a text; no word holds a blank.
START, END = fingerprint(b" start"), fingerprint(b" end")


class Places(dict):
    """The place of each word in the order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


class Pairs:
    """Neighbours in a block's texts, with the start and the end of each.

    `before` and `after` are places in the block's list of words; the place behind the last word
    stands for the start as `before` and for the end as `after`.
    """

    def __init__(self, tokens: bytes, lengths: bytes, prints: bytes):
        prints = np.frombuffer(prints, dtype=_U)
        self.lengths = np.frombuffer(lengths, dtype=np.int32).astype(np.int64)  # with the end
        self.first = np.cumsum(self.lengths) - self.lengths
        self.after = np.full(int(self.lengths.sum()), len(prints), dtype=np.int32)
        inside = np.ones(len(self.after), dtype=bool)
        inside[self.first + self.lengths - 1] = False
        self.after[inside] = np.frombuffer(tokens, dtype=np.int32)
        self.before = np.empty_like(self.after)
        self.before[1:] = self.after[:-1]
        self.before[self.first] = len(prints)
        self.left, self.right = mix(np.append(prints, _U(START))) * _NODE, np.append(prints, _U(END))

    def keys(self, part=slice(None)) -> np.ndarray:
        """The fingerprint of each pair."""
        keys = self.left[self.before[part]]
        keys += self.right[self.after[part]]
        return keys

    def distinct(self) -> np.ndarray:
        keys = self.keys()
        keys.sort()
        return keys[np.append(True, keys[1:] != keys[:-1])]

    def trained(self, held: bytes, distinct: np.ndarray) -> np.ndarray:
        """How often each distinct pair occurs in texts that are not held out."""
        keys = self.keys(np.repeat(np.frombuffer(held, dtype=np.uint8) == 0, self.lengths))
        keys.sort()
        often = np.searchsorted(keys, distinct, "right")
        often -= np.searchsorted(keys, distinct)
        return often

    def runs(self, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
        """Ranges of texts with about so many pairs (one longer text is a range of its own)."""
        at = 0
        while at < len(self.first):
            end = max(at + 1, int(np.searchsorted(self.first, self.first[at] + most)))
            yield at, end
            at = end


def slices(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where each slice (the leading bits) of sorted fingerprints begins, and their number."""
    return np.append(np.searchsorted(keys, np.arange(1 << bits, dtype=_U) << _U(64 - bits)), len(keys))


def _packed(values: np.ndarray) -> bytes:
    """Non-negative numbers in as few bytes as the largest one needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"u{len(raw) // n}" if n else "u1").astype(np.int64)


def pair_counts(stored: DataFrame, bits: int) -> DataFrame:
    """block, slice, totals (packed training counts of its pairs), once (of the whole slice, on one row)."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, tokens, lengths, prints, held = (c[row].as_py() for c in batch.columns)
                pairs = Pairs(tokens, lengths, prints)
                keys = pairs.distinct()
                often, at = pairs.trained(held, keys), slices(keys, bits)
                del pairs
                filled = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(filled), block), pa.int64()), pa.array(filled, pa.int64()),
                        pa.array([keys[at[i] : at[i + 1]].tobytes() for i in filled], pa.binary()),
                        pa.array([_packed(often[at[i] : at[i + 1]]) for i in filled], pa.binary()),
                    ],
                    names=["block", "slice", "keys", "often"],
                )

    def total(rows: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k, dtype=_U) for k in rows.column("keys").to_pylist()]
        often = [_unpacked(o, len(k)) for o, k in zip(rows.column("often").to_pylist(), keys)]
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(place, weights=np.concatenate(often), minlength=len(found)).astype(np.int64)
        parts = np.split(sums[place], np.cumsum([len(k) for k in keys])[:-1])
        once = np.zeros(len(keys), dtype=np.int64)
        once[0] = (sums == 1).sum()
        return pa.Table.from_arrays(
            [rows.column("block"), rows.column("slice"), pa.array([_packed(p) for p in parts], pa.binary()), pa.array(once)],
            names=["block", "slice", "totals", "once"],
        )

    sent = stored.where("kind = 2").select("block", "tokens", "lengths", "prints", "held").mapInArrow(
        send, "block bigint, slice bigint, keys binary, often binary"
    )
    return sent.groupBy("slice").applyInArrow(total, "block bigint, slice bigint, totals binary, once bigint")


def alone_factor(counts: np.ndarray, mass: np.ndarray, once: float) -> float:
    """The factor by which as many pairs are foreseen as new as occur once; `mass` pairs begin with words of such a count."""
    low, high = 0.0, float(counts.max(initial=1)) ** FALL
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mass @ np.minimum(1, middle * counts**-FALL) < once else (low, middle)
    return high


_BLOCKS = """kind int, block bigint, id {id}, held_out boolean, n_bytes bigint, n_tokens bigint, tokens binary, lengths binary,
prints binary, held binary, place int, word binary, c bigint"""


def blocks(docs: DataFrame, modulus: int, held_out: int, doc_id: str, text: str) -> DataFrame:
    """Rows of documents, rows of words (of a block), and one row with the texts of a block as places of words."""
    schema = _BLOCKS.format(id=docs.schema[doc_id].dataType.simpleString())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, serial = TaskContext.get().partitionId(), 0
        fields = None
        vocabulary = Places()
        size, texts, flags = 0, [], []

        def rows(**columns) -> pa.RecordBatch:
            n = len(next(iter(columns.values())))
            block = pa.array(np.full(n, (task << 24) + serial), pa.int64())
            columns["block"] = block
            return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in fields], schema=fields)

        def finished() -> Iterator[pa.RecordBatch]:
            kept = [t for t, out in zip(texts, flags) if not out]
            c = np.bincount(np.concatenate(kept), minlength=len(vocabulary)) if kept else np.zeros(len(vocabulary), dtype=np.int64)
            listed = list(vocabulary)
            for a in range(0, len(listed), 50_000):
                part = listed[a : a + 50_000]
                n = len(part)
                yield rows(
                    kind=pa.array([1] * n, pa.int32()), place=pa.array(np.arange(a, a + n, dtype=np.int32)),
                    word=pa.array(part, pa.binary()), c=pa.array(c[a : a + n].astype(np.int64)),
                )
            prints = np.fromiter(map(fingerprint, listed), dtype=_U, count=len(listed))
            lengths = np.fromiter(map(len, texts), dtype=np.int32, count=len(texts)) + np.int32(1)
            yield rows(
                kind=pa.array([2], pa.int32()), tokens=pa.array([np.concatenate(texts).tobytes()], pa.binary()),
                lengths=pa.array([lengths.tobytes()], pa.binary()), prints=pa.array([prints.tobytes()], pa.binary()),
                held=pa.array([np.array(flags, dtype=np.uint8).tobytes()], pa.binary()),
            )

        for batch in batches:
            if fields is None:
                id_type = batch.schema.field("id").type
                kinds = [
                    pa.int32(), pa.int64(), id_type, pa.bool_(), pa.int64(), pa.int64(), *[pa.binary()] * 4,
                    pa.int32(), pa.binary(), pa.int64(),
                ]
                fields = pa.schema([(f.split()[0], k) for f, k in zip(schema.split(","), kinds)])
            tokens, lengths = [], []
            held, bodies, first = column(batch, "held").to_pylist(), column(batch, "body"), 0
            for i, (out, body) in enumerate(zip(held, bodies)):
                raw = (body.as_py() or "").encode()
                found = raw.lower().split()  # bytes: A-Z only, and white space from tab to return, and blank
                texts.append(np.fromiter(map(vocabulary.__getitem__, found), dtype=np.int32, count=len(found)))
                flags.append(out)
                tokens.append(len(found) + 1)
                lengths.append(len(raw))
                size += len(raw)
                if size > BLOCK_BYTES or i + 1 == len(held):
                    n = len(tokens)
                    yield rows(
                        kind=pa.array([0] * n, pa.int32()), id=column(batch, "id").slice(first, n), held_out=column(batch, "held").slice(first, n),
                        n_bytes=pa.array(lengths, pa.int64()), n_tokens=pa.array(tokens, pa.int64()),
                        place=pa.array(np.arange(len(texts) - n, len(texts), dtype=np.int32)),
                    )
                    first += n
                    tokens, lengths = [], []
                if size > BLOCK_BYTES:
                    yield from finished()
                    vocabulary, texts, flags, size = Places(), [], [], 0
                    serial += 1
        if texts:
            yield from finished()

    rows = docs.select(
        docs[doc_id].alias("id"), (remainder(docs[doc_id], modulus) == held_out).alias("held"), docs[text].cast("string").alias("body")
    )
    return rows.mapInArrow(work, schema)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", modulus: int = 7, held_out: int = 2) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    Documents whose crc32 of the id leaves the remainder `held_out` teach the model nothing. A null
    text counts as empty: its only token is the end. A null id counts as the empty text for the
    remainder. Without training documents every bit has probability one half. Rows with the same
    id are scored one by one. bits_per_byte is null for an empty text.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "blocks")
    blocks(docs, modulus, held_out, doc_id, text).write.option("compression", "zstd").parquet(path)
    stored = spark.read.parquet(path)
    listed = spark.read.parquet(path).where("kind = 1").select("word", "block", "place", "c")
    per_doc = stored.where("kind <> 1").select("kind", "block", "id", "held_out", "n_bytes", "n_tokens", "place", "tokens", "lengths", "prints")

    runs = spark.read.parquet(_written(sorted_runs(listed.groupBy("word").agg(F.sum("c").alias("c")))))
    words = runs.select(F.explode("counts").alias("c"))
    figures = words.agg(F.sum("c").alias("n"), F.sum(F.expr("int(c > 0)")).alias("v")).first()
    ends = stored.where("kind = 0 AND NOT held_out").count()
    n, v = (figures["n"] or 0) + ends, (figures["v"] or 0) + int(ends > 0)
    shared = shared_beginnings(runs)
    model = spark.sparkContext.broadcast((learn(runs, shared), shared))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, crossing = model.value
        for found, n in _runs(batches, trained=False):
            logs = mixer.scores(found, n, Begun(mixer.code, found, n, crossing))
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.binary()), pa.array(n.astype(np.int64)), pa.array(logs)], names=["word", "c", "s"]
            )

    costs = runs.mapInArrow(scored, "word binary, c bigint, s double")
    replies = listed.drop("c").join(costs, "word").select("block", "place", "c", F.col("s").cast("float").alias("s"))
    bits = max(4, (stored.where("kind = 2").count() - 1).bit_length())  # so many pairs a slice, whatever the input
    pairs = spark.read.parquet(_written(pair_counts(stored, bits)))
    once = pairs.agg(F.sum("once")).first()[0] or 0
    seen = words.where("c > 0").groupBy(F.floor(F.log2("c") * 4)).agg(F.sum("c"), F.count("c")).collect()
    mass, kinds = np.array([ends, *[r[1] for r in seen]], dtype=float), np.array([1, *[r[2] for r in seen]], dtype=float)
    factor = alone_factor(np.maximum(mass / kinds, 1), mass, once)
    ending = (ends + 1.0) / (n + 2.0)  # of the end, at each token
    names = ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]

    def add_up(docs_: pa.Table, replies_: pa.Table) -> pa.Table:
        texts = docs_.filter(pc.equal(docs_.column("kind"), 2))
        docs_ = docs_.filter(pc.equal(docs_.column("kind"), 0)).sort_by("place")
        pairs_ = Pairs(*(texts.column(k)[0].as_py() for k in ("tokens", "lengths", "prints")))
        slices_ = replies_.filter(pc.is_valid(replies_.column("slice")))
        words_ = replies_.filter(pc.is_null(replies_.column("slice")))
        place = words_.column("place").to_numpy()
        count, logs = np.zeros(len(place) + 1, dtype=np.int64), np.zeros(len(place) + 1)  # the end is the last one
        count[place], count[-1] = words_.column("c").to_numpy(), ends
        logs[place] = words_.column("s").to_numpy() + np.log10(1 - ending)
        logs[-1] = np.log10(ending)
        keys = pairs_.distinct()
        total, at = np.zeros(len(keys), dtype=np.int64), slices(keys, bits)
        for i, raw in zip(slices_.column("slice").to_pylist(), slices_.column("totals").to_pylist()):
            total[at[i] : at[i + 1]] = _unpacked(raw, at[i + 1] - at[i])
        base = np.log10((count + 1) / (n + v + 1))
        known = (count > 0).astype(np.int64)
        out = {k: [] for k in ("known", "base", "score")}
        for a, b in pairs_.runs():
            first = pairs_.first[a:b]
            part = slice(first[0], first[-1] + pairs_.lengths[b - 1])
            after = pairs_.after[part]
            before = count[pairs_.before[part]]  # as many texts start as end
            alone = np.where(before > 0, np.clip(factor * np.maximum(before, 1.0) ** -FALL, 1e-6, 1), 1)
            joint = np.log10(alone) + logs[after]
            share = (1 - alone) * total[np.searchsorted(keys, pairs_.keys(part))] / np.maximum(before, 1)
            mixed = np.where(share > 0, np.logaddexp(np.log(np.maximum(share, 1e-300)), joint * np.log(10)) / np.log(10), joint)
            for k, values in (("known", known[after]), ("base", base[after]), ("score", mixed)):
                out[k].append(np.add.reduceat(values, first - first[0]))
        out = {k: np.concatenate(v) for k, v in out.items()}
        size = docs_.column("n_bytes").to_pylist()
        spent = [-float(s) / np.log10(2) / b if b else None for s, b in zip(out["score"], size)]
        return pa.Table.from_arrays(
            [
                docs_.column("id"), docs_.column("held_out"), docs_.column("n_tokens"), pa.array(out["known"], pa.int64()),
                pa.array([n] * len(size), pa.int64()), pa.array(out["base"], pa.float64()), pa.array(out["score"], pa.float64()),
                pa.array(spent, pa.float64()),
            ],
            names=names,
        )

    id_type = docs.schema[doc_id].dataType.simpleString()
    schema = f"id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, bits_per_byte double"
    replies = replies.unionByName(pairs.drop("once"), allowMissingColumns=True).withColumnRenamed("block", "of_block")
    found = per_doc.groupBy("block").cogroup(replies.groupBy("of_block")).applyInArrow(add_up, schema)
    return found.withColumnRenamed("id", doc_id)


def _written(df: DataFrame) -> str:
    """The folder that the rows were written to."""
    path = scratch_path(df.sparkSession, "rows")
    df.write.option("compression", "zstd").parquet(path)
    return path


@query("op7_lm_scoring")
def op7(spark, folder):
    """The log probability of every document."""
    return score(table(spark, folder, "documents"))
