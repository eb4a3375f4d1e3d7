"""Words, lines and hashes of Arrow text columns, made with numpy over many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are worked on in runs of about this many bytes; one longer text makes a run of its own.
RUN_BYTES = 1 << 20

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)

# The separators of words: blank and the control characters from tab to carriage return.
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

# Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (one-to-one)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Run:
    """Some neighbouring texts: their bytes and where each one starts."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first = first  # row of the first text in its batch
        self.data = data
        self.offsets = offsets  # len(texts) + 1 positions in data

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def texts(self) -> Iterator[bytes]:
        raw = self.data.tobytes()
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            yield raw[a:b]

    def words(self, lower: bool = False) -> Words:
        return Words(self, lower)


class Words:
    """The words of a run: first byte, byte after the last, text, and a 64-bit fingerprint."""

    def __init__(self, run: Run, lower: bool):
        self.run = run
        data = LOWER[run.data] if lower else run.data
        inside = ~SEPARATOR[run.data]
        n = len(data)
        before = np.empty(n, dtype=bool)
        before[:1] = False
        before[1:] = inside[:-1]
        before[run.offsets[:-1][run.offsets[:-1] < n]] = False  # a text starts a word anew
        after = np.empty(n, dtype=bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        ends = run.offsets[1:] - 1
        after[ends[ends >= 0]] = False
        self.data = data
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.doc = np.searchsorted(run.offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=len(run))  # words of each text
        self._inside = inside

    def __len__(self) -> int:
        return len(self.starts)

    def fingerprints(self) -> np.ndarray:
        """64 bits for each word, from its bytes and its length."""
        if not len(self):
            return np.zeros(0, dtype=_U)
        at = np.flatnonzero(self._inside)
        length = self.ends - self.starts
        first = np.cumsum(length) - length
        place = np.arange(len(at)) - np.repeat(first, length)
        powers = np.full(int(length.max()), _STEP | _U(1), dtype=_U)
        powers[0] = 1
        powers = mix(np.cumprod(powers)) | _U(1)
        terms = (self.data[at].astype(_U) + _U(1)) * powers[place]
        return mix(np.add.reduceat(terms, first) + length.astype(_U) * _STEP)

    def strings(self) -> list[bytes]:
        raw = self.data.tobytes()
        return [raw[a:b] for a, b in zip(self.starts.tolist(), self.ends.tolist())]


def sequence_hash(parts: np.ndarray, width: int) -> np.ndarray:
    """A hash of every `width` neighbours of `parts`; len(parts) - width + 1 of them."""
    n = len(parts) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=_U)
    out = np.zeros(n, dtype=_U)
    for i in range(width):
        out = out * _U(0xD6E8FEB86659FD93) + parts[i : i + n]
    return mix(out)


def runs(column: pa.Array, limit: int = RUN_BYTES) -> Iterator[Run]:
    """The texts of a string column in runs; a null counts as an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = max(int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1, first + 1)
        yield Run(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of the values from offsets[i] to offsets[i + 1], for every i."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]
