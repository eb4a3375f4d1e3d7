"""Operator 3: joining texts whose word shingles are alike, by token-combination prefixes.

A text is its set of distinct shingles, here called tokens, each a 64-bit hash. Texts with the same set
are one set. The tokens of a set are ordered by hash; the first few are its prefix. Two sets that
reach the wanted similarity miss few of each other's tokens, so a prefix longer than what may be missing
holds a common token.

Tokens that few sets have in their prefix are rare, and sets that share one are paired. Frequent tokens
are signatures themselves as long as their sets make one block. Those of more sets
are indexed in combinations of two: they are dealt to P classes by hash, and every two of one class
make a signature. A set's prefix has P tokens more than a prefix of single tokens would need. However
many tokens of a class are missing in the other set, the first survivor makes no signature and every
further one does, so P tokens more make up for it. Pairs that rely on signatures have a set
with so many frequent tokens that its rare ones do not suffice (a dense set): only signatures
with a dense set are followed.

What is compared, and where. Pairs by rare tokens are first held against the number of tokens they
share in their prefixes, then grouped by the signature that covers most pairs, so that a
text travels few times. Dense sets come from large families of near copies, whose pairs are never
listed: all pairs with one of their first tokens in common are compared inside tasks, block by block,
and only links that join something leave a task. What these links join needs no further pair. Pairs of dense sets
without such a token follow from the signatures. Rows of signatures carry a sketch of their set, one bit for the
parity of the tokens of each slot: where two sketches differ, a token is in one of the sets only. So
pairs whose sketches differ in more bits than similar sets may have such tokens are left out before they are listed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .base import components, query, table, unused
from .text import column, mix, runs, sequence_hash

WORDS = 4
# Per cent of the union that the intersection has to reach; 80 or more.
LEAST = 85
# A token in more prefixes than this is frequent.
RARE = 48
# First tokens by which dense sets meet.
KEYS = 3
# Sets in a block of dense sets, and their tokens.
BLOCK_SETS, BLOCK_TOKENS = 1024, 800_000
# Rows in a block of a signature, where only numbers and sketches are compared.
BLOCK_ROWS = 4096
# Bits of a sketch at least.
SKETCH_BITS = 512
# Pairs whose sketches are compared at once.
_PAIRS_AT_ONCE = 1 << 17
# Pairs compared in one unit of work.
UNIT_PAIRS = 256
# Bits that mark which documents have to be read again. More marked documents than fit only mean more reading.
MARK_BITS = 1 << 26
_U = np.uint64


def shingle_sets(run, words: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingles of every text of a run."""
    found = run.words(lower=True)
    prints = found.fingerprints()
    whole = sequence_hash(prints, words)
    ends = np.cumsum(found.counts)
    out = []
    for a, b in zip((ends - found.counts).tolist(), ends.tolist()):
        if b - a >= words:
            out.append(np.unique(whole[a : b - words + 1]))
        elif b > a:
            out.append(mix(sequence_hash(prints[a:b], b - a) + _U(b - a)))
        else:
            out.append(np.zeros(0, dtype=_U))
    return out


class Shape:
    """Prefix lengths and signatures for a least similarity."""

    def __init__(self, least: int):
        if not 80 <= least <= 100:
            raise ValueError("the similarity must be from 80 to 100 per cent")
        self.least = least

    def missing(self, n: int) -> int:
        """Tokens of a set of n that a similar set may lack."""
        return n - (self.least * n + 99) // 100

    def alone(self, n: int) -> bool:
        """No other set is similar enough to one of n tokens."""
        return 100 * n < self.least * (n + 1)

    @staticmethod
    def classes(grade: int) -> int:
        """Classes of frequent tokens for sets of 2^grade tokens and more."""
        return max(min(4, 1 << max(grade - 1, 0)), (1 << grade) // 16)

    def dealings(self, n: int) -> list[int]:
        """The numbers of classes for the sizes that sets similar to one of n tokens may have."""
        low, high = -(-self.least * n // 100), 100 * n // self.least
        return sorted({self.classes(g) for g in range(low.bit_length() - 1, high.bit_length())})

    def prefix(self, n: int) -> int:
        return min(n, self.missing(n) + 1 + self.dealings(n)[-1]) if n else 0

    def dense(self, n: int, frequent: int) -> bool:
        """Too many frequent tokens in the prefix for the rare ones to suffice."""
        return self.prefix(n) - frequent <= self.missing(n)

    def signatures(self, n: int, tokens: np.ndarray) -> np.ndarray:
        """Combinations of two frequent tokens, for every number of classes."""
        out = []
        for classes in self.dealings(n):
            lot = mix(tokens) % _U(classes)
            order = np.lexsort((tokens, lot))
            t, lot = tokens[order], lot[order]
            first = np.concatenate([[0], np.flatnonzero(lot[1:] != lot[:-1]) + 1, [len(t)]])
            for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
                if b - a > 1:
                    i, j = np.triu_indices(b - a, 1)
                    out.append(mix(mix(t[a:b][i] + _U(classes)) + t[a:b][j]))
        return np.unique(np.concatenate(out)) if out else np.zeros(0, dtype=_U)

    def grade_width(self) -> float:
        """Similar sets differ by less in the logarithms of their numbers of tokens."""
        return 1.01 * np.log(100 / min(self.least, 99))

    def alike(self, common, a, b):
        """Whether sets of a and b tokens with so many in common are similar enough."""
        return 100 * common >= self.least * (a + b - common)

    def overlap(self, a, b):
        """Tokens that similar sets of a and b tokens have in common at least."""
        return -(-self.least * (a + b) // (100 + self.least))


def sketch(tokens: np.ndarray) -> bytes:
    """Parity of the number of tokens in each slot, with a slot for two tokens or more."""
    bits = max(SKETCH_BITS, 1 << (len(tokens) // 2).bit_length())
    slots = np.bincount((mix(tokens) % _U(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(slots.astype(np.uint8), bitorder="little").tobytes()


class Sketches:
    """Sketches of several lengths. Of two lengths, the longer sketch is folded."""

    def __init__(self, sketches: list[bytes]):
        self.sketches, self.rows = sketches, {}
        self.length = np.array([len(x) for x in sketches], dtype=np.int64)

    def folded(self, size: int) -> np.ndarray:
        """The sketches of at least so many bytes, folded to it."""
        if size not in self.rows:
            out = self.rows[size] = np.zeros((len(self.sketches), size // 8), dtype=_U)
            for of in np.unique(self.length[self.length >= size]).tolist():
                at = np.flatnonzero(self.length == of)
                words = np.frombuffer(b"".join([self.sketches[i] for i in at.tolist()]), dtype=_U)
                out[at] = np.bitwise_xor.reduce(words.reshape(len(at), -1, size // 8), axis=1)
        return self.rows[size]

    def differences(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For pairs of positions: no more than the number of tokens that are in one of both sets only."""
        out, shorter = np.zeros(len(a), dtype=np.int64), np.minimum(self.length[a], self.length[b])
        for size in np.unique(shorter).tolist():
            rows, here = self.folded(size), np.flatnonzero(shorter == size)
            for k in range(0, len(here), _PAIRS_AT_ONCE):
                part = here[k : k + _PAIRS_AT_ONCE]
                out[part] = np.bitwise_count(rows[a[part]] ^ rows[b[part]]).sum(axis=1)
        return out


def _identity(tokens: np.ndarray) -> tuple[int, int]:
    digest = np.frombuffer(hashlib.blake2b(tokens.tobytes(), digest_size=16).digest(), dtype=np.int64)
    return int(digest[0]), int(digest[1])


def _written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read from there."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _rows(docs: DataFrame, words: int, shape: Shape, with_prefix: bool) -> DataFrame:
    """id, n, f1, f2 (and the prefix and the sketch) of every document."""
    id_type = docs.schema["id"].dataType.simpleString()
    names = ["id", "n", "f1", "f2", *["prefix", "sketch"] * with_prefix]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, one, two, prefixes, sketches = [], [], [], [], []
            for run in runs(column(batch, "text")):
                for tokens in shingle_sets(run, words):
                    a, b = _identity(tokens)
                    sizes.append(len(tokens))
                    one.append(a)
                    two.append(b)
                    if with_prefix:
                        prefixes.append(tokens[: shape.prefix(len(tokens))].tobytes())
                        sketches.append(sketch(tokens))
            arrays = [column(batch, "id"), *[pa.array(x, pa.int64()) for x in (sizes, one, two)]]
            more = [pa.array(x, pa.binary()) for x in (prefixes, sketches) if with_prefix]
            yield pa.RecordBatch.from_arrays([*arrays, *more], names=names)

    return docs.select("id", "text").mapInArrow(work, f"id {id_type}, n bigint, f1 bigint, f2 bigint" + ", prefix binary, sketch binary" * with_prefix)


def _postings(sets: DataFrame, shape: Shape) -> DataFrame:
    """token, sid, n for the prefix of every set that may be similar to another one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = column(batch, "n").to_numpy()
            prefixes = column(batch, "prefix").to_pylist()
            use = [i for i, n in enumerate(size.tolist()) if not shape.alone(n)]
            if not use:
                continue
            tokens = [np.frombuffer(prefixes[i], dtype=np.int64) for i in use]
            times = [len(t) for t in tokens]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens)), pa.array(np.repeat(column(batch, "sid").to_numpy()[use], times)), pa.array(np.repeat(size[use], times))],
                names=["token", "sid", "n"],
            )

    return sets.select("sid", "n", "prefix").mapInArrow(work, "token bigint, sid bigint, n bigint")


def _listed_pairs(groups: DataFrame, shape: Shape) -> DataFrame:
    """All pairs of groups (sig, df, members) of few sets: a, b, na, nb, sig, df. A member has sid, n and what `_Members` has
    or only sid and n."""
    choosy = "keys" in groups.select(F.explode("members").alias("m")).select("m.*").columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = column(batch, "members")
            flat, ends = members.flatten(), members.offsets.to_numpy()
            starts, size = ends[:-1] - ends[0], np.diff(ends)
            sid, n = flat.field("sid").to_numpy(), flat.field("n").to_numpy()
            sig, df = column(batch, "sig").to_numpy(), column(batch, "df").to_numpy()
            of_sets = _Members(n, *[flat.field(c) for c in _Members.FACTS]) if choosy else None
            for g in np.unique(size):
                i, j = np.triu_indices(int(g), 1)
                for at in np.array_split(np.flatnonzero(size == g), max(1, int((size == g).sum() * len(i) >> 20))):
                    a, b = (starts[at][:, None] + i).ravel(), (starts[at][:, None] + j).ravel()
                    of = np.repeat(at, len(i))
                    fits = 100 * np.minimum(n[a], n[b]) >= shape.least * np.maximum(n[a], n[b])
                    a, b, of = a[fits], b[fits], of[fits]
                    if choosy:
                        fits = of_sets.open(shape, a, b)
                        a, b, of = a[fits], b[fits], of[fits]
                    if len(a):
                        yield _pair_rows(sid, n, a, b, sig[of], df[of])

    return groups.select("sig", "df", "members").mapInArrow(work, _PAIRS)


_PAIRS = "a bigint, b bigint, na bigint, nb bigint, sig bigint, df bigint"


def _pair_rows(sid, n, a, b, sig, df) -> pa.RecordBatch:
    swap = sid[a] > sid[b]
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (sid[a], sid[b], n[a], n[b], sig, df)], names=["a", "b", "na", "nb", "sig", "df"])


def _keys(column_: pa.Array) -> np.ndarray:
    """First tokens of sets, filled up with values that differ from row to row."""
    out = np.empty((len(column_), KEYS), dtype=np.int64)
    out[:] = -1 - np.arange(out.size).reshape(out.shape)
    raw = column_.to_pylist()
    given = np.array([len(x) // 8 for x in raw], dtype=np.int64)
    out[np.arange(KEYS) < given[:, None]] = np.frombuffer(b"".join(raw), dtype=np.int64)
    return out


class _Members:
    """What rows of signatures say of their sets, given by the columns n and FACTS."""

    FACTS = ["dense", "part", "keys", "sketch"]

    def __init__(self, n: np.ndarray, dense: pa.Array, part: pa.Array, keys: pa.Array, sketches: pa.Array):
        self.n, self.dense, self.part = n, dense.to_numpy(zero_copy_only=False), part.to_numpy()
        self.keys, self.sketches = _keys(keys), Sketches(sketches.to_pylist())

    def open(self, shape: Shape, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Pairs with a dense set that no links join yet, that may be similar by their sketches and are not
        two dense ones that meet by their first tokens."""
        out = (self.dense[a] | self.dense[b]) & (self.part[a] != self.part[b])
        at = np.flatnonzero(out)
        x, y = a[at], b[at]
        fits = self.sketches.differences(x, y) <= self.n[x] + self.n[y] - 2 * shape.overlap(self.n[x], self.n[y])
        out[at[~fits]] = False
        at = at[fits]
        at = at[self.dense[a[at]] & self.dense[b[at]]]
        for k in range(KEYS):
            out[at[(self.keys[a[at], k][:, None] == self.keys[b[at]]).any(axis=1)]] = False
        return out


def _blocks(rows: DataFrame, key: str, block, blocks) -> DataFrame:
    """Rows (with their `block`) for every unit of two blocks (`i` <= `j`) of their key."""
    rows = rows.withColumns({"block": block, "other": F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))})
    return rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other")


def _signature_pairs(frequent: DataFrame, shape: Shape) -> DataFrame:
    """Pairs that share a signature and have a dense set, from rows (sid, n, dense, part, keys, sketch, tokens, often)."""

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for n, tokens, often in zip(*[column(batch, c).to_pylist() for c in ("n", "tokens", "often")]):
                combined = shape.signatures(n, np.array(often, dtype=np.int64).view(_U)).view(np.int64)
                found.append(np.concatenate([np.array(list(set(tokens).difference(often)), dtype=np.int64), combined]))
            times = np.array([len(f) for f in found], dtype=np.int64)
            at = pa.array(np.repeat(np.arange(len(found)), times))
            if not len(at):
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found)), *[column(batch, c).take(at) for c in ("sid", "n", *_Members.FACTS)]],
                names=["sig", "sid", "n", *_Members.FACTS],
            )

    rows = frequent.select("sid", "n", *_Members.FACTS, "tokens", "often")
    rows = rows.mapInArrow(signatures, "sig bigint, sid bigint, n bigint, dense boolean, part bigint, keys binary, sketch binary")
    # Similar sets are of the same or of neighbouring grades. Rows without a dense set near their grade are left out.
    rows = rows.withColumn("grade", F.floor(F.ln("n") / shape.grade_width()))
    grades = rows.groupBy("sig", "grade").agg(F.count("*").alias("of_grade"), F.max("dense").alias("dense"))
    near = grades.where("dense").select("sig", F.explode(F.array(*[F.col("grade") + k for k in (-1, 0, 1)])).alias("grade")).distinct()
    live = _written(grades.drop("dense").join(near, ["sig", "grade"]), "grades")
    live = live.join(live.groupBy("sig").agg(F.sum("of_grade").alias("df")).where("df > 1"), "sig").drop("of_grade")
    rows = _written(rows.join(live, ["sig", "grade"]).drop("grade"), "signatures")
    few = rows.where(f"df <= {RARE}").groupBy("sig", "df").agg(F.collect_list(F.struct("sid", "n", *_Members.FACTS)).alias("members"))
    pairs = _listed_pairs(few, shape)

    blocks, one = F.ceil(F.col("df") / BLOCK_ROWS), F.lit(0).cast("bigint")
    many = rows.where(f"df > {BLOCK_ROWS}")
    many = _blocks(many, "sig", F.pmod(F.xxhash64("sid"), blocks), blocks)
    many = many.unionByName(rows.where(f"df > {RARE} AND df <= {BLOCK_ROWS}").withColumns({"block": one, "i": one, "j": one}))

    def compare(key: tuple, rows_: pa.Table) -> pa.Table:
        _, i, j = (k.as_py() for k in key)
        sid, n, block, dense = (rows_.column(c).to_numpy() for c in ("sid", "n", "block", "dense"))
        of_sets = _Members(n, *[rows_.column(c).combine_chunks() for c in _Members.FACTS])
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        found = []
        for some in np.array_split(left, max(1, -(-len(left) * len(right) // _PAIRS_AT_ONCE // 8))):
            open_ = dense[some][:, None] | dense[right]
            open_ &= 100 * n[some][:, None] >= shape.least * n[right]
            open_ &= 100 * n[right] >= shape.least * n[some][:, None]
            if i == j:
                open_ &= some[:, None] < right
            a, b = np.nonzero(open_)
            a, b = some[a], right[b]
            fits = of_sets.open(shape, a, b)
            found.append((a[fits], b[fits]))
        a, b = (np.concatenate([f[side] for f in found]) for side in (0, 1))
        sig, df = np.full(len(a), key[0].as_py(), dtype=np.int64), np.full(len(a), len(sid), dtype=np.int64)
        return pa.Table.from_batches([_pair_rows(sid, n, a, b, sig, df)])

    return pairs.unionByName(many.groupBy("sig", "i", "j").applyInArrow(compare, _PAIRS))


def _commons(sets: list[np.ndarray]) -> np.ndarray:
    """Common tokens of every two sets, through their incidence in runs of tokens."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[place] > 1
    owner = owner[shared]
    _, place = np.unique(place[shared], return_inverse=True)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 4096
    last = int(place[-1]) + 1 if len(place) else 0
    for a in range(0, last, width):
        low, high = np.searchsorted(place, [a, a + width])
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owner[low:high], place[low:high] - a] = 1
        out += part @ part.T
    return np.rint(out).astype(np.int64)


def _joining(a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Positions of links that join what earlier ones have not joined."""
    root = list(range(size))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = top(x), top(y)
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append(k)
    return np.array(out, dtype=np.int64)


def _sets_of(texts: pa.ChunkedArray, words: int) -> list[np.ndarray]:
    out = []
    for chunk in texts.chunks:
        for run in runs(chunk):
            out += shingle_sets(run, words)
    return out


_LINKS = "a bigint, b bigint"


def _dense_links(dense: DataFrame, bodies: DataFrame, shape: Shape, words: int) -> DataFrame:
    """Links among dense sets (sid, n, keys) that have one of their first tokens in common."""
    rows = dense.select("sid", "n", F.explode("first").alias("token"))
    groups = rows.groupBy("token").agg(F.count("*").alias("c"), F.sum("n").alias("t")).where("c > 1")
    rows = rows.join(groups, "token")
    blocks = F.greatest(F.ceil(F.col("c") / BLOCK_SETS), F.ceil(F.col("t") / BLOCK_TOKENS))
    rows = _blocks(rows, "token", F.pmod(F.xxhash64("sid"), blocks), blocks)
    rows = rows.select("token", "i", "j", "block", "sid").join(bodies, "sid")

    def compare(key: tuple, rows_: pa.Table) -> pa.Table:
        token, i, j = (k.as_py() for k in key)
        block, sid = rows_.column("block").to_numpy(), rows_.column("sid").to_numpy()
        sets = _sets_of(rows_.column("text"), words)
        size = np.array([len(s) for s in sets], dtype=np.int64)
        similar = shape.alike(_commons(sets), size[:, None], size[None, :])
        similar &= np.triu(np.ones_like(similar), 1)
        if i != j:
            similar &= block[:, None] != block[None, :]
        a, b = np.nonzero(similar)
        at = _joining(a, b, len(sets))
        return pa.Table.from_arrays([pa.array(sid[a[at]]), pa.array(sid[b[at]])], names=["a", "b"])

    return rows.groupBy("token", "i", "j").applyInArrow(compare, _LINKS)


def _verified(pairs: DataFrame, bodies: DataFrame, shape: Shape, words: int) -> DataFrame:
    """The pairs (a, b, cover, unit) that are links."""
    members = pairs.select("unit", F.explode(F.array("a", "b")).alias("sid")).distinct()
    members = members.select(F.col("unit").alias("of_unit"), "sid").join(bodies, "sid")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        place = {s: k for k, s in enumerate(right.column("sid").to_pylist())}
        sets = _sets_of(right.column("text"), words)
        a, b = [], []
        for x, y in zip(left.column("a").to_pylist(), left.column("b").to_pylist()):
            one, two = sets[place[x]], sets[place[y]]
            if len(one) > len(two):
                one, two = two, one
            at = np.minimum(np.searchsorted(two, one), len(two) - 1)
            if shape.alike(int((two[at] == one).sum()), len(one), len(two)):
                a.append(x)
                b.append(y)
        return pa.Table.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return pairs.select("unit", "a", "b").groupBy("unit").cogroup(members.groupBy("of_unit")).applyInArrow(compare, _LINKS)


def _bodies(docs: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """sid, text of the needed sets (sid, rep). Documents are read again; those that no set needs are
    left out early by a bitmap of fixed size."""
    marks = needed.select(F.pmod(F.xxhash64("rep"), F.lit(MARK_BITS)).alias("m"))
    marks = marks.select(F.expr("cast(m DIV 32 AS int)").alias("word"), F.expr("shiftleft(1L, cast(m % 32 AS int))").alias("bit"))
    found = marks.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(MARK_BITS // 32, dtype=np.uint32)
    bitmap[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    rows = docs.select(F.pmod(F.xxhash64("id"), F.lit(MARK_BITS)).alias("m"), "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = column(batch, "m").to_numpy()
            marked = np.flatnonzero((shared.value[m >> 5] >> (m & 31).astype(np.uint32)) & np.uint32(1))
            texts = column(batch, "text").take(pa.array(marked)).cast(pa.string())
            sids = [_identity(s)[0] for run in runs(texts) for s in shingle_sets(run, words)]
            yield pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), texts], names=["sid", "text"])

    found = rows.mapInArrow(work, "sid bigint, text string")
    return found.join(needed.select("sid"), "sid", "left_semi").groupBy("sid").agg(F.first("text").alias("text"))


def similar_texts(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, least: int = LEAST,
) -> DataFrame:
    """One row per document: id, n_shingles, component_id (and f1, f2, the identity of its set).

    Words are lower-cased in A-Z and end at blanks and the characters from tab to carriage return. A
    text of fewer than `words` words is one shingle; null texts and texts without words have none and link with
    nothing, as do rows with a null id (their component is null). Two sets link where the intersection
    has at least `least` per cent of the union. Repeated rows and other texts with the same set are in one component.
    Rows with the same id are one node. Shingles and sets are told apart by 64 and 128 bits.
    """
    shape = Shape(least)
    rows = docs.select(docs[doc_id].alias("id"), docs[text].cast("string").alias("text"))
    named = _written(_rows(rows, words, shape, False), "texts")
    sets = _rows(rows.where("id IS NOT NULL"), words, shape, True).where("n > 0").groupBy("f1", "f2").agg(
        F.min("id").alias("rep"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("sketch").alias("sketch")
    )
    sets = _written(sets.withColumn("sid", F.col("f1")), "sets")

    postings = _postings(sets, shape)
    often = postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    shared = _written(_postings(sets, shape).join(often, "token"), "postings")

    # Frequent tokens of each set that has some; there are no more of them than its prefix has tokens.
    frequent = shared.where(f"df > {RARE}").groupBy("sid", "n").agg(
        F.collect_list("token").alias("tokens"), F.collect_list(F.when(F.col("df") > BLOCK_ROWS, F.col("token"))).alias("often")
    )
    is_dense = F.udf(lambda n, f: shape.dense(n, f), "boolean")
    frequent = frequent.withColumn("dense", is_dense("n", F.size("tokens")))
    heads = sets.select("sid", F.expr(f"substring(prefix, 1, {8 * KEYS})").alias("keys"), "sketch", "rep")
    frequent = _written(frequent.join(heads, "sid"), "frequent")

    # Large families first: what their links join takes part in the rest as one.
    firsts = F.udf(lambda raw: np.frombuffer(raw, dtype=np.int64).tolist(), "array<bigint>")
    dense = frequent.where("dense").select("sid", "n", "rep", firsts("keys").alias("first"))
    dense_bodies = _written(_bodies(rows, dense.select("sid", "rep"), words), "dense_bodies")
    joined = _written(_dense_links(dense, dense_bodies, shape, words), "dense_links")
    parts = components(joined).select(F.col("node").alias("sid"), F.col("component").alias("part"))
    frequent = _written(frequent.drop("rep").join(parts, "sid", "left").withColumn("part", F.coalesce("part", "sid")), "parts")

    groups = shared.where(f"df <= {RARE}").groupBy(F.col("token").alias("sig"), "df").agg(F.collect_list(F.struct("sid", "n")).alias("members"))
    singles = _listed_pairs(groups, shape)
    # Of each pair: shared rare tokens, and the signature that covers most pairs.
    singles = singles.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("common"), F.max(F.struct("df", "sig")).alias("cover"))
    few = frequent.select("sid", F.size("tokens").alias("f"), "part")
    for side in ("a", "b"):
        singles = singles.join(few.withColumnsRenamed({"sid": side, "f": f"f{side}", "part": f"part_{side}"}), side, "left")
    singles = singles.where("coalesce(part_a, a) <> coalesce(part_b, b)")
    singles = _written(singles.where(_enough(shape)).select("a", "b", "cover.sig"), "singles")
    combined = _signature_pairs(frequent, shape).groupBy("a", "b").agg(F.max(F.struct("df", "sig")).alias("cover")).select("a", "b", "cover.sig")
    pairs = _written(singles.unionByName(combined).groupBy("a", "b").agg(F.max("sig").alias("cover")), "pairs")

    # Units of work: covers with many pairs are split, those with few share a unit.
    total = pairs.count()
    sizes = pairs.groupBy("cover").count().withColumn("parts", F.ceil(F.col("count") / UNIT_PAIRS))
    units = max(1, -(-total // UNIT_PAIRS))
    pairs = pairs.join(sizes.select("cover", "parts"), "cover")
    pairs = pairs.withColumn("unit", F.pmod(F.xxhash64("cover", F.pmod(F.xxhash64("a"), F.col("parts"))), F.lit(units)))
    pairs = _written(pairs.select("a", "b", "unit"), "units")

    needed = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    needed = _written(needed.join(sets.select("sid", "rep"), "sid"), "needed")
    others = needed.join(dense.select("sid"), "sid", "left_anti")
    bodies = _written(_bodies(rows, others, words), "bodies").unionByName(dense_bodies)
    links = _written(_verified(pairs, bodies, shape, words), "links").unionByName(joined)

    reps = sets.select("sid", "rep")
    edges = links.join(reps.withColumnsRenamed({"sid": "a", "rep": "x"}), "a").join(reps.withColumnsRenamed({"sid": "b", "rep": "y"}), "b")
    reached = components(edges.select(F.col("x").alias("a"), F.col("y").alias("b")))
    classes = sets.select("f1", "f2", "rep").join(reached, F.col("rep") == F.col("node"), "left")
    classes = classes.select("f1", "f2", F.coalesce("component", "rep").alias("component"))
    out = named.join(classes, ["f1", "f2"], "left")
    return out.select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"), "f1", "f2",
    )


def _enough(shape: Shape):
    """Whether two sets share enough of their prefixes: the one whose prefix ends first finds all
    tokens of its prefix that both have in the other's, and may miss only so many."""

    def check(na, nb, common, fa, fb):
        import pandas as pd

        a, b, least = na.to_numpy(), nb.to_numpy(), shape.overlap(na.to_numpy(), nb.to_numpy())
        length = {n: shape.prefix(n) for n in {*a.tolist(), *b.tolist()}}
        wanted = [np.fromiter((length[x] for x in n.tolist()), dtype=np.int64, count=len(n)) - (n - least) for n in (a, b)]
        most = common.to_numpy() + np.minimum(fa.fillna(0).to_numpy(), fb.fillna(0).to_numpy())
        return pd.Series(most >= np.minimum(*wanted))

    return F.pandas_udf(check, "boolean")("na", "nb", "common", "fa", "fb")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, least: int = LEAST) -> DataFrame:
    """The documents without further members of a component: the one with the smallest id stays, as it was.

    Rows with a null id stay, and so do other texts under the id that stays unless their sets are equal.
    """
    found = similar_texts(docs, doc_id, text, words, least)
    ids, = unused(docs, "kept_id")
    gone = found.where(F.col(doc_id) != F.col("component_id")).select(F.col(doc_id).alias(ids)).distinct()
    rest = docs.join(gone, docs[doc_id] == gone[ids], "left_anti")
    repeated = found.where(F.col(doc_id).isNotNull()).groupBy(doc_id).count().where("count > 1").select(F.col(doc_id).alias(ids))
    if repeated.isEmpty():
        return rest
    return rest.join(repeated, rest[doc_id] == repeated[ids], "left_anti").unionByName(
        rest.join(repeated, rest[doc_id] == repeated[ids], "left_semi").dropDuplicates([doc_id, text])
    )


_ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) END AS shingles
  FROM w),
t AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(node, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
least AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, len(shingles)::BIGINT AS n_shingles, component_id
FROM s JOIN least ON s.doc_id = node
"""


@query("op3_ngram_jaccard_join", _ORACLE)
def op3(spark, folder):
    """Components of documents with nearly the same shingles."""
    return similar_texts(table(spark, folder, "documents")).drop("f1", "f2")
