"""Operator 1: near copies among embeddings, by product quantisation.

Equal vectors are one to begin with. The others are dealt to coarse lists; what is left of a vector
after its list's centre is coded in subspaces. Every vector is then looked up in all lists that a
linked vector may lie in: distances to the coded vectors of a list are one product of matrices,
every vector that may be near enough (its own coding error is known) is compared exactly. Links are
counted and joined up inside the task; no list of pairs leaves it.

Which lists are probed. For a vector x of list a and another list c let h be the distance of x from
the plane midway between both centres. If x and y of list c are at most r apart, the two distances
from the plane add up to no more than r, so one of them is r / 2 or less: with a `reach` of one half, where
each vector probes the lists with h <= reach * r, no link is lost. A smaller reach probes fewer lists and loses
pairs whose difference lies mostly in one direction; with many dimensions such pairs are rare.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import components, query, table
from .text import column

LEAST = 0.9
REACH = 0.5
# Vectors that centres and codewords are fitted to. All vectors are indexed.
SAMPLE = 20_000
MOST_LISTS = 4096
# Lists for each square root of the number of vectors. A product of matrices is cheaper than a row for one more list.
LISTS = 0.25
SUBSPACES, WORDS = 8, 256
# Vectors of a list in a unit of work, and blocks of as many that are looked up there; longer lists are worked on in blocks.
BLOCK, QUERY_BLOCKS = 2048, 4
_PAIRS = 1 << 16


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(points), dtype=np.int64)
    for a in range(0, len(points), 4096):
        part = points[a : a + 4096]
        out[a : a + 4096] = ((centres**2).sum(axis=1) - 2 * part @ centres.T).argmin(axis=1)
    return out


def _centres(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k-means from evenly chosen points. Centres without points stay where they are."""
    centres = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)].copy()
    for _ in range(rounds):
        mine = _nearest(points, centres)
        size = np.bincount(mine, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, mine, points)
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    return np.unique(centres, axis=0)


class Quantiser:
    """Coarse centres and, for every subspace, codewords of what is left."""

    def __init__(self, sample: np.ndarray, lists: int):
        self.centres = _centres(sample, lists)
        self.width = sample.shape[1]
        left = sample - self.centres[_nearest(sample, self.centres)]
        self.cuts = np.array_split(np.arange(self.width), min(SUBSPACES, self.width))
        self.words = [_centres(left[:, cut], WORDS, 5) for cut in self.cuts]

    def codes(self, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code of every subspace, and the length of the coding error."""
        out, error = np.empty((len(left), len(self.cuts)), dtype=np.uint8), np.zeros(len(left))
        for m, (cut, words) in enumerate(zip(self.cuts, self.words)):
            code = _nearest(left[:, cut], words)
            out[:, m] = code
            error += ((left[:, cut] - words[code]) ** 2).sum(axis=1)
        return out, np.sqrt(error)

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """What the codes stand for, without the list's centre."""
        out = np.empty((len(codes), self.width))
        for m, (cut, words) in enumerate(zip(self.cuts, self.words)):
            out[:, cut] = words[codes[:, m]]
        return out

    def beyond(self, points: np.ndarray, own: np.ndarray, other: np.ndarray) -> np.ndarray:
        """Distance of each point from the plane between its own and another centre (row by row, so always the same)."""
        a, c = self.centres[own], self.centres[other]
        gap = np.sqrt(((a - c) ** 2).sum(axis=1))
        rise = ((points - c) ** 2).sum(axis=1) - ((points - a) ** 2).sum(axis=1)
        return rise / (2 * np.maximum(gap, 1e-300))

    def probes(self, points: np.ndarray, own: np.ndarray, margin: float) -> list[np.ndarray]:
        """The lists that each point has to be looked up in, its own among them."""
        far = (self.centres**2).sum(axis=1) - 2 * points @ self.centres.T
        far -= far[np.arange(len(points)), own][:, None]
        inner = self.centres[own] @ self.centres.T
        norm = (self.centres**2).sum(axis=1)
        gap = np.sqrt(np.maximum(norm[own][:, None] + norm - 2 * inner, 1e-18))
        row, lists = np.nonzero(far <= 2 * gap * (margin + 1e-6))
        sure = (lists == own[row]) | (self.beyond(points[row], own[row], lists) <= margin)
        row, lists = row[sure], lists[sure]
        return np.split(lists, np.searchsorted(row, np.arange(1, len(points))))


def _padded(arrays: pa.Array, width: int) -> np.ndarray:
    """The vectors as rows, in their own precision, with zeros behind shorter ones."""
    if isinstance(arrays, pa.ChunkedArray):
        arrays = arrays.combine_chunks()
    length = np.diff(arrays.offsets.to_numpy())
    flat = np.asarray(arrays.flatten())
    out = np.zeros((len(length), width), dtype=flat.dtype)
    out[np.arange(width)[None, :] < length[:, None]] = flat
    return out


def _matrix(column_: pa.ChunkedArray, kind, width: int) -> np.ndarray:
    """Binary values of the same length as rows of numbers."""
    return np.frombuffer(b"".join(column_.to_pylist()), dtype=kind).reshape(-1, width)


def _unit(rows: np.ndarray) -> np.ndarray:
    """The rows in double precision, scaled to length 1."""
    out = rows.astype(np.float64)
    out /= np.abs(out).max(axis=1, initial=1e-300)[:, None]  # no overflow of the squares
    return out / np.sqrt((out * out).sum(axis=1))[:, None]


def _roots(a: np.ndarray, b: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Smallest id that links (a[i], b[i]) reach from each position."""
    root = ids.copy()
    while True:
        before = root.copy()
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            return root


def links(
    vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = LEAST, reach: float = REACH,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    n_links counts the other rows whose vector has a cosine of at least `least` with this one;
    component_id is the smallest id that links reach. Vectors that are null, empty, zero or hold null or
    non-finite components, and rows with a null id, link with nothing and are their own component.
    Shorter vectors count as having zeros behind. Equal vectors link. Rows with the same id are one
    node of a component, though each is counted as a link.
    """
    id_type = vectors.schema[vec_id].dataType
    single = vectors.schema[embedding].dataType.elementType.simpleString() == "float"
    v = vectors[embedding] if single else vectors[embedding].cast("array<double>")
    kind = np.float32 if single else np.float64
    sound = vectors[vec_id].isNotNull() & F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0), F.lit(False)
    )
    rows = vectors.select(vectors[vec_id].alias("id"), F.when(sound, v).alias("v"))
    rows = rows.withColumns({"h1": F.xxhash64("v"), "h2": F.xxhash64(F.lit(1), "v")})
    distinct = rows.where("v IS NOT NULL").groupBy("h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("n"), F.first("v").alias("v"))
    distinct = cut_lineage(distinct)
    figures = distinct.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    if not figures["n"]:
        return rows.select(
            F.col("id").alias(vec_id), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept")
        )
    width, radius = figures["width"], float(np.sqrt(max(0.0, 2 - 2 * least)))
    sample = _unit(_padded(distinct.orderBy("h1", "h2").limit(SAMPLE).select("v").toArrow().column("v"), width))
    wanted = int(min(MOST_LISTS, max(1, LISTS * figures["n"] ** 0.5)))
    shared = rows.sparkSession.sparkContext.broadcast(Quantiser(sample, wanted))
    margin = reach * radius
    rep_type = id_type.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            raw = _padded(column(batch, "v"), width)
            points = _unit(raw)
            own = _nearest(points, coder.centres)
            codes, error = coder.codes(points - coder.centres[own])
            probes = []
            for a in range(0, len(points), 1024):
                probes += coder.probes(points[a : a + 1024], own[a : a + 1024], margin)
            yield pa.RecordBatch.from_arrays(
                [
                    *[column(batch, c) for c in ("h1", "h2", "rep", "n")], pa.array([p.tobytes() for p in raw], pa.binary()),
                    pa.array(own, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error, pa.float64()),
                    pa.array(probes, pa.list_(pa.int32())),
                ],
                names=["h1", "h2", "rep", "n", "x", "own", "codes", "error", "probes"],
            )

    indexed = cut_lineage(distinct.mapInArrow(
        index, f"h1 bigint, h2 bigint, rep {rep_type}, n bigint, x binary, own int, codes binary, error double, probes array<int>"
    ))
    # Blocks of each list and of those that probe it: one row per list.
    asked = indexed.select(F.explode("probes").alias("list")).groupBy("list").agg(F.ceil(F.count("*") / (QUERY_BLOCKS * BLOCK)).alias("q_blocks"))
    held = indexed.groupBy(F.col("own").alias("list")).agg(F.ceil(F.count("*") / BLOCK).alias("l_blocks"))
    sizes = asked.join(held, "list")

    def dealt(side: DataFrame, mine: str, others: str, salt: int) -> DataFrame:
        """Rows with the units of work they belong to: (list, block of queries, block of the list)."""
        side = side.join(F.broadcast(sizes), "list")  # at most MOST_LISTS rows
        side = side.withColumn(mine[0], F.pmod(F.xxhash64(F.lit(salt), "h1"), F.col(mine)))
        return side.withColumn(others[0], F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(others) - 1))).drop("q_blocks", "l_blocks")

    queries = dealt(indexed.select(F.explode("probes").alias("list"), "h1", "h2", "rep", "n", "x", "own"), "q_blocks", "l_blocks", 2)
    lists = dealt(indexed.select(F.col("own").alias("list"), "h1", "h2", "rep", "n", "x", "codes", "error"), "l_blocks", "q_blocks", 3)

    def compare(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        coder, here = shared.value, key[0].as_py()
        right = right.rename_columns([c.removeprefix("of_") for c in right.column_names])
        nq, nl = left.num_rows, right.num_rows
        q, x = (_unit(_matrix(t.column("x"), kind, width)) for t in (left, right))
        coded = coder.decoded(_matrix(right.column("codes"), np.uint8, len(coder.cuts))).astype(np.float32)
        error = right.column("error").to_numpy() if nl else np.zeros(0)
        # Half the square of the distance is compared, in single precision, with more room than its rounding takes.
        bound = ((radius + error + 1e-5) ** 2 / 2 + 1e-4 - (coded.astype(np.float64) ** 2).sum(axis=1) / 2).astype(np.float32)
        residual = (q - coder.centres[here]).astype(np.float32)
        size = (residual * residual).sum(axis=1) / 2
        found_a, found_b = [], []
        for a in range(0, nq, 256):
            i, j = np.nonzero(size[a : a + 256, None] - residual[a : a + 256] @ coded.T <= bound)
            for s in range(0, len(i), _PAIRS):
                ii, jj = i[s : s + _PAIRS] + a, j[s : s + _PAIRS]
                near = np.einsum("ij,ij->i", q[ii], x[jj]) >= least
                found_a.append(ii[near])
                found_b.append(jj[near])
        a = np.concatenate(found_a) if found_a else np.zeros(0, dtype=np.int64)
        b = np.concatenate(found_b) if found_b else np.zeros(0, dtype=np.int64)
        keys = [np.concatenate([t.column(h).to_numpy() for t in (left, right)]) for h in ("h1", "h2")]
        same = (keys[0][a] == keys[0][b + nq]) & (keys[1][a] == keys[1][b + nq])
        a, b = a[~same], b[~same]
        own = left.column("own").to_numpy()
        inner = own[a] == here
        # A pair that is also found from the other side counts in the list of the smaller number.
        twice = np.zeros(len(a), dtype=bool)
        outer = np.flatnonzero(~inner & (own[a] < here))
        for s in range(0, len(outer), _PAIRS):
            at = outer[s : s + _PAIRS]
            twice[at] = coder.beyond(x[b[at]], np.full(len(at), here), own[a[at]]) <= margin
        a, b, inner = a[~twice], b[~twice], inner[~twice]
        weight = np.concatenate([t.column("n").to_numpy() for t in (left, right)])
        ids = np.concatenate([left.column("rep").to_numpy(zero_copy_only=False), right.column("rep").to_numpy(zero_copy_only=False)])
        order, rank = np.unique(ids, return_inverse=True)
        root = order[_roots(a, b + nq, rank)]
        count = np.bincount(a, weights=weight[b + nq], minlength=nq + nl).astype(np.int64)
        count[nq:] = np.bincount(b, weights=weight[a] * ~inner, minlength=nl)[:nl] if len(b) else 0
        at = np.flatnonzero((count > 0) | (root != ids))
        reps = pa.array(ids[at])
        return pa.Table.from_arrays(
            [pa.array(keys[0][at]), pa.array(keys[1][at]), reps, pa.array(root[at]), pa.array(count[at], pa.int64())],
            names=["h1", "h2", "rep", "root", "links"],
        )

    unit = ["list", "q", "l"]
    theirs = lists.select(*[F.col(c).alias(f"of_{c}") for c in lists.columns])
    schema = f"h1 bigint, h2 bigint, rep {rep_type}, root {rep_type}, links bigint"
    found = cut_lineage(queries.groupBy(*unit).cogroup(theirs.groupBy(*[f"of_{u}" for u in unit])).applyInArrow(compare, schema))
    reached = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")).where("a <> b"))
    counted = found.groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    per_vector = distinct.select("h1", "h2", "rep", "n").join(counted, ["h1", "h2"], "left")
    per_vector = per_vector.join(reached, per_vector["rep"] == reached["node"], "left").select(
        "h1", "h2", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component")
    )
    out = rows.select("id", F.when(F.col("v").isNotNull(), F.col("h1")).alias("h1"), "h2").join(per_vector, ["h1", "h2"], "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


_ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(node, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT e.vec_id,
  (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
  (SELECT min(other) FROM reach r WHERE r.node = e.vec_id) AS component_id,
  e.vec_id = (SELECT min(other) FROM reach r WHERE r.node = e.vec_id) AS kept
FROM embeddings e
"""


@query("op1_embedding_near_dedup", _ORACLE)
def op1(spark, folder):
    """Links and components of all vectors."""
    return links(table(spark, folder, "embeddings"))
