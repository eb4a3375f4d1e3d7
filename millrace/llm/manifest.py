"""Operator 13: a Merkle manifest of a table, checked leaf by leaf with a recursive query.

Every row is a leaf. The leaves of a part (a language) are paired into nodes, the nodes into nodes,
up to one subroot; the subroots, in order of their parts, are paired likewise up to the root. The
tree is built in blocks of 2^LEVELS neighbouring nodes and stored as node rows that name their parent
2^LEVELS times as wide, with the siblings passed on the way. A recursive query climbs from every
leaf by these links, gathers the siblings and folds a (perhaps tampered) digest into a root.

Digests are combined as lower-case hex text and stored as 32 bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, scratch_path
from .base import query, table, unused

# Levels of the tree that one link climbs. Every round of the recursive query writes all climbing
# rows anew, so that with 10 levels a link, 10^9 leaves take three rounds and not thirty.
LEVELS = 10
# A step of a climb: one byte that tells where the sibling stands, and the sibling's digest.
LEFT, RIGHT, NONE = b"\0", b"\1", b"\2" + bytes(32)
STEP = 33
# What the last node names as its parent.
TOP = "root"

MORE_ROUNDS = {"spark.sql.cteRecursionRowLimit": "-1", "spark.sql.cteRecursionLevelLimit": "-1"}


def sha(value: Column) -> Column:
    return F.unhex(F.sha2(value, 256))


def text_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def fields(*values: Column) -> Column:
    """The values as one text: '-' for null, else the bytes of UTF-8, ':' and the value."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def positions(rows: DataFrame, keys: list[str], order: list[str], place: str, total: str) -> DataFrame:
    """`rows` with its 0-based place among the rows of equal keys, in the given order, and their number.

    Rows are dealt by ranges of keys and order, so one key may fill many tasks. A row's number
    within its task is stored with it; what stood in earlier tasks comes from one count per task
    and key. Nulls come first and are equal. Rows that agree in keys and order meet in one task
    and take any order among themselves.
    """
    number, task, first, here, before = unused(rows, "number", "task", "first", "here", "before")
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    # The task's number stands above bit 33.
    stored = cut_lineage(dealt.withColumn(number, F.monotonically_increasing_id()))
    stored = stored.withColumn(task, F.shiftright(number, 33))
    groups = stored.groupBy(*keys, task).agg(F.min(number).alias(first), F.count("*").alias(here))
    over = "PARTITION BY " + ", ".join(f"`{k}`" for k in keys) if keys else ""
    groups = groups.select(
        *[F.col(k).alias(f"{first}_{k}") for k in keys], F.col(task).alias(f"{first}_task"), first,
        F.expr(f"sum(`{here}`) OVER ({over} ORDER BY `{task}`) - `{here}`").alias(before),
        F.expr(f"sum(`{here}`) OVER ({over})").alias(total),
    )
    same = stored[task] == groups[f"{first}_task"]
    for k in keys:
        same = same & stored[k].eqNullSafe(groups[f"{first}_{k}"])
    return stored.join(groups, same).select(*[stored[c] for c in rows.columns], (F.col(number) - F.col(first) + F.col(before)).alias(place), total)


def climbs(digests: list[bytes], levels: int) -> tuple[list[bytes], bytes]:
    """The steps of every digest up to the node `levels` above, and that node."""
    steps: list[list[bytes]] = [[] for _ in digests]
    row = digests
    for level in range(levels):
        last = len(row) - 1
        for i, mine in enumerate(steps):
            node = i >> level
            if node & 1:
                mine.append(LEFT + row[node - 1])
            else:
                mine.append(RIGHT + row[node + 1] if node < last else NONE)
        texts = [d.hex() for d in row]
        row = [hashlib.sha256("".join(texts[i : i + 2]).encode()).digest() for i in range(0, len(row), 2)]
    return [b"".join(s) for s in steps], row[0]


def linked(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """`rows` (tree, place, total, digest and more) with block, steps and up.

    block is the parent's place, steps lead to it, up is its digest. A block has 2^levels rows of
    one tree at most, whatever the tree's size. A tree that fits in a block climbs only until one
    node is left.
    """
    out = rows.select("*", F.shiftright("place", levels).alias("block"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema) + ", steps binary, up binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.Table.from_batches(batches).sort_by("place")
        total = block["total"][0].as_py()
        steps, up = climbs(block["digest"].to_pylist(), min(levels, (total - 1).bit_length()))
        more = [pa.array(steps, pa.binary()), pa.array([up] * len(steps), pa.binary())]
        for batch in block.append_column("steps", more[0]).append_column("up", more[1]).to_batches():
            yield batch

    return out.groupBy("tree", "block").applyInArrow(work, schema)


def _name(tree, level: int, place):
    return F.concat_ws("/", tree.cast("string"), F.lit(level).cast("string"), place.cast("string"))


def build(leaves: DataFrame, path: str, levels: int = LEVELS) -> DataFrame:
    """Write all node rows of the trees in `leaves` (tree, place, total, digest and more); their tops.

    Below `path`, `level=0` holds the leaves and `level=10`, `level=20` and so on the nodes above
    them: node, parent, steps, up. The parent of a tree's highest row is `top/0/<tree>`, its place
    among the tops. The result has one row per tree: tree, digest.
    """
    spark, rows, level = leaves.sparkSession, leaves, 0
    tops = None
    while True:
        found = linked(rows, levels)
        last = F.col("total") <= (1 << levels)
        found = found.select(
            "*", _name(F.col("tree"), level, F.col("place")).alias("node"),
            F.when(last, _name(F.lit("top"), 0, F.col("tree"))).otherwise(_name(F.col("tree"), level + levels, F.col("block"))).alias("parent"),
        )
        found.write.parquet(f"{path}/level={level}")
        stored = spark.read.parquet(f"{path}/level={level}")
        firsts = stored.where(F.col("place") == F.shiftleft("block", levels))
        done = firsts.where(last).select("tree", F.col("up").alias("digest"))
        tops = done if tops is None else tops.unionByName(done)
        above = firsts.where(~last).select(
            "tree", F.col("block").alias("place"), F.expr(f"shiftright(total + {(1 << levels) - 1}, {levels})").alias("total"), F.col("up").alias("digest")
        )
        if above.isEmpty():
            return tops
        rows, level = above, level + levels


def _fold(digest: str, steps: str) -> str:
    """SQL: the digest that `steps` make of `digest`."""
    step = f"substring({steps}, {STEP} * i + 2, 32)"
    return f"""IF(length({steps}) = 0, {digest}, aggregate(sequence(0, length({steps}) div {STEP} - 1), {digest}, (d, i) ->
        unhex(sha2(lower(hex(CASE substring({steps}, {STEP} * i + 1, 1)
            WHEN X'00' THEN concat({step}, d) WHEN X'01' THEN concat(d, {step}) ELSE d END)), 256))))"""


def climb(leaves: DataFrame, nodes: DataFrame, keep: list[str], digest: str) -> DataFrame:
    """`keep`, the root that column `digest` of a leaf folds into, and the steps to it.

    leaves and nodes hold parent and steps; nodes are found by their node. One recursive query
    takes all leaves up at once, link by link.
    """
    spark = leaves.sparkSession
    for key, value in MORE_ROUNDS.items():
        spark.conf.set(key, value)
    a, b = unused(leaves.select(*keep), "parent", "folded")
    mine = ", ".join(f"`{c}`" for c in keep)
    theirs = ", ".join(f"c.`{c}`" for c in keep)
    names = ", ".join(f"`{c}`" for c in [*keep, a, b, "steps"])
    return spark.sql(f"""
        WITH RECURSIVE climb({names}) AS (
            SELECT {mine}, parent, {_fold(f"`{digest}`", "steps")}, steps FROM {{leaves}}
            UNION ALL
            SELECT {theirs}, n.parent, {_fold(f"c.`{b}`", "n.steps")}, concat(c.steps, n.steps)
            FROM climb c JOIN {{nodes}} n ON n.node = c.`{a}`)
        SELECT {mine}, `{b}` AS folded, steps FROM climb WHERE `{a}` = '{TOP}'""", leaves=leaves, nodes=nodes)


def manifest(
    docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), part: str = "lang",
    order: str = "doc_id", tampered: dict[str, Column] | None = None, levels: int = LEVELS,
) -> DataFrame:
    """One row per document: order, leaf, subroot, root, proof_sha256, folded_root, verified.

    A leaf is the digest of `columns`. The leaves of a part ascend by `order` (nulls first, rows
    with the same id by leaf, so that any order of the input gives the same tree); parts ascend by
    UTF-8 bytes, null first. `tampered` replaces columns; the leaf changed that way climbs with the
    siblings of the tree as it was, and is verified if it comes to the same root. proof_sha256
    digests the siblings on the way up, left to right as they are passed. A lone leaf is its
    subroot and a lone subroot the root, both without siblings.

    Null and empty columns make different leaves. Equal rows make equal leaves in neighbouring
    places. An empty table has no rows and no root. Other columns are not read.
    """
    spark = docs.sparkSession
    changed = tampered or {}
    leaf = sha(fields(*[docs[c] for c in columns]))
    other = sha(fields(*[changed.get(c, docs[c]) for c in columns]))
    same = F.lit(True)
    for c, value in changed.items():
        same = same & value.eqNullSafe(docs[c])
    rows = docs.select(docs[order].alias("id"), docs[part].cast("string").alias("part"), leaf.alias("digest"), F.when(~same, other).alias("other"))
    placed = positions(rows, ["part"], ["id", "digest"], "place", "total")
    placed = cut_lineage(placed)
    path = scratch_path(spark, "manifest")
    # Small tables are written, so that Spark knows their size when it plans a join.
    positions(placed.select(F.col("part").alias("of")).distinct(), [], ["of"], "tree", "trees").write.parquet(f"{path}/names")
    parts = spark.read.parquet(f"{path}/names")
    leaves = placed.join(parts, placed["part"].eqNullSafe(parts["of"])).select("tree", "place", "total", "digest", "id", "other")
    tops = build(leaves, f"{path}/parts", levels).join(parts, "tree")
    tops = cut_lineage(tops.select(F.lit("top").alias("tree"), F.col("tree").alias("place"), F.col("trees").alias("total"), "digest"))
    roots = build(tops, f"{path}/tops", levels)
    root = roots.first()
    if root is None:
        return rows.limit(0).select(
            F.col("id").alias(order), *[F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], F.lit(False).alias("verified")
        )
    kinds = ["node", "parent", "steps"]
    nodes = spark.read.parquet(f"{path}/parts").where("level > 0").select(*kinds)
    of_tops = spark.read.parquet(f"{path}/tops").select(*kinds)
    nodes = nodes.unionByName(of_tops).withColumn("parent", F.when(F.col("parent") == "top/0/top", TOP).otherwise(F.col("parent")))
    found = climb(
        spark.read.parquet(f"{path}/parts/level=0").withColumn("start", F.coalesce("other", "digest")), nodes, ["id", "digest", "tree"], "start"
    )
    subroots = spark.read.parquet(f"{path}/tops/level=0").select(F.col("place").alias("tree"), F.col("digest").alias("subroot"))
    found = found.join(subroots, "tree")
    siblings = F.regexp_replace(text_of(F.col("steps")), "02.{64}|0[01](.{64})", "$1")
    return found.select(
        F.col("id").alias(order), text_of(F.col("digest")).alias("leaf"), text_of(F.col("subroot")).alias("subroot"),
        F.lit(root["digest"].hex()).alias("root"), F.sha2(siblings, 256).alias("proof_sha256"),
        text_of(F.col("folded")).alias("folded_root"), (F.col("folded") == F.lit(bytes(root["digest"]))).alias("verified"),
    )


_ORACLE = """
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
    coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail,
    list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda crc, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, b)), 4294967295::BIGINT) AS crc
  FROM documents),
hashed AS (
  SELECT doc_id, lang, pos, n,
    sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
    sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS wrong,
    xor(crc, 4294967295) % 7 = 0 AS hit
  FROM leaves),
levels AS (
  SELECT lang, 0 AS level, pos, n, leaf AS h FROM hashed
  UNION ALL
  SELECT lang, level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM levels WHERE n > 1 GROUP BY lang, level, pos // 2),
tops AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n, lang, h
  FROM levels WHERE n = 1),
upper_levels AS (
  SELECT level, pos, n, h FROM tops
  UNION ALL
  SELECT level + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY pos))
  FROM upper_levels WHERE n > 1 GROUP BY level, pos // 2),
low_climb AS (
  SELECT doc_id, lang, 0 AS level, pos, n, leaf, CASE WHEN hit THEN wrong ELSE leaf END AS folded, '' AS proof FROM hashed
  UNION ALL
  SELECT c.doc_id, c.lang, c.level + 1, c.pos // 2, (c.n + 1) // 2, c.leaf,
    sha256(CASE WHEN c.pos % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END), c.proof || coalesce(s.h, '')
  FROM low_climb c LEFT JOIN levels s
    ON s.lang IS NOT DISTINCT FROM c.lang AND s.level = c.level AND s.pos = xor(c.pos, 1)
  WHERE c.n > 1),
high_climb AS (
  SELECT c.doc_id, t.level, t.pos, t.n, c.leaf, t.h AS subroot, c.folded, c.proof
  FROM low_climb c JOIN tops t ON t.lang IS NOT DISTINCT FROM c.lang WHERE c.n = 1
  UNION ALL
  SELECT c.doc_id, c.level + 1, c.pos // 2, (c.n + 1) // 2, c.leaf, c.subroot,
    sha256(CASE WHEN c.pos % 2 = 1 THEN s.h || c.folded ELSE c.folded || coalesce(s.h, '') END), c.proof || coalesce(s.h, '')
  FROM high_climb c LEFT JOIN upper_levels s ON s.level = c.level AND s.pos = xor(c.pos, 1)
  WHERE c.n > 1)
SELECT c.doc_id, c.leaf, c.subroot, r.h AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = r.h AS verified
FROM high_climb c JOIN upper_levels r ON r.n = 1
WHERE c.n = 1
"""


@query("op13_merkle_manifest", _ORACLE)
def op13(spark, folder):
    """The manifest of all documents, with every seventh document's n_chars one too high."""
    docs = table(spark, folder, "documents")
    hit = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 7 == 0
    return manifest(docs, tampered={"n_chars": F.when(hit, docs["n_chars"] + 1).otherwise(docs["n_chars"])})
