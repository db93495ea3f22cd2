"""Merkle manifest of a dataset, its blocks laid out after van Emde Boas.

Every row is a leaf, the SHA-256 of its fields.  The leaves of a source ascend by
id; every three neighbours become the hash of their digests' hexadecimal text
(the last ones fewer), level by level, until one is left, the source's subroot.
The sources' subroots, in order, give the root the same way.

- *Blocks.*  A tree is cut into aligned blocks of ``3 ** HEIGHT`` leaves, each
  built by one group of bounded size, whatever the size of a source.  The blocks'
  roots are the leaves of the next round, so rounds are few.
- *Layout.*  A block is one byte string of 32-byte digests.  A tree of h levels is
  its upper half, then each tree of the lower half, all of them laid out alike;
  :func:`addresses` is that recursion.  Building and the search for siblings both
  go by these addresses, and a path touches few neighbourhoods of the block.
- *Places.*  Leaves are sorted by ranges and counted per range; a leaf's place is
  its range's start and its number therein.  Equal rows may lie in several ranges.

A path is text: levels from the leaf on are parted by ``/``, and in a level ``|``
stands where the node itself is, between the digests before and after it.

Defined cases: a null field is ``-`` and an empty one ``0:``; a null source comes
first and is another than an empty one; a null id comes first and is not tampered
with; repeated ids are ordered by their leaf, and equal rows give equal rows of the
result; an only leaf is its source's subroot, an only subroot is the root, and a
proof without siblings is the hash of nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pairwright.llm.frames import landed
from pairwright.session import shuffle_partitions

RUN = 3
HEIGHT = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# --- addresses -----------------------------------------------------------------


def nodes_of(levels: int) -> int:
    """How many nodes a full tree of so many levels has."""
    return (RUN**levels - 1) // (RUN - 1)


@cache
def addresses(levels: int) -> tuple[np.ndarray, ...]:
    """For each level from the top on, the addresses of its nodes from left to right.

    The upper half of the levels comes first, then the trees of the lower half.
    """
    if levels == 1:
        return (np.zeros(1, dtype=np.int64),)
    upper = levels // 2
    top, below = addresses(upper), addresses(levels - upper)
    starts = nodes_of(upper) + nodes_of(levels - upper) * np.arange(RUN**upper)
    return top + tuple((starts[:, None] + level[None, :]).ravel() for level in below)


def block_levels(size: int, height: int) -> int:
    """Levels above the leaves in each block of a tree of so many leaves."""
    levels = 0
    while levels < height and RUN**levels < size:
        levels += 1
    return levels


def build_block(digests: bytes, levels: int) -> bytes:
    """A block in its layout, from its leaves' 32-byte digests."""
    store = np.zeros((nodes_of(levels + 1), 32), dtype=np.uint8)
    at = addresses(levels + 1)
    row = np.frombuffer(digests, dtype=np.uint8).reshape(-1, 32)
    store[at[levels][: len(row)]] = row
    for level in range(levels - 1, -1, -1):
        text, step = row.tobytes().hex().encode(), 64 * RUN
        above = b"".join(sha256(text[k : k + step]).digest() for k in range(0, len(text), step))
        row = np.frombuffer(above, dtype=np.uint8).reshape(-1, 32)
        store[at[level][: len(row)]] = row
    return store.tobytes()


def block_root(block: bytes, levels: int) -> str:
    at = 32 * int(addresses(levels + 1)[0][0])
    return block[at : at + 32].hex()


def block_paths(block: bytes, levels: int, leaves: int) -> list[str]:
    """The path of each leaf within its block."""
    at = addresses(levels + 1)
    counts = [leaves]
    for _ in range(levels):
        counts.append(-(-counts[-1] // RUN))
    counts.reverse()
    paths = [""]
    for level in range(1, levels + 1):
        places = (32 * at[level][: counts[level]]).tolist()
        digests = [block[p : p + 32].hex() for p in places]
        found = []
        for k in range(len(digests)):
            first = k - k % RUN
            step = "".join(digests[first:k]) + "|" + "".join(digests[k + 1 : first + RUN])
            above = paths[k // RUN]
            found.append(f"{step}/{above}" if above else step)
        paths = found
    return paths


def joined(*paths: str | None) -> str:
    """One path of several, the lower ones first."""
    return "/".join(p for p in paths if p)


def proof_digest(path: str) -> str:
    """The hash of a path's siblings, from left to right in each level."""
    return sha256(path.replace("/", "").replace("|", "").encode()).hexdigest()


def folded(digest: str, path: str) -> str:
    """What a leaf and its path give at the top."""
    for step in path.split("/") if path else ():
        before, after = step.split("|")
        digest = sha256(f"{before}{digest}{after}".encode()).hexdigest()
    return digest


# --- leaves and their places ---------------------------------------------------


def leaf(fields: dict[str, Column]) -> Column:
    """The leaf of a row: each field with its size in bytes before it, or a dash."""
    spelled = []
    for value in fields.values():
        text = value.cast("string")
        sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        spelled.append(F.coalesce(sized, F.lit("-")))
    return F.sha2(F.concat(*spelled), 256)


def placed(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with the place ``pos`` of each in its ``tree`` by ``order``, and the tree's ``size``.

    The order must not leave many rows equal, or they share a range.
    """
    spark = rows.sparkSession
    ranged = rows.repartitionByRange(shuffle_partitions(spark), "tree", *order)
    ranged = landed(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy("tree").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("_count"))
    offsets = offsets.select(
        "tree",
        "_range",
        F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_first"),
        F.sum("_count").over(Window.partitionBy("tree")).alias("size"),
    )
    nth = F.row_number().over(Window.partitionBy("tree", "_range").orderBy(*order))
    numbered = ranged.withColumn("_nth", nth).join(offsets, ["tree", "_range"])
    return numbered.select(*rows.columns, (F.col("_first") + F.col("_nth") - 1).alias("pos"), "size")


# --- trees ---------------------------------------------------------------------

BLOCKS = T.StructType(
    [
        T.StructField("tree", T.StringType()),
        T.StructField("block", T.LongType()),
        T.StructField("size", T.LongType()),
        T.StructField("leaves", T.LongType()),
        T.StructField("levels", T.IntegerType()),
        T.StructField("nodes", T.BinaryType()),
        T.StructField("root", T.StringType()),
    ]
)


def _in_block(height: int) -> Column:
    return F.floor(F.col("pos") / F.lit(RUN**height)).cast("long")


def blocks_of(nodes: DataFrame, height: int) -> DataFrame:
    """The blocks over ``nodes`` (``tree, pos, size, digest``)."""

    def build(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("pos")
        size = rows["size"][0].as_py()
        levels = block_levels(size, height)
        block = build_block(bytes.fromhex("".join(rows["digest"].to_pylist())), levels)
        values = [key[0].as_py(), key[1].as_py(), size, rows.num_rows, levels, block, block_root(block, levels)]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.string()]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names=BLOCKS.names)

    rows = nodes.select("tree", _in_block(height).alias("block"), "pos", "size", "digest")
    return rows.groupBy("tree", "block").applyInArrow(build, BLOCKS)


@dataclass(frozen=True)
class Forest:
    """Trees side by side: the blocks of each round, those over the leaves first."""

    rounds: list[DataFrame]
    height: int

    @property
    def roots(self) -> DataFrame:
        """``tree`` and its ``root``."""
        last = [b.where(F.col("size") <= RUN**self.height).select("tree", "root") for b in self.rounds]
        return reduce(DataFrame.unionByName, last)

    def above(self, blocks: int) -> DataFrame:
        """``tree, block, path``: what lies above the blocks of a round that are not their tree's only one."""
        upper = self.rounds[blocks + 1]
        if blocks + 2 < len(self.rounds):
            further = self.above(blocks + 1).withColumnRenamed("path", "above")
            upper = upper.join(further, ["tree", "block"], "left")
        else:
            upper = upper.withColumn("above", F.lit(None).cast("string"))
        return node_paths(upper).withColumnRenamed("pos", "block")

    @property
    def first_blocks(self) -> DataFrame:
        """The blocks over the leaves, with the path ``above`` each of them."""
        first = self.rounds[0]
        if len(self.rounds) == 1:
            return first.withColumn("above", F.lit(None).cast("string"))
        return first.join(self.above(0).withColumnRenamed("path", "above"), ["tree", "block"], "left")


def grown(nodes: DataFrame, height: int) -> Forest:
    """The trees over ``nodes`` (``tree, pos, size, digest``); only whether a round is the last reaches the driver."""
    rounds = []
    while True:
        rounds.append(landed(blocks_of(nodes, height), "blocks"))
        more = rounds[-1].where(F.col("size") > RUN**height)
        if more.isEmpty():
            return Forest(rounds, height)
        size = F.ceil(F.col("size") / F.lit(RUN**height)).cast("long")
        nodes = more.select("tree", F.col("block").alias("pos"), size.alias("size"), F.col("root").alias("digest"))


def node_paths(blocks: DataFrame) -> DataFrame:
    """``tree, pos, path`` of every leaf of some blocks (with ``above``)."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                paths = [joined(p, row["above"]) for p in block_paths(row["nodes"], row["levels"], row["leaves"])]
                first = row["block"] * RUN ** row["levels"]
                columns = ([row["tree"]] * len(paths), list(range(first, first + len(paths))), paths)
                kinds = (pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["tree", "pos", "path"]
                )

    return blocks.select("tree", "block", "leaves", "levels", "nodes", "above").mapInArrow(
        spell, "tree string, pos long, path string"
    )


# --- the manifest --------------------------------------------------------------


@dataclass(frozen=True)
class Manifest:
    """Leaves in their places, the trees of the sources, and the tree of their subroots."""

    leaves: DataFrame  # doc_id, leaf, other, tree, pos, size
    sources: Forest
    top: Forest
    subroots: DataFrame  # tree, subroot, pos
    root: str | None


def manifest(
    docs: DataFrame,
    other: dict[str, Column] | None = None,
    changed: Column | None = None,
    id_column: str = "doc_id",
    source_column: str = "source",
    fields: tuple[str, ...] = FIELDS,
    height: int = HEIGHT,
) -> Manifest:
    """The manifest of ``docs``.

    ``other`` are fields that differ in a copy to be checked against it; where
    ``changed`` is not true, that copy's row is the original.
    """
    columns = {f: F.col(f"`{f}`") for f in fields}
    own = leaf(columns)
    copy = F.when(changed, leaf({**columns, **(other or {})})) if changed is not None else F.lit(None).cast("string")
    source = F.col(f"`{source_column}`").cast("string")
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        own.alias("leaf"),
        copy.alias("other"),
        # sorts like the sources do, with the null source first
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"),
        F.monotonically_increasing_id().alias("_row"),
    )
    leaves = landed(placed(rows, ["doc_id", "leaf", "_row"]).drop("_row"), "leaves")
    sources = grown(leaves.select("tree", "pos", "size", F.col("leaf").alias("digest")), height)
    named = sources.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    subroots = landed(placed(named, ["name"]), "subroots")
    top = grown(subroots.select("tree", "pos", "size", "digest"), height)
    last = top.roots.first()
    return Manifest(
        leaves,
        sources,
        top,
        subroots.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "pos"),
        last["root"] if last else None,
    )


def proofs(made: Manifest) -> DataFrame:
    """Every leaf with its proof, and the root that its row (the other copy's, if changed) leads to."""
    height, root = made.sources.height, made.root
    subroot_paths = node_paths(made.top.first_blocks).select("pos", F.col("path").alias("last"))
    of_tree = made.subroots.join(subroot_paths, "pos").select("tree", "subroot", "last")
    blocks = made.sources.first_blocks.join(of_tree, "tree")
    leaves = made.leaves.select("doc_id", "leaf", "other", "tree", "pos", _in_block(height).alias("block"))
    schema = T.StructType(
        [
            leaves.schema["doc_id"],
            T.StructField("leaf", T.StringType()),
            T.StructField("subroot", T.StringType()),
            T.StructField("root", T.StringType()),
            T.StructField("proof_sha256", T.StringType()),
            T.StructField("folded_root", T.StringType()),
            T.StructField("verified", T.BooleanType()),
        ]
    )

    def prove(rows: pa.Table, found: pa.Table) -> pa.Table:
        block = found.to_pylist()[0]
        inner = block_paths(block["nodes"], block["levels"], block["leaves"])
        first = block["block"] * RUN ** block["levels"]
        above = joined(block["above"], block["last"])
        paths = [joined(inner[p - first], above) for p in rows["pos"].to_pylist()]
        own, other = rows["leaf"].to_pylist(), rows["other"].to_pylist()
        ends = [folded(o or d, p) for d, o, p in zip(own, other, paths, strict=True)]
        n = rows.num_rows
        return pa.table(
            [
                rows["doc_id"],
                rows["leaf"],
                pa.array([block["subroot"]] * n, pa.string()),
                pa.array([root] * n, pa.string()),
                pa.array([proof_digest(p) for p in paths], pa.string()),
                pa.array(ends, pa.string()),
                pa.array([e == root for e in ends], pa.bool_()),
            ],
            names=schema.names,
        )

    return leaves.groupBy("tree", "block").cogroup(blocks.groupBy("tree", "block")).applyInArrow(prove, schema)


def checked_copy(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Proofs of all rows of ``docs`` against a copy that lost line breaks.

    In the copy, rows whose id has an even crc32 have no line feeds in their text.
    """
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    changed = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return proofs(manifest(docs, {"text": text}, changed, height=height))


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER (ORDER BY doc_id) AS rid, doc_id, source,
    CASE WHEN doc_id IS NULL THEN '-' ELSE octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE octet_length(encode(source)) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE octet_length(encode(lang)) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-' ELSE octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars END AS head,
    text, replace(text, chr(10), '') AS short, doc_id::VARCHAR AS digits
  FROM documents
), h AS (
  SELECT rid, doc_id, source, digits,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(text)) || ':' || text END) AS leaf,
    sha256(head || CASE WHEN text IS NULL THEN '-' ELSE octet_length(encode(short)) || ':' || short END) AS cut
  FROM d
), crc AS (
  SELECT rid, 1 AS i, digits, 4294967295::BIGINT AS c FROM h
  UNION ALL
  SELECT rid, i + 1, digits, list_reduce([xor(c, ascii(substr(digits, i, 1))::BIGINT)] || [0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)
  FROM crc WHERE i <= length(digits)
), told AS (SELECT rid, xor(c, 4294967295) % 2 = 0 AS tampered FROM crc WHERE i = length(digits) + 1),
l AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM h LEFT JOIN told USING (rid)
), node AS (
  SELECT source, 0 AS lvl, pos, n, leaf AS digest FROM l
  UNION ALL
  SELECT source, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM node WHERE n > 1 GROUP BY source, lvl, pos // 3, n
), sub AS (
  SELECT source, lvl AS levels, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS n FROM node WHERE n = 1
), top AS (
  SELECT 0 AS lvl, pos, n, subroot AS digest FROM sub
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(digest, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 3, n
), step AS (
  SELECT l.rid, k AS step, node.pos AS place, l.pos // (3 ** k)::BIGINT AS me, digest
  FROM (SELECT l.*, unnest(range(0, levels)) AS k FROM l JOIN sub ON l.source IS NOT DISTINCT FROM sub.source) l
  JOIN node ON node.source IS NOT DISTINCT FROM l.source AND node.lvl = k
    AND node.pos // 3 = (l.pos // (3 ** k)::BIGINT) // 3
  UNION ALL
  SELECT l.rid, levels + k, top.pos, p // (3 ** k)::BIGINT, digest
  FROM (SELECT l.rid, levels, sub.pos AS p, unnest(range(0, (SELECT max(lvl) FROM top))) AS k
        FROM l JOIN sub ON l.source IS NOT DISTINCT FROM sub.source) l
  JOIN top ON top.lvl = k AND top.pos // 3 = (p // (3 ** k)::BIGINT) // 3
), path AS (
  SELECT rid, step, coalesce(string_agg(digest, '' ORDER BY place) FILTER (WHERE place < me), '') AS before,
    coalesce(string_agg(digest, '' ORDER BY place) FILTER (WHERE place > me), '') AS after FROM step GROUP BY rid, step
), proof AS (SELECT rid, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256 FROM path GROUP BY rid),
fold AS (
  SELECT rid, 0 AS step, CASE WHEN tampered THEN cut ELSE leaf END AS digest FROM l
  UNION ALL
  SELECT fold.rid, fold.step + 1, sha256(before || digest || after) FROM fold JOIN path ON path.rid = fold.rid AND path.step = fold.step
), folded AS (SELECT rid, arg_max(digest, step) AS folded_root FROM fold GROUP BY rid),
root AS (SELECT digest AS root FROM top WHERE n = 1)
SELECT l.doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN sub ON l.source IS NOT DISTINCT FROM sub.source JOIN folded ON folded.rid = l.rid LEFT JOIN proof ON proof.rid = l.rid, root
"""
