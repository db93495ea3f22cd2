"""Exact top-k search by Fagin's threshold algorithm.

Vectors are turned into whole numbers and dealt to blocks of bounded size.  In a
block, each dimension has a list of the candidates sorted by it.  A query walks
all lists at once, down where its own component is positive and up where it is
negative, and scores whatever it meets for the first time by looking up the
whole vector.  What it has not met yet cannot score more than the sum, over the
lists, of its component times the value just read.  Once that bound is below
the k-th best score, the block is done.  The best of all blocks are then ranked.

Every query meets every block of candidates; blocks of queries go to blocks of
candidates, so no task holds more than one block of either.  Query and
candidate rows are told apart by a number of the row, given when the whole
numbers are written to the shared folder.

Defined cases: vectors that are null, or hold null or non-finite components,
take no part; rows are scored against rows of as many components, and empty
vectors score 0; equal vectors are all candidates; ids that repeat are separate
rows; a null id is a candidate after all others of its score and never a query;
a query without any candidate gives no row.  Scores must fit a 64-bit integer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pairwright.llm.frames import landed

BLOCK = 8192
QUERY_BLOCK = 2048
FIRST_DEPTH = 8
# Products summed below this are exact in floating point.
EXACT = 2.0**53


class Block:
    """Candidates with one sorted list per dimension."""

    def __init__(self, vectors: np.ndarray):
        self.whole = vectors
        self.size, self.width = vectors.shape
        self.quick = vectors.astype(np.float64)
        self.most = float(np.abs(self.quick).max()) if vectors.size else 0.0
        self.rising = np.argsort(vectors, axis=0, kind="stable")
        self.read = 0

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        if self.most * float(np.abs(query.astype(np.float64)).sum()) < EXACT:
            return (self.quick[rows] @ query.astype(np.float64)).astype(np.int64)
        return self.whole[rows] @ query

    def search(self, query: np.ndarray, k: int, own: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows and scores of the ``k`` best, rows of ``own`` left out; of equals those first by ``ids``."""
        met = np.zeros(self.size, dtype=bool)
        met[own] = True
        down, up = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        rows, values = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        done, depth = 0, min(FIRST_DEPTH, self.size)
        while True:
            fresh = np.zeros(self.size, dtype=bool)
            if len(down):
                fresh[self.rising[self.size - depth : self.size - done, down]] = True
            if len(up):
                fresh[self.rising[done:depth, up]] = True
            if depth == self.size or not len(down) + len(up):
                fresh[:] = True  # nothing is left below, or every score is 0
                depth = self.size
            new = np.flatnonzero(fresh & ~met)
            met[new] = True
            self.read += len(new)
            rows, values = np.concatenate([rows, new]), np.concatenate([values, self.scores(new, query)])
            best = np.lexsort((ids[rows], -values))[:k]
            rows, values = rows[best], values[best]
            if depth == self.size:
                return rows, values
            at = np.empty(self.width, dtype=np.int64)
            at[:] = 0
            at[down] = self.rising[self.size - depth, down]
            at[up] = self.rising[depth - 1, up]
            bound = sum(int(self.whole[r, j]) * int(query[j]) for j, r in enumerate(at) if query[j])
            if len(rows) == k and values[-1] > bound:
                return rows, values
            done, depth = depth, min(2 * depth, self.size)


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """``vec_id``, ``row``, ``width`` and the whole numbers of every vector that takes part."""
    vector = F.col(vector_column)
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(vector, lambda x: x.cast("double")).alias("v"),
    ).where(F.col("v").isNotNull() & ~F.exists("v", bad))
    return rows.select(
        "vec_id",
        F.monotonically_increasing_id().alias("row"),
        F.size("v").alias("width"),
        F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"),
    )


def _matrix(rows: pa.Table) -> np.ndarray:
    column = rows.column("v").combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(rows.num_rows, -1)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """The ``k`` highest inner products of every query row; ``is_query`` is a condition on ``vec_id``."""
    rows = landed(whole_vectors(vectors, id_column, vector_column, scale), "vectors")
    wanted = rows.where(is_query)
    sizes = rows.agg(F.count(F.lit(1)).alias("all"), F.count_if(is_query).alias("asked")).first()
    blocks = max(1, -(-sizes["all"] // block))
    query_blocks = max(1, -(-sizes["asked"] // query_block))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    asked = wanted.withColumn("query_block", dealt(query_blocks)).withColumn("block", every(blocks))
    offered = rows.withColumn("block", dealt(blocks)).withColumn("query_block", every(query_blocks))
    keys = ("width", "block", "query_block")

    def search(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if queries.num_rows and candidates.num_rows:
            found, asked_ = Block(_matrix(candidates)), _matrix(queries)
            row = candidates.column("row").to_numpy()
            ids = pc.fill_null(candidates.column("vec_id"), np.iinfo(np.int64).max).to_numpy()
            # of equal scores the smaller id, then the smaller row
            place = np.empty(len(row), dtype=np.int64)
            place[np.lexsort((row, ids))] = np.arange(len(row))
            where = {int(r): n for n, r in enumerate(row)}
            for n, r in enumerate(queries.column("row").to_pylist()):
                own = np.array([where[r]] if r in where else [], dtype=np.int64)
                best, score = found.search(asked_[n], k, own, place)
                out.append((np.full(len(best), n), best, score))
        asked_at, best, score = (np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True)) if out else (
            np.empty(0, np.int64),
        ) * 3
        q, c = queries.take(pa.array(asked_at)), candidates.take(pa.array(best))
        return pa.table(
            {
                "query_row": q.column("row"),
                "query_id": q.column("vec_id"),
                "vec_id": c.column("vec_id"),
                "row": c.column("row"),
                "score": pa.array(score),
            }
        )

    schema = "query_row long, query_id long, vec_id long, row long, score long"
    found = asked.groupBy(*keys).cogroup(offered.groupBy(*keys)).applyInArrow(search, schema)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


ORACLE = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e::DOUBLE[], c.e::DOUBLE[]) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
