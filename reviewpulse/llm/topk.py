"""Exact top-k inner products of a query set against all rows, pruned by segment statistics."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import settle

# Resolutions, coarse to fine: (leading directions that are segments of their own, segments of all others), the first
# as shares of the vector's length.
LEVELS = ((0, 4), (1 / 4, 4), (3 / 4, 1))
# Survivors of a tile are scored as one product from this share on, pair by pair below.
DENSE = 1 / 64
# Rows per block of the two sides, and per tile of a task.
CANDIDATE_ROWS = 1 << 13
QUERY_ROWS = 1 << 12
TILE = (512, 2048)


def usable(vector: Column) -> Column:
    """Vectors that are not null and hold neither null nor non-finite components."""
    return vector.isNotNull() & ~F.coalesce(
        F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))), F.lit(True))


def directions(rows: np.ndarray) -> np.ndarray:
    """An orthogonal matrix that turns rows so that their first components hold most of their length.

    Turning both sides leaves inner products as they are, and makes the leading segments tell rows apart.
    """
    _, axes = np.linalg.eigh(rows.T @ rows / max(1, len(rows)))
    return axes[:, ::-1]


def edges_of(dim: int, level: tuple[float, int]) -> np.ndarray:
    """Where the segments of a resolution begin and end."""
    leading = int(level[0] * dim)
    return np.unique(np.concatenate([np.arange(leading), np.linspace(leading, dim, level[1] + 1).astype(int)]))


def segments(matrix: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Means and deviations of each row's segments, scaled by the root of the segment's length.

    For two rows q, c the sum over segments of len * ((mean_q - mean_c)^2 + (dev_q - dev_c)^2) is at most
    |q - c|^2, so the inner product of these statistics is at least that of the rows.
    """
    out = []
    for a, b in zip(edges, edges[1:]):
        if b == a + 1:
            out.append(matrix[:, a])  # no deviation
            continue
        out += [matrix[:, a:b].mean(1) * np.sqrt(b - a), matrix[:, a:b].std(1) * np.sqrt(b - a)]
    return np.stack(out, 1) if out else np.zeros((len(matrix), 1))


def exact(queries: np.ndarray, rows: np.ndarray, qi: np.ndarray, ci: np.ndarray) -> np.ndarray:
    """Integer inner products of given pairs."""
    return np.concatenate([np.einsum("ij,ij->i", queries[qi[k:k + 65536]], rows[ci[k:k + 65536]])
                           for k in range(0, max(1, len(qi)), 65536)])


def best(qi: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k first of each query by (score descending, id)."""
    order = np.lexsort((ids, -scores, qi))
    qi, ids, scores = qi[order], ids[order], scores[order]
    first = np.searchsorted(qi, qi, side="left")
    keep = np.arange(len(qi)) - first < k
    return qi[keep], ids[keep], scores[keep]


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> tuple:
    """Top k of each query among the rows of one block, its own id left out.

    Bounds are compared coarse to fine with the query's k-th score so far; inner products are computed
    for the survivors only, as one product where a tile has many. A small allowance covers the rounding of the bounds.
    """
    floats = queries.astype(np.float64), rows.astype(np.float64)
    turn = directions(floats[1])
    edges = [edges_of(rows.shape[1], level) for level in LEVELS]
    stats = [tuple(segments(side @ turn, e) for side in floats) for e in edges]
    # Integers of this size are exact as doubles.
    whole = np.abs(floats[0]).max(initial=0) * np.abs(floats[1]).max(initial=0) * rows.shape[1] < 2 ** 53
    slack = 1e-9 * (1 + np.sqrt((floats[0] ** 2).sum(1).max(initial=0) * (floats[1] ** 2).sum(1).max(initial=0)))
    found = (np.zeros(0, np.int64),) * 3
    for a in range(0, len(queries), TILE[0]):
        q = np.arange(a, min(a + TILE[0], len(queries)))
        held = (np.zeros(0, np.int64),) * 3
        limit = np.full(len(q), -np.inf)
        for c in range(0, len(rows), TILE[1]):
            coarse = stats[0][0][q] @ stats[0][1][c:c + TILE[1]].T
            if not c and coarse.shape[1] > 2 * k:
                # Scores of the rows that look best give the first limits; own ids only make them lower.
                seed = np.argpartition(-coarse, 2 * k, axis=1)[:, :2 * k]
                qi, ci = np.repeat(np.arange(len(q)), 2 * k), seed.ravel()
                scores = exact(queries[q], rows, qi, ci).astype(np.float64)
                scores[query_ids[q][qi] == ids[ci]] = -np.inf
                limit = -np.partition(-scores.reshape(len(q), -1), k - 1, axis=1)[:, k - 1]
            near = coarse >= (limit - slack)[:, None]
            for fine_q, fine_c in stats[1:]:
                # Finer bounds for the queries and rows that the coarser ones left.
                some_q, some_c = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
                near[np.ix_(some_q, some_c)] &= fine_q[q[some_q]] @ fine_c[c + some_c].T >= (limit[some_q] - slack)[:, None]
            some_q, some_c = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if whole and near.sum() > DENSE * near.size:
                product = floats[0][q[some_q]] @ floats[1][c + some_c].T
                qi, ci = np.nonzero(near[np.ix_(some_q, some_c)] & (product >= limit[some_q][:, None]))
                scores = product[qi, ci].astype(np.int64)
                qi, ci = some_q[qi], c + some_c[ci]
            else:
                qi, ci = np.nonzero(near)
                ci += c
                scores = exact(queries[q], rows, qi, ci)
            other = query_ids[q[qi]] != ids[ci]
            qi, ci, scores = qi[other], ci[other], scores[other]
            held = best(*(np.concatenate(x) for x in zip(held, (qi, ids[ci], scores))), k)
            filled, counts = np.unique(held[0], return_counts=True)
            last = np.cumsum(counts) - 1
            full = counts == k
            limit[filled[full]] = np.maximum(limit[filled[full]], held[2][last[full]])
        found = tuple(np.concatenate(x) for x in zip(found, (held[0] + a, held[1], held[2])))
    return query_ids[found[0]], found[1], found[2]


def matrix_of(column: pa.ChunkedArray) -> np.ndarray:
    """Integer vectors floor(64 x) of a list column whose lists have one length."""
    lists = column.combine_chunks()
    values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.float64)
    return np.floor(64 * values).reshape(len(lists), -1).astype(np.int64)


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
          vector_column: str = "embedding") -> DataFrame:
    """The k rows of highest integer inner product for each query row, ties to the smaller id.

    Returns ``query_id, rank, vec_id, score``. Components become floor(64 * x). Rows whose id is null or
    whose vector is null or holds null or non-finite components take no part; rows only meet rows of
    their vector's length. Rows with the query's own id are no candidates; other repeated rows count
    each; of rows that repeat a query's id the smallest vector asks.

    Both sides are dealt into blocks of bounded size, and each (query block, row block) cell is one
    task's work; a cell returns at most k rows per query.
    """
    rows = settle(vectors.select(F.col(f"`{id_column}`").alias("vec_id"), F.col(f"`{vector_column}`").alias("vector"),
                                 is_query.alias("asks")).filter(usable(F.col("vector")) & F.col("vec_id").isNotNull())
                  # By row, not by id, so that repeated ids spread; stored, so that a row keeps its block.
                  .withColumn("deal", F.xxhash64(F.monotonically_increasing_id())), "vectors")
    queries = rows.filter("asks").groupBy("vec_id", F.size("vector").alias("dim")).agg(
        F.min("vector").alias("vector")).withColumn("deal", F.xxhash64("vec_id"))
    n_rows, n_queries = rows.count(), queries.count()
    row_blocks, query_blocks = max(1, -(-n_rows // CANDIDATE_ROWS)), max(1, -(-n_queries // QUERY_ROWS))

    def dealt(df: DataFrame, own: str, blocks: int, other: str, others: int) -> DataFrame:
        block = F.pmod("deal", F.lit(blocks)).alias(own)
        return df.select("vec_id", "vector", "dim", block, F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other))

    left = dealt(queries, "q", query_blocks, "c", row_blocks).select("vec_id", "vector", "dim", F.col("q").cast("long"), F.col("c").cast("long"))
    right = dealt(rows.withColumn("dim", F.size("vector")), "c", row_blocks, "q", query_blocks).select(
        "vec_id", "vector", "dim", F.col("q").cast("long"), F.col("c").cast("long"))

    def cell(key: tuple, asked: pa.Table, held: pa.Table) -> pa.Table:
        q, v, s = search_block(asked.column("vec_id").to_numpy(), matrix_of(asked.column("vector")),
                               held.column("vec_id").to_numpy(), matrix_of(held.column("vector")), k) \
            if asked.num_rows and held.num_rows else (np.zeros(0, np.int64),) * 3
        return pa.table({"query_id": q, "vec_id": v, "score": s})

    cells = left.groupBy("dim", "q", "c").cogroup(right.groupBy("dim", "q", "c")).applyInArrow(
        cell, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return cells.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.vec) = len(q.vec)
  WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
