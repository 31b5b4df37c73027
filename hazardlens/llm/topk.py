"""Exact top-k inner products with the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCALE = 256.0
BLOCK = 4096
FIRST_DEPTH = 16


def integer_vector(vector: Column, scale: float = SCALE) -> Column:
    """``floor(scale * x)`` of every component, or null if any is null or not finite."""
    x = vector.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.when(~bad, F.transform(x, lambda v: F.floor(v * scale)))


def threshold_search(
    x: np.ndarray, ids: np.ndarray, order: np.ndarray, query: np.ndarray, own: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the ``k`` rows of ``x`` with the largest inner product.

    ``order[:, d]`` lists the rows by rising component ``d``. The lists are read in
    step from the end that helps the query, a deeper stretch each round; every row met
    is scored in full. What has not been met scores at most the sum of products at the
    current depth, so the search ends once the kth score is above that bound. An equal
    score could still win by its smaller id, so equality does not end it.
    """
    n = len(x)
    dims = np.flatnonzero(query)
    met = ids == own
    best_ids, best = np.zeros(0, np.int64), np.zeros(0, x.dtype)
    rising = query[dims] < 0
    depth, step = 0, FIRST_DEPTH if len(dims) else n
    while depth < n:
        to = min(n, depth + step)
        if len(dims):
            rows = np.concatenate([order[depth:to][:, dims[rising]].ravel(), order[n - to : n - depth][:, dims[~rising]].ravel()])
            fresh = np.zeros(n, bool)
            fresh[rows] = True
            fresh &= ~met
        else:
            fresh = ~met
        new = np.flatnonzero(fresh)
        met |= fresh
        best_ids, best = np.concatenate([best_ids, ids[new]]), np.concatenate([best, x[new] @ query])
        kept = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[kept], best[kept]
        depth, step = to, step * 2
        if len(dims) and len(best) == k:
            edge = np.where(rising, order[to - 1, dims], order[n - to, dims])
            if best[-1] > (x[edge, dims] * query[dims]).sum():
                break
    return best_ids, best


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, vector in enumerate(vectors):
        out[row, : len(vector)] = vector
    return out


def _cell(k: int):
    """Searches one block of queries in one block of candidates."""

    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(candidates):
            width = max(map(len, [*queries["_v"], *candidates["_v"]]))
            q, x = _matrix(queries["_v"], width), _matrix(candidates["_v"], width)
            # sums below 2^53 are exact as doubles, and much faster
            if width and float(abs(q).max()) * float(abs(x).max()) * width < 2**53:
                q, x = q.astype(np.float64), x.astype(np.float64)
            ids = candidates["_id"].to_numpy()
            order = np.argsort(x, axis=0, kind="stable")
            for own, query in zip(queries["_id"], q):
                found, score = threshold_search(x, ids, order, query, own, k)
                out["query_id"].extend([own] * len(found))
                out["vec_id"].extend(found.tolist())
                out["score"].extend(int(s) for s in score)
        return pd.DataFrame(out, dtype=np.int64)

    return search


def top_k(
    queries: DataFrame, candidates: DataFrame, k: int = 5, id: str = "vec_id", vector: str = "embedding", block: int = BLOCK
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every query's ``k`` best candidates other than itself.

    Vectors are taken as integers (``integer_vector``); score is their inner product,
    ties go to the smaller id. Queries and candidates are cut into blocks of about
    ``block`` rows by hash; each pair of blocks is one group that builds its sorted
    lists and runs the threshold search, and only k rows per query and candidate block
    leave it. A group never holds more than two blocks.

    Rows with a null id, a null vector or a component that is null or not finite take
    no part. A repeated id counts once, with the smallest of its vectors. Shorter
    vectors read as zero in the missing dimensions. Fewer than ``k`` candidates give
    fewer rows; an empty table gives an empty result. Other columns are not read.
    """

    def vectors(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id).cast("bigint").alias("_id"), integer_vector(F.col(vector)).alias("_v"))
        return rows.where(F.col("_id").isNotNull() & F.col("_v").isNotNull()).groupBy("_id").agg(F.min("_v").alias("_v"))

    q, c = vectors(queries), vectors(candidates)
    q_blocks = max(1, -(-q.count() // block))
    c_blocks = max(1, -(-c.count() // block))

    def dealt(df: DataFrame, own: int, others: int, own_name: str, other_name: str) -> DataFrame:
        every_other = F.explode(F.sequence(F.lit(0), F.lit(others - 1)).cast("array<bigint>"))
        return df.withColumns({own_name: F.pmod(F.xxhash64("_id"), F.lit(own)), other_name: every_other})

    left = dealt(q, q_blocks, c_blocks, "_q", "_c").groupBy("_q", "_c")
    right = dealt(c, c_blocks, q_blocks, "_c", "_q").groupBy("_q", "_c")
    found = left.cogroup(right).applyInPandas(_cell(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
