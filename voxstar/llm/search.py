"""Exact top-k search by inner product: the threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from voxstar.llm.staging import checkpointed
from voxstar.shipping import ship

#: Candidates and queries that meet in one task.
BLOCK = 4096
QUERIES = 1024
#: Depth of the first round; each round doubles it.
DEPTH = 8


def threshold_search(vectors: np.ndarray, ids: np.ndarray, lists: np.ndarray, query: np.ndarray, out: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(row, score) of the k best vectors by integer inner product, ties to the smaller id; rows marked in ``out`` take no part.

    ``lists[d]`` holds the rows by falling value in dimension d; a negative weight reads it from the other end. Rows seen in any list get their
    whole score. An unseen row scores at most the sum of weights times the values at the lists' current depth, so the search
    stops when the kth score is above that bound; an equal bound could hide a tie with a smaller id.
    """
    n = len(vectors)
    dims = np.flatnonzero(query)
    falling = query[dims] > 0
    done = out.copy()
    best_rows, best = np.empty(0, np.int64), np.empty(0, query.dtype)
    depth, reached = DEPTH, 0
    while reached < n:
        to = min(depth, n)
        fresh = np.zeros(n, np.bool_)
        if len(dims):
            fresh[lists[dims[falling], reached:to]] = True
            fresh[lists[dims[~falling], n - to:n - reached]] = True
        else:
            to, fresh[:] = n, True
        rows = np.flatnonzero(fresh & ~done)
        done[rows] = True
        best_rows = np.concatenate((best_rows, rows))
        best = np.concatenate((best, vectors[rows] @ query))
        order = np.lexsort((ids[best_rows], -best))[:k]
        best_rows, best = best_rows[order], best[order]
        at = np.where(falling, lists[dims, to - 1], lists[dims, n - to])
        bound = (vectors[at, dims] * query[dims]).sum()
        if len(best) == k and best[-1] > bound:
            break
        reached, depth = to, depth * 2
    return list(zip(best_rows.tolist(), (int(x) for x in best), strict=True))


def _exact(a: np.ndarray) -> np.ndarray:
    """Integers as float64 where all inner products stay exact there, as Python's integers otherwise."""
    bound = float(np.abs(a).max(initial=0.0))
    return a if bound * bound * a.shape[1] < 2 ** 53 else np.array([[int(x) for x in row] for row in a], object)


def usable(vector: str) -> Column:
    """Whether a vector has components, none of them null or non-finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


def top_k(table: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: each query's k best rows by the inner product of floor(scale * x).

    Every usable row but the query's own is a candidate of every query with as many components. Rows without vec_id or with a null
    or non-finite component take no part. Every query row asks, also when its vec_id repeats: each gives k rows of its own, and the other
    rows of its vec_id are candidates. Ties go to the smaller vec_id. An empty table gives no rows; other columns are not read.

    Equal rows (vec_id and vector) collapse into one with their number, combined before the shuffle, so that a row that a third of the table
    repeats is searched once. Rows are dealt by the hash of both into blocks of about 4,096 candidates and 1,024 queries; a task searches one
    pair of blocks by the threshold algorithm and returns k rows per query, and the best k of those are kept by a group limit before and after
    their shuffle.
    """
    ship(table.sparkSession)
    rows = table.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")) \
        .where(F.col("vec_id").isNotNull() & usable("vector"))
    rows = checkpointed(rows.groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("same")).withColumn("row", F.xxhash64("vec_id", "vector")))
    asked = rows.where(is_query)
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(is_query.cast("long")).alias("q")).first()
    blocks, parts = max(1, math.ceil(size["n"] / BLOCK)), max(1, math.ceil((size["q"] or 0) / QUERIES))
    slot = lambda n: F.pmod("row", F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ("block", "part", F.size("vector").alias("dims"), "asks", "row", "vec_id", "same", "vector")
    cells = (rows.withColumn("block", slot(blocks)).withColumn("part", every(parts)).withColumn("asks", F.lit(False)).select(*columns)
             .unionByName(asked.withColumn("part", slot(parts)).withColumn("block", every(blocks)).withColumn("asks", F.lit(True))
                          .select(*columns)))

    def run(cell: pd.DataFrame) -> pd.DataFrame:
        found = []
        asks = cell["asks"].to_numpy()
        if asks.any() and not asks.all():
            whole = _exact(np.floor(scale * np.stack(cell["vector"].to_numpy())))
            names, keys, same = (cell[c].to_numpy() for c in ("vec_id", "row", "same"))
            vectors, ids, rest = whole[~asks], names[~asks], same[~asks]
            lists = np.argsort(-vectors, axis=0, kind="stable").T
            for key, own, times, query in zip(keys[asks], names[asks], same[asks], whole[asks], strict=True):
                self_ = keys[~asks] == key
                left = rest - self_  # its equals remain candidates
                found += [(key, own, times, ids[at], left[at], score)
                          for at, score in threshold_search(vectors, ids, lists, query, self_ & (left == 0), k)]
        return pd.DataFrame(found, columns=["row", "query_id", "times", "vec_id", "n", "score"]).astype("int64")

    found = cells.groupBy("block", "part", "dims").applyInPandas(
        run, "row long, query_id long, times long, vec_id long, n long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # k different rows are enough to give k rows; those that stand for several are written out, then the queries that do
    each = best.withColumn("_", F.explode(F.sequence(F.lit(1), F.least("n", F.lit(k)).cast("int"))))
    ranked = each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).select("query_id", "rank", "vec_id", "score")
