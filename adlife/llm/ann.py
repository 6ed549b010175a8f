"""Approximate nearest neighbours by few stable projections and a kd-tree.

Largest inner product becomes smallest distance by one more coordinate:
x -> (x, sqrt(M^2 - |x|^2)) and q -> (q, 0), with M the largest norm. Vectors
are projected onto ``PROJECTED`` Gaussian directions; by stability the squared
projected distance is the squared distance times a chi-square variable. The
candidates are dealt into blocks of about ``BLOCK_ROWS``; each block is indexed
by a kd-tree over the projections. For a query the tree's leaves are visited in
the order of their projected distance r and their vectors verified with the
whole original vectors; the search of a block stops when
``chi2(r^2 / d^2) >= CONFIDENCE``, with d the distance of the k-th best so far: a
nearer vector that is still unseen would have such a far projection with
probability ``1 - CONFIDENCE`` at most. Every row is indexed; nothing is capped.

Of equal vectors only the k + 1 smallest ids can ever be returned, so the others
are left out before the search (ranked per task first, then over all).

Defined cases: vectors that are null, zero, of another length than most, or hold
null or non-finite components take no part, nor do rows without an id; a query
is never its own neighbour; fewer candidates than k give all of them; equal
scores go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from adlife.llm.common import materialized, ship_package

PROJECTED = 8
CONFIDENCE = 0.995
BLOCK_ROWS = 20_000
LEAF_ROWS = 128
QUERY_ROWS = 128
SEED = 7


def chi_square(x: np.ndarray, degrees: int = PROJECTED) -> np.ndarray:
    """Distribution function for an even number of degrees."""
    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, degrees // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def kd_leaves(points: np.ndarray, leaf_rows: int = LEAF_ROWS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row order, leaf starts, lower corners, upper corners) of a median-split kd-tree."""
    order, starts, low, high = [], [], [], []
    todo = [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        p = points[rows]
        lo, hi = p.min(axis=0), p.max(axis=0)
        axis = int(np.argmax(hi - lo))
        if len(rows) <= leaf_rows:
            starts.append(sum(map(len, order)) if not starts else starts[-1] + len(order[-1]))
            order.append(rows)
            low.append(lo)
            high.append(hi)
            continue
        by = rows[np.argsort(p[:, axis], kind="stable")]
        todo += [by[len(by) // 2:], by[:len(by) // 2]]
    return np.concatenate(order), np.array([*starts, len(points)]), np.stack(low), np.stack(high)


def search_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, longest: float,
                 confidence: float = CONFIDENCE) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query id, id, score, rows verified): up to ``k`` best of the block for each query."""
    rng = np.random.default_rng(SEED)
    directions = rng.standard_normal((x.shape[1] + 1, PROJECTED))
    rest = np.sqrt(np.maximum(longest ** 2 - (x * x).sum(axis=1), 0.0))
    points = x @ directions[:-1] + rest[:, None] * directions[-1]
    order, starts, low, high = kd_leaves(points)
    ids, x = ids[order], x[order]
    places: dict[int, list[int]] = {}
    for row, own in enumerate(ids.tolist()):
        places.setdefault(own, []).append(row)
    out_q, out_id, out_score, verified = [], [], [], 0
    for at in range(0, len(query_ids), QUERY_ROWS):
        names, v = query_ids[at:at + QUERY_ROWS], q[at:at + QUERY_ROWS]
        scores, seen = _incremental(x, starts, low, high, v, v @ directions[:-1], k, longest, confidence,
                                    [places.get(n, []) for n in names.tolist()])
        verified += seen
        for name, vector, row in zip(names, v, scores):
            least = -np.inf if (row > -np.inf).sum() <= k else np.partition(row, len(row) - k)[len(row) - k]
            some = np.flatnonzero((row > -np.inf) & (row >= least - 1e-9 * max(1.0, abs(least))))
            exact = (x[some] * vector).sum(axis=1)          # same order of additions for equal vectors
            best = np.lexsort((ids[some], -exact))[:k]
            out_q.append(np.full(len(best), name))
            out_id.append(ids[some][best])
            out_score.append(exact[best])
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_score), verified


def _incremental(x, starts, low, high, v, projected, k, longest, confidence, own) -> tuple[np.ndarray, int]:
    """Scores of the rows verified for each query (-inf: not verified, or the query itself), and their number.

    In each round every query that goes on takes its next nearest leaves; queries that take the
    same leaf are verified together.
    """
    gap = np.maximum(np.maximum(low[None] - projected[:, None], projected[:, None] - high[None]), 0.0)
    far = (gap * gap).sum(axis=2)                           # squared projected distance (queries, leaves)
    order = np.argsort(far, axis=1, kind="stable")
    turn = np.argsort(order, axis=1, kind="stable")         # when a query takes a leaf
    far = np.take_along_axis(far, order, axis=1)
    square = longest ** 2 + (v * v).sum(axis=1)
    scores = np.full((len(v), len(x)), -np.inf)
    going, done, step, verified = np.arange(len(v)), 0, 4, 0
    while len(going) and done < far.shape[1]:
        due = (turn[going] >= done) & (turn[going] < done + step)
        for leaf in np.flatnonzero(due.any(axis=0)):
            rows, takers = slice(starts[leaf], starts[leaf + 1]), going[due[:, leaf]]
            scores[takers, rows] = v[takers] @ x[rows].T
            verified += len(takers) * (rows.stop - rows.start)
        for i in going:
            scores[i, own[i]] = -np.inf
        done, step = done + step, step * 2
        if done < far.shape[1] and scores.shape[1] > k:
            least = np.partition(scores[going], scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            d2 = np.where(least > -np.inf, np.maximum(square[going] - 2 * least, 1e-300), np.inf)
            going = going[chi_square(far[going, done] / d2) < confidence]
    return scores, verified


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, k: int, key: str = "vec_id", vector_col: str = "embedding",
            confidence: float = CONFIDENCE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, ``key``, score): up to ``k`` rows of the largest inner product for each query row."""
    spark = vectors.sparkSession
    ship_package(spark)
    ok = vectors.where(F.col(key).isNotNull() & usable(F.col(vector_col))).select(
        F.col(key).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"))
    # one row per id, whatever its rows hold: else a repeated row would take several places of a result
    rows = materialized(ok.groupBy("id").agg(F.min("v").alias("v"), F.max("asks").alias("asks")), "vectors")
    schema = "query_id long, rank int, " + key + " long, score double"
    length = rows.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m"),
        F.sum(F.col("asks").cast("long")).alias("q")).orderBy(F.desc("n"), "d").first()
    if length is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("v") == length["d"])
    longest = float(np.sqrt(length["m"]))
    blocks, chunks = -(-length["n"] // block_rows), max(1, -(-length["q"] // block_rows))
    of_equal = Window.partitionBy("v").orderBy("id")
    data = (rows.select("id", "v", F.row_number().over(of_equal).alias("nth")).where(F.col("nth") <= k + 1)
            .select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"),
                    F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")))
    asks = rows.where("asks").select(
        "id", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(chunks)).cast("int").alias("chunk"))
    out = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])

    def matrix(table: pa.Table) -> np.ndarray:
        v = table.column("v").combine_chunks()
        return v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return out.empty_table()
        found = search_block(left.column("id").to_numpy(), matrix(left), right.column("id").to_numpy(),
                             matrix(right), k, longest, confidence)
        return pa.table([pa.array(c) for c in found[:3]], schema=out)

    found = data.groupBy("block", "chunk").cogroup(asks.groupBy("block", "chunk")).applyInArrow(
        run, from_arrow_schema(out))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score"))


def ann_query(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, F.col("vec_id") % 20 == 0, 20)
