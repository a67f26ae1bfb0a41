"""Exact top-k inner products by columnar branch-and-bound.

Queries and candidates are cut in blocks, and each pair of blocks is one task-sized group. Inside, candidates lie column
by column; scores are summed dimension block by dimension block, and after each one the candidates whose score cannot
reach the query's k-th best any more are dropped. What the remaining dimensions can add is bounded by the product of the
remaining lengths of query and candidate. Every group returns at most k rows a query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import Scratch

SCALE = 256
TOP = 5
EVERY = 50
CANDIDATE_BLOCK, QUERY_BLOCK = 16_384, 1_024
DIMENSIONS = 8
FIRST_CANDIDATES = 256
_EXACT = 2.0**53
_LONG = (-(1 << 63), (1 << 63) - 1)
_HUGE = 1 << 1000


def scaled(vectors: list[list[float]]) -> np.ndarray:
    """``floor(SCALE * x)`` of each component as whole-number doubles; shorter vectors end in zeros."""
    width = max(map(len, vectors), default=0)
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return np.floor(SCALE * out)


def block_top(queries: np.ndarray, query_ids, candidates: np.ndarray, ids: np.ndarray, k: int):
    """``(query, candidate, score, score as double)`` of the ``k`` best candidates of each query, ties to the smaller id.

    Both sides hold whole numbers as doubles. Sums stay exact while they are below 2^53; larger components are summed as
    Python integers without pruning.
    """
    order = np.argsort(ids, kind="stable")
    ids, candidates = ids[order], candidates[order]
    width = max(queries.shape[1], candidates.shape[1])
    queries, candidates = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (queries, candidates))
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(candidates).max(initial=0)) * max(width, 1)
    if not most < _EXACT:
        yield from _wide_top(queries, query_ids, candidates, ids, k)
        return
    columns = np.ascontiguousarray(candidates.T)
    cuts = list(range(0, width, DIMENSIONS)) + [width]
    # remaining length of each candidate and query after each dimension block
    rest = [np.sqrt((columns[a:] ** 2).sum(axis=0)) for a in cuts[1:]]
    query_rest = np.stack([np.sqrt((queries[:, a:] ** 2).sum(axis=1)) for a in cuts[1:]], axis=1)
    first = columns[:, :FIRST_CANDIDATES]
    for i, (q, query_id) in enumerate(zip(queries, query_ids)):
        known = (q @ first)[ids[: first.shape[1]] != query_id]
        bound = np.partition(known, len(known) - k)[len(known) - k] if len(known) >= k else -np.inf
        alive = np.flatnonzero(ids != query_id)
        score = np.zeros(len(alive))
        for block, (a, b) in enumerate(zip(cuts, cuts[1:])):
            part = columns[a:b] if len(alive) == len(ids) else columns[a:b, alive]
            score += q[a:b] @ part
            reach = score + query_rest[i, block] * rest[block][alive] * (1 + 1e-9)
            keep = reach >= bound
            if not keep.all():
                alive, score = alive[keep], score[keep]
        best = np.lexsort((ids[alive], -score))[:k]
        for j in best:
            yield query_id, ids[alive[j]], int(score[j]), score[j]


def _wide_top(queries, query_ids, candidates, ids, k):
    whole = [[int(x) for x in row] for row in candidates]
    for q, query_id in zip(queries, query_ids):
        q = [int(x) for x in q]
        scores = [(-sum(x * y for x, y in zip(q, c)), i) for c, i in zip(whole, ids) if i != query_id]
        for score, i in sorted(scores)[:k]:
            yield query_id, i, min(max(-score, _LONG[0]), _LONG[1]), float(min(max(-score, -_HUGE), _HUGE))


def _group(k: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["vec_id", "asks", "vector"]).to_pandas()
        asking, offered = rows[rows["asks"]], rows[~rows["asks"]]
        found = block_top(
            scaled(list(asking["vector"])), asking["vec_id"].to_numpy(),
            scaled(list(offered["vector"])), offered["vec_id"].to_numpy(), k,
        ) if len(asking) and len(offered) else ()
        out = pd.DataFrame(found, columns=["query_id", "vec_id", "score", "wide"])
        out = out.astype({"query_id": "int64", "vec_id": "int64", "score": "int64", "wide": "float64"})
        return pa.Table.from_pandas(out, preserve_index=False)

    return run


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, no null and no non-finite component."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def top_products(vectors: DataFrame, k: int = TOP, every: int = EVERY) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for ``vectors(vec_id, embedding, …)``.

    Queries are the rows whose id is divisible by ``every``, candidates all rows of other ids. A score is the inner
    product of ``floor(256 x)`` of the components as doubles; ties go to the smaller id.

    - null vectors, and those with null or non-finite components: no part; empty vectors: all scores 0;
    - vectors of different lengths: the shorter ends in zeros; scores beyond a long: its nearest end,
      in the order of their doubles;
    - null ids: no part; rows that repeat an id: each is a candidate, and the copies of a query answer as one query;
    - fewer than ``k`` candidates: all; no rows: no rows; other columns are ignored.
    """
    with Scratch(vectors.sparkSession, "topk") as scratch:
        rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
        rows = scratch.table(rows.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))), "vectors")
        asks = F.col("vec_id") % every == 0
        n, asking = rows.agg(F.count("*"), F.count(F.when(asks, 1))).first()
        blocks, query_blocks = -(-max(n, 1) // CANDIDATE_BLOCK), -(-max(asking, 1) // QUERY_BLOCK)
        h = F.xxhash64("vec_id", "vector")
        each = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
        offered = rows.select(
            F.pmod(h, F.lit(blocks)).alias("c"), each(query_blocks).alias("q"), F.lit(False).alias("asks"), "vec_id", "vector"
        )
        queries = rows.where(asks).distinct().select(
            each(blocks).alias("c"), F.pmod(h, F.lit(query_blocks)).alias("q"), F.lit(True).alias("asks"), "vec_id", "vector"
        )
        found = offered.unionByName(queries).groupBy("c", "q").applyInArrow(
            _group(k), "query_id long, vec_id long, score long, wide double"
        )
        found = scratch.table(found, "found")
        order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("wide").desc(), "vec_id")
        ranks = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        return scratch.result(ranks.select("query_id", "rank", "vec_id", "score"))
