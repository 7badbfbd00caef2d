"""Exact top k by inner product with the no-random-access method, block against block.

Candidates are dealt into blocks by a hash of their id, queries into blocks as well, and each pair of blocks is one group. Inside a group every
dimension is a list sorted by its component. A query reads a list from the end at which its own component makes large
products. What has been read gives each candidate a lower and an upper score; once fewer than ``CONTENDERS`` candidates can still reach the k-th
lower bound, reading stops and their scores are resolved. All queries of a block read the same positions, so one pass serves them together: with a list read
down to a component, what a candidate adds at most is the larger of its own and that component, and the bounds of all pairs are two matrix products.

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do null ids; an id that repeats counts once,
with its smallest vector; only vectors of equal length meet; ties go to the smaller id; fewer candidates than k give all of them; a score beyond
64 bits ranks as it is and is returned as the end of the range.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a candidate block and of a query block: two work matrices of this size are held at a time.
BLOCK_ROWS, QUERY_ROWS = 4096, 1024
#: Reading stops for a query when no more candidates than this can be among its first k.
CONTENDERS = 64
#: Depths of the lists after which bounds are compared, as parts of a block.
DEPTHS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1)


def whole_vectors(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """``id, v`` with floor(scale * x) for each component; one row an id."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = df.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    rows = rows.filter(F.col("id").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
    return rows.select("id", F.transform("x", lambda x: F.floor(x * scale)).alias("v")).groupBy("id").agg(F.min("v").alias("v"))


def _exact(xs: np.ndarray, q: np.ndarray) -> np.ndarray:
    return np.array([sum(int(a) * int(b) for a, b in zip(x, q)) for x in xs], object) if xs.dtype == object else xs @ q


def nearest(ids: np.ndarray, xs: np.ndarray, query_ids: np.ndarray, qs: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """``(query, candidate, score)`` of the k best candidates of each query, by reading sorted lists."""
    n, dims = xs.shape
    most = max(1, int(np.abs(xs).max(initial=0))) * max(1, int(np.abs(qs).max(initial=0))) * max(1, dims)
    if most >= 1 << 52 or not dims:  # beyond exact floats: whole numbers without bounds
        scores = [(q, _exact(xs.astype(object), v)) for q, v in zip(query_ids, qs.astype(object))]
        clip = lambda s: max(-1 << 63, min((1 << 63) - 1, int(s)))
        return [(int(q), int(ids[i]), clip(s[i])) for q, s in scores for i in sorted((i for i in range(n) if ids[i] != q), key=lambda i: (-s[i], ids[i]))[:k]]
    kind = np.float32 if most < 1 << 24 else np.float64
    x, order = xs.astype(kind), np.sort(xs.astype(kind), axis=0)
    both = np.concatenate([np.maximum(qs, 0), np.minimum(qs, 0)], axis=1).astype(kind)  # for lists read from the top, and from the bottom
    high, low = order[-1], order[0]
    by_id = np.argsort(ids)
    at = by_id[np.minimum(np.searchsorted(ids[by_id], query_ids), n - 1)]
    own = np.where(ids[at] == query_ids, at, -1)
    active = np.arange(len(qs))
    out: list[tuple[int, int, int]] = []
    for part in DEPTHS:
        depth = max(1, int(n * part))
        if depth < n:
            top, bottom = order[n - depth], order[depth - 1]
            lower = both[active] @ np.concatenate([np.where(x >= top, x, low), np.where(x <= bottom, x, high)], axis=1).T
            upper = both[active] @ np.concatenate([np.maximum(x, top), np.minimum(x, bottom)], axis=1).T
        else:
            lower = upper = (both[active, :dims] + both[active, dims:]) @ x.T
        here = np.flatnonzero(own[active] >= 0)
        lower[here, own[active[here]]] = upper[here, own[active[here]]] = -np.inf
        bound = np.partition(lower, n - k, axis=1)[:, n - k] if n > k else np.full(len(active), -np.inf, kind)
        can = (upper >= bound[:, None]) & (upper > -np.inf)
        done = (can.sum(axis=1) <= CONTENDERS) | (depth == n)
        for row in np.flatnonzero(done):
            q = active[row]
            rows = np.flatnonzero(can[row])
            scores = xs[rows] @ qs[q]  # whole numbers
            for i in np.lexsort((ids[rows], -scores))[:k]:
                out.append((int(query_ids[q]), int(ids[rows[i]]), int(scores[i])))
        active = active[~done]
        if not len(active):
            break
    return out


def top_k(df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows for each row whose ``id`` satisfies ``is_query``."""
    rows = whole_vectors(df, vec_id, vector, scale)
    sizes = rows.select(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q")).first()
    blocks, groups = -(-sizes.n // BLOCK_ROWS) or 1, -(-sizes.q // QUERY_ROWS) or 1
    deal = lambda many, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(many)).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    dims = F.size("v").alias("dims")
    candidates = rows.select("id", "v", dims, deal(blocks, 1).alias("block"), every(groups).alias("group"))
    queries = rows.filter(is_query).select("id", "v", dims, deal(groups, 2).alias("group"), every(blocks).alias("block"))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list = []
        if len(left) and len(right):
            ids = [t.column("id").to_numpy() for t in (left, right)]
            whole = [t.column("v").combine_chunks().flatten().to_numpy().reshape(len(t), -1) if t.column("dims")[0].as_py() else np.zeros((len(t), 0), np.int64) for t in (left, right)]
            found = nearest(ids[0], whole[0], ids[1], whole[1], k)
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], []))], ["query_id", "vec_id", "score"])

    keys = ["block", "group", "dims"]
    found = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
