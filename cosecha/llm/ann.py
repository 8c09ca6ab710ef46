"""Approximate nearest neighbours (operator 4): collision-counting hashing.

Every row is hashed by ``projections`` single random projections, kept as
sorted arrays. A query opens a window around its own projection in each array
and widens all windows step by step (virtual rehashing); a vector that lies in
the windows of at least ``collision_share`` of the arrays is a candidate. The
windows stop widening when ``verify_share`` of the vectors (and ``VERIFY_LEAST`` times
k) are candidates; all candidates are verified by their exact inner product.

Largest inner product is nearest neighbour after one more component makes all
rows equally long, so rows need not be unit vectors.

Rows are dealt into blocks of about ``block_rows``, queries into blocks of
about ``query_rows``; each pair of blocks is one bounded task, and the best
``k`` of every pair are merged. No block depends on a key, so equal vectors
spread evenly.

Measured recall: see README. Defined cases: vectors that are null, empty, zero
or hold a null or non-finite component take no part, neither do rows with a
null ``vec_id``; vectors of different length are never compared; equal vectors
are neighbours of each other; equal scores go to the smaller ``vec_id``;
repeated rows are queries and candidates of their own; fewer than ``k``
candidates: all of them (a block of at most ``verify_all`` rows is verified
whole); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cosecha.llm.common import prepare, store

K = 20
PROJECTIONS = 96
COLLISION_SHARE = 0.85
VERIFY_SHARE = 0.15
#: and at least so many times k
VERIFY_LEAST = 50
#: first half-width of a window in standard deviations, and its growth
FIRST, GROWTH = 1.6, 1.04
BLOCK_ROWS, QUERY_ROWS = 8192, 1024
VERIFY_ALL = 256


class SortedProjections:
    """The sorted arrays over one block of rows."""

    def __init__(self, rows: np.ndarray, projections: int = PROJECTIONS, seed: int = 11):
        self.rows = rows
        norms = np.sqrt((rows ** 2).sum(1))
        self.longest = float(norms.max(initial=0.0))
        pad = np.sqrt(np.maximum(self.longest ** 2 - norms ** 2, 0.0))
        self.axes = np.random.default_rng(seed).standard_normal((rows.shape[1] + 1, projections))
        hashed = rows @ self.axes[:-1] + pad[:, None] * self.axes[-1]
        self.order = np.ascontiguousarray(np.argsort(hashed, axis=0, kind="stable").T)
        self.values = np.ascontiguousarray(np.take_along_axis(hashed, self.order.T, axis=0).T)

    def candidates(self, queries: np.ndarray, least: int, share: float = COLLISION_SHARE, first: float = FIRST,
                   growth: float = GROWTH):
        """For each query the rows that collide in enough arrays, once at least
        ``least`` of them do."""
        n, m = len(self.rows), len(self.order)
        need = math.ceil(share * m)
        unit = queries * (self.longest / np.sqrt((queries ** 2).sum(1)))[:, None]
        centre = unit @ self.axes[:-1]
        spread = float(self.values.std()) or 1.0
        bounds = []  # of every step, shared by the queries: (lo, hi) by array and query

        def step(t: int):
            while len(bounds) <= t:
                w = spread * first * growth ** len(bounds)
                bounds.append((np.array([v.searchsorted(c - w, "left") for v, c in zip(self.values, centre.T)]),
                               np.array([v.searchsorted(c + w, "right") for v, c in zip(self.values, centre.T)])))
            return bounds[t]

        room = np.empty(2 * m * n, np.intp)

        def count(slices):
            """How often each row is in the slices; ``room`` is used again and again."""
            size = sum(map(len, slices))
            return np.bincount(np.concatenate(slices, out=room[:size]), minlength=n)

        for q in range(len(queries)):
            # a window holds most of an array, so what lies outside is counted
            lo, hi = (x[:, q].tolist() for x in step(0))
            misses = count([o[:a] for o, a in zip(self.order, lo)] + [o[b:] for o, b in zip(self.order, hi)])
            t = 0
            while int(np.count_nonzero(misses <= m - need)) < least:
                t += 1
                lo2, hi2 = (x[:, q].tolist() for x in step(t))
                misses -= count([o[a:b] for o, a, b in zip(self.order, lo2, lo)] +
                                [o[a:b] for o, a, b in zip(self.order, hi, hi2)])
                lo, hi = lo2, hi2
            yield np.flatnonzero(misses <= m - need)


def _best(rows: pd.DataFrame, queries: pd.DataFrame, k: int, projections: int, collision_share: float,
          verify_share: float) -> pd.DataFrame:
    x = np.array(rows["v"].tolist(), np.float64)
    q = np.array(queries["v"].tolist(), np.float64)
    ids, uids = rows["vec_id"].to_numpy(), rows["uid"].to_numpy()
    n = len(x)
    if n <= max(VERIFY_ALL, k + 1):
        found = (np.arange(n) for _ in range(len(q)))
    else:
        found = SortedProjections(x, projections).candidates(q, min(n, max(VERIFY_LEAST * k, k + 1 + math.ceil(verify_share * n))),
                                                             collision_share)
    out = []
    for i, cand in enumerate(found):
        cand = cand[uids[cand] != queries["uid"].iloc[i]]
        # exact scores: a product first, then sums without rounding for what may be among the best
        score = x[cand] @ q[i]
        if len(cand) > 4 * k:
            keep = np.flatnonzero(score >= np.partition(score, len(score) - 2 * k)[len(score) - 2 * k])
            cand, score = cand[keep], score[keep]
        score = np.array([math.fsum((x[c] * q[i]).tolist()) for c in cand])
        top = np.lexsort((ids[cand], -score))[:k]
        out.append(pd.DataFrame({"uid": queries["uid"].iloc[i], "query_id": queries["vec_id"].iloc[i],
                                 "vec_id": ids[cand][top], "score": score[top]}))
    return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("uid", "query_id", "vec_id", "score")})


def nearest(vectors: DataFrame, query: F.Column, k: int = K, projections: int = PROJECTIONS,
            collision_share: float = COLLISION_SHARE, verify_share: float = VERIFY_SHARE,
            block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of every row that
    the condition ``query`` (on vec_id) picks, among all other rows."""
    prepare(vectors.sparkSession)
    v = F.col("embedding").cast("array<double>")
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(v, lambda x: x != 0), F.lit(False))
    base = store(vectors.where(fine & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), F.size("embedding").alias("dim"),
        F.monotonically_increasing_id().alias("uid")), "vectors")
    n = base.agg(F.count("*"), F.count(F.when(query, 1))).first()
    blocks, query_blocks = max(1, math.ceil(n[0] / block_rows)), max(1, math.ceil(n[1] / query_rows))
    each = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    dealt = lambda m, salt: F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(m)).cast("int")
    rows = base.withColumn("b", dealt(blocks, 1)).withColumn("qb", each(query_blocks))
    asked = base.where(query).withColumn("qb", dealt(query_blocks, 2)).withColumn("b", each(blocks))

    def best(r: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(r) or not len(q):
            return _best(r.iloc[:0], q.iloc[:0], k, projections, collision_share, verify_share)
        return _best(r, q, k, projections, collision_share, verify_share)

    found = rows.groupBy("dim", "b", "qb").cogroup(asked.groupBy("dim", "b", "qb")).applyInPandas(
        best, "uid long, query_id long, vec_id long, score double")
    order = Window.partitionBy("uid").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
