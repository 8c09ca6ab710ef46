"""Hard-negative mining (operator 13): BOND, a vertical scan.

Rows lie in blocks, dimension by dimension. An anchor reads the dimensions in the
descending magnitude of its own components, a few at a time, and adds them up for
all rows of the block that can still matter. What the unread dimensions can add lies
between the sums of their least and greatest products with the anchor, as the
block's minimum and maximum of each dimension say; a row leaves the candidate
bitmap when, even so,

* (positives) ``positives`` other rows of the block are certainly nearer;
* (negatives) it can reach no positive's window of scores, or, for each window
  that it can reach, ``negatives`` rows certainly in the window are nearer.

So nothing is approximate. Positives are looked for among the blocks of an
anchor's label, negatives among all blocks; every pair of a block of rows and a block
of anchors is one bounded task, and the best of the blocks are merged by a ranked
window that keeps the best inside each task first. Blocks are dealt by a hash of
the row, not of a key, so a hot label or vector spreads evenly.

Components are scaled to integers; scores are exact (in doubles while a sum of
products stays below 2^53, in Python's integers beyond, held at the ends of a long).

Defined cases: rows with a null label, a null vector or a null or non-finite
component take no part; a zero vector does; vectors of different length never
meet; a null ``vec_id`` is a candidate, but never an anchor, and comes last in ties;
ties go to the smaller ``vec_id``; repeated rows are rows of their own (a copy of the
anchor is another row of its label); anchors without positives or negatives give
no row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cosecha.llm.common import prepare, store

POSITIVES, NEGATIVES = 5, 3
#: a negative's score is between these hundredths of the positive's
LOW, HIGH = 50, 95
SCALE = 256
BLOCK_ROWS, ANCHOR_ROWS = 32_768, 2_048
#: dimensions read between two looks at the bitmap
STEP = 8
_LONG = (1 << 63) - 1


class Block:
    """Rows of one length, by dimension."""

    def __init__(self, rows: np.ndarray):
        self.n, self.dim = rows.shape
        self.columns = np.ascontiguousarray(rows.T)
        self.least = self.columns.min(1) if self.n else np.zeros(self.dim, np.int64)
        self.most = self.columns.max(1) if self.n else np.zeros(self.dim, np.int64)
        self.top = float(max(-int(self.least.min(initial=0)), int(self.most.max(initial=0))))
        self.exact: np.ndarray | None = None

    def as_type(self, anchor: np.ndarray) -> tuple[np.ndarray, type]:
        """The columns in a type in which sums of products with ``anchor`` are exact."""
        if self.dim * self.top * float(np.abs(anchor.astype(np.float64)).max(initial=0)) < 2 ** 53:
            if self.exact is None:
                self.exact = self.columns.astype(np.float64)
            return self.exact, np.float64
        return self.columns.astype(object), object

    def scan(self, anchor: np.ndarray, alive: np.ndarray, settle) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) that are left of ``alive`` (row numbers) once all
        dimensions are read. ``settle(lower, upper)`` says which rows stay."""
        columns, kind = self.as_type(anchor)
        order = np.argsort(-np.abs(anchor.astype(np.float64)), kind="stable")
        a = anchor.astype(kind)
        ends = np.stack([a * self.least.astype(kind), a * self.most.astype(kind)])[:, order]
        # what the dimensions from the i-th on can add
        beyond = lambda x: np.concatenate([np.cumsum(x[::-1])[::-1], np.zeros(1, kind)])
        rest_low, rest_high = beyond(ends.min(0)), beyond(ends.max(0))
        score = np.zeros(len(alive), kind)
        whole = len(alive) == self.n
        for i in range(0, self.dim, STEP):
            d = order[i:i + STEP]
            score += a[d] @ (columns[d] if whole else columns[np.ix_(d, alive)])
            j = min(i + STEP, self.dim)
            if j < self.dim:
                stay = settle(score + rest_low[j], score + rest_high[j])
                left = int(np.count_nonzero(stay))
                if left < len(alive):
                    alive, score, whole = alive[stay], score[stay], False
                if not left:
                    break
        return alive, score


def _kth(values: np.ndarray, k: int):
    """The k-th largest, None if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _best(score: np.ndarray, rank: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, ties by ``rank``."""
    edge = _kth(score, k)
    at = np.arange(len(score)) if edge is None else np.flatnonzero(score >= edge)
    return at[np.lexsort((rank[at], -score[at]))][:k]


def nearest(block: Block, anchor: np.ndarray, candidates: np.ndarray, rank: np.ndarray, k: int):
    """(rows, scores) of the k rows among ``candidates`` nearest to ``anchor``."""
    def settle(lower, upper):
        edge = _kth(lower, k)
        return np.ones(len(upper), bool) if edge is None else upper >= edge

    rows, score = block.scan(anchor, candidates, settle)
    at = _best(score, rank[rows], k)
    return rows[at], score[at]


def in_windows(block: Block, anchor: np.ndarray, candidates: np.ndarray, rank: np.ndarray, windows: np.ndarray, k: int):
    """For each (low, high) of ``windows`` the (rows, scores) of the k best among
    ``candidates`` with a score from low to high."""
    def settle(lower, upper):
        stay = np.zeros(len(lower), bool)
        for low, high in windows:
            reach = (upper >= low) & (lower <= high)
            edge = _kth(lower[(lower >= low) & (upper <= high)], k)
            stay |= reach if edge is None else reach & (upper >= edge)
        return stay

    rows, score = block.scan(anchor, candidates, settle)
    for low, high in windows:
        at = np.flatnonzero((score >= low) & (score <= high))
        best = at[_best(score[at], rank[rows[at]], k)]
        yield rows[best], score[best]


# ------------------------------------------------------------------- Spark

def _matrix(t: pa.Table) -> np.ndarray:
    v = t.column("v").combine_chunks()
    flat = v.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(v), -1) if len(v) else np.zeros((0, 0), np.int64)


def _ranks(t: pa.Table) -> np.ndarray:
    """Place of every row in the order of vec_id, nulls last."""
    ids = t.column("vec_id")
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    v = ids.fill_null(0).to_numpy()
    rank = np.empty(len(v), np.int64)
    # equal ids have equal places
    order = np.lexsort((v, ~known))
    new = np.ones(len(v), bool)
    new[1:] = (v[order][1:] != v[order][:-1]) | (known[order][1:] != known[order][:-1])
    rank[order] = np.cumsum(new)
    return rank


def _long(x) -> int:
    return max(-_LONG - 1, min(_LONG, int(x)))


def _find_positives(rows: pa.Table, anchors: pa.Table, k: int):
    block, rank = Block(_matrix(rows)), _ranks(rows)
    uid, ids = rows.column("uid").to_numpy(), rows.column("vec_id").to_pylist()
    every = np.arange(block.n)
    for name, anchor in zip(anchors.column("uid").to_pylist(), _matrix(anchors)):
        mine = every if not (uid == name).any() else every[uid != name]
        for r, s in zip(*nearest(block, anchor, mine, rank, k)):
            yield {"anchor": name, "vec_id": ids[r], "score": _long(s)}


def _find_negatives(rows: pa.Table, anchors: pa.Table, k: int, low: int, high: int):
    block, rank = Block(_matrix(rows)), _ranks(rows)
    label, ids = rows.column("label").to_numpy(), rows.column("vec_id").to_pylist()
    others = {}
    found = anchors.column("positives").to_pylist()
    for name, own, scores, anchor in zip(anchors.column("uid").to_pylist(), anchors.column("label").to_pylist(), found,
                                         _matrix(anchors)):
        if own not in others:
            others[own] = np.flatnonzero(label != own)
        # whole numbers n with low * p <= 100 n <= high * p
        windows = [(-(-low * p // 100), high * p // 100) for p in scores]
        for p, best in enumerate(in_windows(block, anchor, others[own], rank, windows, k)):
            for r, s in zip(*best):
                yield {"anchor": name, "positive": p, "vec_id": ids[r], "score": _long(s)}


def _rows_of(found, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(list(found), schema=schema)


def integer_vectors(vectors: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id",
                    label: Column | None = None, scale: int = SCALE) -> DataFrame:
    """uid, vec_id, label, dim, v: the rows that take part, components scaled to
    integers."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    d = vectors.select(F.col(id_col).cast("long").alias("vec_id"), (F.col("label") if label is None else label)
                       .cast("long").alias("label"), v.alias("x"), fine.alias("fine"))
    return d.where(F.col("fine") & F.col("label").isNotNull()).select(
        F.monotonically_increasing_id().alias("uid"), "vec_id", "label", F.size("x").alias("dim"),
        F.transform("x", lambda x: F.floor(x * float(scale))).alias("v"))


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
                   low: int = LOW, high: int = HIGH, block_rows: int = BLOCK_ROWS,
                   anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score:
    for each row that the condition ``anchor`` (on vec_id) picks, its ``positives``
    nearest other rows of its label, and for each of them the ``negatives`` best rows
    of other labels with a score from ``low`` to ``high`` hundredths of the positive's.
    ``vectors``: what ``integer_vectors`` gives."""
    prepare(vectors.sparkSession)
    base = store(vectors, "vectors")
    n = base.agg(F.count("*"), F.count(F.when(anchor, 1))).first()
    blocks, anchor_blocks = max(1, math.ceil(n[0] / block_rows)), max(1, math.ceil(n[1] / anchor_rows))
    dealt = lambda m, salt: F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    # the same columns by other names inside Spark: both sides of a cogroup read this table
    asked = base.where(anchor).select(*[F.col(c).alias(c) for c in base.columns])

    # positives: the rows of one label, in blocks of their own number
    labels = store(base.groupBy("dim", "label").agg(
        F.count("*").alias("n"), F.count(F.when(anchor, 1)).alias("asked")).where(F.col("asked") > 0).select(
        "dim", "label", F.ceil(F.col("n") / block_rows).cast("int").alias("bs"),
        F.ceil(F.col("asked") / anchor_rows).cast("int").alias("qs")), "labels")
    to = lambda m: F.explode(F.sequence(F.lit(0), F.col(m) - 1))
    at = lambda m, salt: F.pmod(F.xxhash64("uid", F.lit(salt)), F.col(m)).cast("int")
    key = ["dim", "label", "b", "q"]
    mine = base.join(labels, ["dim", "label"]).withColumn("b", at("bs", 1)).withColumn("q", to("qs"))
    ask = asked.join(labels, ["dim", "label"]).withColumn("q", at("qs", 2)).withColumn("b", to("bs"))
    s1 = pa.schema([("anchor", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    found = mine.select(*key, "uid", "vec_id", "v").groupBy(*key).cogroup(ask.select(*key, "uid", "v").groupBy(*key)) \
        .applyInArrow(lambda r, a: _rows_of(_find_positives(r, a, positives) if len(r) and len(a) else [], s1),
                      "anchor long, vec_id long, score long")
    best = Window.partitionBy("anchor").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    top = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= positives)
    top = top.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("top"))
    known = store(asked.join(top, asked["uid"] == top["anchor"]).select("uid", "vec_id", "label", "dim", "v", "top"), "anchors")

    key = ["dim", "b", "q"]
    rows = base.select(*[F.col(c).alias(c) for c in base.columns]).withColumn("b", dealt(blocks, 3)).withColumn("q", every(anchor_blocks))
    ask = known.withColumn("q", dealt(anchor_blocks, 4)).withColumn("b", every(blocks))
    s2 = pa.schema([("anchor", pa.int64()), ("positive", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])
    found = rows.select(*key, "vec_id", "label", "v").groupBy(*key).cogroup(
        ask.select(*key, "uid", "label", "v", F.col("top.score").alias("positives")).groupBy(*key)).applyInArrow(
        lambda r, a: _rows_of(_find_negatives(r, a, negatives, low, high) if len(r) and len(a) else [], s2),
        "anchor long, positive int, vec_id long, score long")
    best = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    last = found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= negatives)
    of = known.select("uid", F.col("vec_id").alias("anchor_id"), F.posexplode("top").alias("positive_no", "p"))
    return last.join(of, (last["anchor"] == of["uid"]) & (last["positive"] == of["positive_no"])).select(
        "anchor_id", F.col("p.vec_id").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score"))


def mine_embeddings(embeddings: DataFrame) -> DataFrame:
    """The registered query: labels of every seventh row are moved on, every
    fiftieth row is an anchor."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(integer_vectors(embeddings, label=label), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH e AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND
    len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.uid AS anchor, a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.uid <> b.uid AND len(a.v) = len(b.v) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor, anchor_id, vec_id AS positive_id, score AS positive_score,
    row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) AS nth FROM s WHERE same
  QUALIFY nth <= 5),
n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor, nth ORDER BY s.score DESC, s.vec_id NULLS LAST) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND
    50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
  QUALIFY rank <= 3)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n
"""
