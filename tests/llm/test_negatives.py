import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cosecha.llm import negatives as N

ROWS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                     T.StructField("label", T.IntegerType()), T.StructField("score", T.StringType()),
                     T.StructField("anchor", T.StringType())])
KEY = lambda r: tuple((x is None, x) for x in r)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], ROWS)


def sql(rows):
    con = duckdb.connect()
    con.register("embeddings", pa.table({"vec_id": pa.array([r[0] for r in rows], pa.int64()),
                                         "embedding": pa.array([r[1] for r in rows], pa.list_(pa.float32())),
                                         "label": pa.array([r[2] for r in rows], pa.int32())}))
    return sorted(con.sql(N.ORACLE).fetchall(), key=KEY)


def vectors(seed, n, dim=24, spread=0.4):
    rnd = np.random.default_rng(seed)
    centre = rnd.standard_normal(dim) * spread
    return [(i, [float(x) for x in (centre + rnd.standard_normal(dim) * 0.3).astype(np.float32)], int(rnd.integers(0, 4)))
            for i in range(n)]


def edges():
    rows = vectors(1, 400)
    same = rows[3][1]
    rows += [(1000 + i, same, i % 3) for i in range(300)]  # a hot vector, ties
    rows += [(0, rows[0][1], 0), (50, rows[50][1], 1), (50, rows[50][1], 1)]  # repeated rows
    rows += [(2000, None, 1), (2050, [1.0, None] * 12, 1), (2100, [math.nan] * 24, 1), (2150, [math.inf] * 24, 1),
             (2200, [0.0] * 24, 1), (2250, same, None), (None, same, 2), (None, [x * 0.7 for x in same], 3),
             (2300, [], 1), (2301, [], 2), (2302, [], 1), (2350, [0.5, 0.25], 1), (2351, [0.5, 0.25], 1),
             (2352, [0.4, 0.2], 2), (-50, [-x for x in same], 1)]
    return rows


@pytest.mark.parametrize("block_rows, anchor_rows", [(32_768, 2_048), (40, 3)])
def test_equal_to_the_sql(spark, block_rows, anchor_rows):
    rows = edges()
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = N.hard_negatives(N.integer_vectors(table(spark, rows), label=label), F.col("vec_id") % 50 == 0,
                           block_rows=block_rows, anchor_rows=anchor_rows)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, out.collect()), key=KEY) == sql(rows)


def test_query_and_empty_table(spark):
    rows = vectors(2, 200)
    assert sorted(map(tuple, N.mine_embeddings(table(spark, rows)).collect()), key=KEY) == sql(rows)
    assert N.mine_embeddings(table(spark, [])).count() == 0
    assert N.mine_embeddings(table(spark, rows[1:50])).count() == 0  # no anchor


def test_bitmap_shrinks_and_nothing_is_lost():
    rnd = np.random.default_rng(5)
    rows = (rnd.standard_normal((3000, 48)) * 60).astype(np.int64)
    block, rank = N.Block(rows), np.arange(3000)
    anchor = (rnd.standard_normal(48) * 60 * np.exp(-np.arange(48) / 6)).astype(np.int64)  # most weight in few dimensions
    read = []
    settle = block.scan

    def counted(a, alive, rule):
        def watch(lower, upper):
            stay = rule(lower, upper)
            read.append(int(stay.sum()))
            return stay
        return settle(a, alive, watch)

    block.scan = counted
    exact = rows @ anchor
    found, score = N.nearest(block, anchor, np.arange(3000), rank, 5)
    assert found.tolist() == np.lexsort((rank, -exact))[:5].tolist() and score.tolist() == exact[found].tolist()
    assert read == sorted(read, reverse=True) and read[-1] < 100
    read.clear()
    top = int(exact.max())
    windows = [(top // 2, top * 95 // 100), (top // 4, top // 3), (10 ** 12, 10 ** 13)]
    for (lo, hi), (got, s) in zip(windows, N.in_windows(block, anchor, np.arange(3000), rank, windows, 3)):
        at = np.flatnonzero((exact >= lo) & (exact <= hi))
        assert got.tolist() == at[np.lexsort((at, -exact[at]))][:3].tolist() and s.tolist() == exact[got].tolist()
    assert read[-1] < 3000


def test_huge_components_are_exact():
    rnd = random.Random(1)
    rows = np.array([[rnd.randrange(-10 ** 12, 10 ** 12) for _ in range(10)] for _ in range(200)], np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(r, rows[0])) for r in rows]
    found, score = N.nearest(N.Block(rows), rows[0], np.arange(200), np.arange(200), 4)
    best = sorted(range(200), key=lambda i: (-exact[i], i))[:4]
    assert found.tolist() == best and [int(x) for x in score] == [exact[i] for i in best]
    assert N._long(10 ** 30) == 2 ** 63 - 1 and N._long(-10 ** 30) == -2 ** 63
