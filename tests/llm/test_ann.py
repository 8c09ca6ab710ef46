import math
import random

import numpy as np
from pyspark.sql import functions as F

from cosecha.llm.ann import nearest

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "a", "b") for i, v in rows], SCHEMA)


def test_small_table_is_exact(spark):
    rng = random.Random(1)
    good = [(i, [float(np.float32(rng.gauss(0, 1))) for _ in range(8)]) for i in range(60)]
    good[7] = (7, good[3][1])
    rows = good + [(100, None), (120, [0.0] * 8), (140, [float("nan")] * 8), (160, [float("inf")] * 8),
                   (180, [None] * 8), (None, good[0][1]), (200, [])]
    got = {}
    for r in nearest(frame(spark, rows), F.col("vec_id") % 20 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(got) == [0, 20, 40]
    for q, found in got.items():
        x = dict(good)[q]
        every = sorted((-math.fsum(a * b for a, b in zip(x, v)), i) for i, v in good if i != q)[:5]
        assert [(n, i) for n, i, _ in sorted(found)] == [(k + 1, i) for k, (_, i) in enumerate(every)]
        assert np.allclose([s for *_, s in sorted(found)], [-s for s, _ in every], rtol=0, atol=1e-12)


def test_fewer_candidates_than_k_and_none(spark):
    out = nearest(frame(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5])]), F.col("vec_id") == 0).collect()
    assert sorted((r["rank"], r.vec_id) for r in out) == [(1, 1), (2, 2)]
    assert nearest(frame(spark, []), F.col("vec_id") == 0).count() == 0


def test_recall_of_the_hashed_search(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3000, 32)) * rng.uniform(0.5, 1.5, (3000, 1))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    x = np.array([v for _, v in rows])
    hit = 0
    out = nearest(frame(spark, rows), F.col("vec_id") % 60 == 0, block_rows=1500).collect()
    for q in range(0, 3000, 60):
        s = x @ x[q]
        s[q] = -np.inf
        best = np.sort(s)[-20]
        hit += sum(s[r.vec_id] >= best - 1e-9 for r in out if r.query_id == q)
    assert hit / (20 * 50) >= 0.9
