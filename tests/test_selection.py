"""Quantiles by histograms and densities by box moments."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cosecha.operators import quantile as q
from cosecha.operators.stats import density_by_group


def test_cells_follow_the_order_of_all_doubles(spark):
    rng = np.random.default_rng(1)
    bits = rng.integers(0, 2 ** 63, 4000, dtype=np.uint64)
    v = np.concatenate([bits.view(np.float64), -bits.view(np.float64), rng.normal(0, 1, 2000), [0.0, -0.0, 5e-324, -5e-324],
                        [math.inf, -math.inf], 2.0 ** np.arange(-1074, 1024), np.nextafter(2.0 ** np.arange(-1022, 1024), 0),
                        [np.finfo(float).max, -np.finfo(float).max]])
    v = np.sort(v[~np.isnan(v)])
    df = spark.createDataFrame(pd.DataFrame({"i": np.arange(len(v)), "v": v}))
    for parts in (1, 3, 1024):
        cells = [r.k for r in df.select("i", q._first_cell(F.col("v"), parts).alias("k")).orderBy("i").collect()]
        assert all(a <= b for a, b in zip(cells, cells[1:]))


@pytest.mark.parametrize("buckets", [2, 50, q.DEFAULT_BUCKETS])
def test_quantiles_bit_equal_to_numpy(spark, buckets):
    rng = np.random.default_rng(2)
    groups = {"close": 1e9 + rng.integers(0, 40, 300) * 2.0 ** -20, "signs": rng.normal(0, 1e-3, 301),
              "wide": np.concatenate([rng.lognormal(0, 40, 200), -rng.lognormal(0, 40, 100), [0.0] * 50]),
              "one": np.array([7.5]), "same": np.full(400, -3.25), "two": np.array([1.0, np.nextafter(1.0, 2)])}
    pdf = pd.concat([pd.DataFrame({"g": g, "v": v}) for g, v in groups.items()])
    df = spark.createDataFrame(pd.concat([pdf, pd.DataFrame({"g": ["same", None], "v": [None, 1.0]})]))
    fr = [0.0, 0.1, 1 / 3, 0.5, 0.9, 1.0]
    got = {r.g: (r.n, list(r["quantiles"])) for r in q.exact_quantiles(df, "v", fr, by=["g"], buckets=buckets).collect()}
    assert got == {g: (len(v), list(np.quantile(v, fr))) for g, v in groups.items()}


def test_quantiles_without_groups_and_without_values(spark):
    v = np.random.default_rng(3).normal(0, 1, 999)
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    assert list(q.exact_quantiles(df, "v", [0.25, 0.5], buckets=8).first()["quantiles"]) == list(np.quantile(v, [0.25, 0.5]))
    assert q.exact_quantiles(df.where("v > 100"), "v", [0.5]).count() == 0
    assert q.exact_quantiles(df.where("v > 100").withColumn("g", F.lit(1)), "v", [0.5], by=["g"]).count() == 0


def test_density_equals_the_direct_sum(spark):
    rng = np.random.default_rng(4)
    groups = {"a": rng.normal(100, 15, 800), "heavy": rng.standard_t(1.2, 400) * 10, "b": np.array([1.0, 2.0, 50.0])}
    pdf = pd.concat([pd.DataFrame({"g": g, "v": v}) for g, v in groups.items()] +
                    [pd.DataFrame({"g": ["flat", "flat", "alone"], "v": [1.0, 1.0, 2.0]})])
    rows = density_by_group(spark.createDataFrame(pdf), "g", "v", grid=64).collect()
    assert len(rows) == 3 * 64
    for g, v in groups.items():
        mine = sorted((r.i, r.x, r.density) for r in rows if r.g == g)
        h = v.std(ddof=1) * len(v) ** -0.2
        x = np.linspace(v.min() - 2 * h, v.max() + 2 * h, 64)
        want = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * math.sqrt(2 * math.pi))
        assert np.allclose([m[1] for m in mine], x, rtol=0, atol=1e-9 * (x.max() - x.min()))
        assert np.abs(np.array([m[2] for m in mine]) - want).max() < 1e-13 * want.max()


def test_density_ships_boxes_not_values(spark):
    n = 20_000
    df = spark.range(n).select(F.lit("g").alias("g"), (F.sin(F.col("id")) * 50 + F.col("id") / n).alias("v"))
    plan = density_by_group(df, "g", "v")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Generate explode(sequence"):]
    assert "Aggregate" in below  # rows are folded before anything is exploded
    h = df.agg(F.stddev_samp("v")).first()[0] * n ** -0.2
    boxes = df.select(F.floor(F.col("v") / (h * 0.5 * math.sqrt(2)))).distinct().count()
    assert boxes < 60 < df.select("v").distinct().count()
