"""A third of all rows in one group / one value: results stay exact and the
row side is never shuffled on the hot key for a join."""

import numpy as np
import pandas as pd
import pytest

from cosecha.operators.quantile import exact_quantiles
from cosecha.operators.stats import box_stats, density_by_group
from cosecha.operators.survey import prevalence


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(21)
    n = 30000
    g = np.where(np.arange(n) < n // 3, "hot", rng.choice(["a", "b", "c", "d"], n))
    v = np.round(rng.gamma(2.0, 10.0, n), 1)
    v[: n // 6] = 7.0                                  # one hot value inside the hot group
    pdf = pd.DataFrame({"g": g, "v": v, "f": (v > 20).astype(int)})
    return pdf, spark.createDataFrame(pdf).repartition(8)


@pytest.mark.parametrize("buckets", [16, 1024])
def test_quantiles_exact_under_skew(skewed, buckets):
    pdf, df = skewed
    fr = [0.25, 0.5, 0.75, 0.9]
    got = {r["g"]: list(r["quantiles"]) for r in
           exact_quantiles(df, "v", fr, by=["g"], buckets=buckets).collect()}
    for g, vals in got.items():
        assert vals == list(np.quantile(pdf[pdf.g == g].v.to_numpy(), fr)), g


def test_prevalence_under_skew(skewed):
    pdf, df = skewed
    got = {r["g"]: (r["total"], r["con_diabetes"]) for r in prevalence(df, "g", "f").collect()}
    exp = pdf.groupby("g")["f"].agg(["count", "sum"])
    assert got == {k: (int(r["count"]), int(r["sum"])) for k, r in exp.iterrows()}


def test_hot_group_box_and_density(skewed):
    pdf, df = skewed
    sizes = pdf.groupby("g").size().to_dict()
    for r in box_stats(df, "g", "v").collect():
        v = pdf[pdf.g == r["g"]].v
        assert r["n"] == sizes[r["g"]] and r["median"] == np.quantile(v, 0.5)
    assert density_by_group(df, "g", "v", grid=10).count() == 10 * len(sizes)


def test_no_task_ranks_a_whole_column(skewed):
    from cosecha.operators.quantile import exact_quantiles
    _, df = skewed
    p = exact_quantiles(df, "v", [0.5])._jdf.queryExecution().executedPlan().toString()
    # everything meets in one task only as partial aggregates, never as rows of a window
    windows = [i for i, ln in enumerate(p.splitlines()) if "Window " in ln]
    assert windows and "Exchange SinglePartition" not in "\n".join(p.splitlines()[windows[0]:windows[0] + 4])


def test_statistics_with_first_values_sort_no_rows_by_group(spark, monkeypatch):
    """The scan of all rows is a hash aggregate; first values by a composite order
    (ties and NULLs in its first column, NULL values) are those of one ``min_by``."""
    import random

    from pyspark.sql import functions as F

    from cosecha.operators import aggregate as agg
    r = random.Random(4)
    rows = [(r.choice(["p", "q", "r", None]), r.choice([None, f"g{i}"]), r.choice([None, f"u{i}"]), float(i % 9),
             r.choice([1, 1, 2, 3] if i % 5 else [None, 4]), r.choice([None, 0.5, float(i)]), i) for i in range(600)]
    rows += [("alone", None, "u", 1.0, 9, None, 600), ("none", None, None, None, None, None, 601)]
    plans = []
    monkeypatch.setattr(agg, "materialize", lambda df, name: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or df)
    every = spark.createDataFrame(rows, "k string, g string, u string, v double, a long, b double, c long")
    for df in (every, every.where("a is not null")):
        for dropna in (True, False):
            got = agg.group_stats(df, ["k"], {"m": ("mean", "v"), "n": ("count", "v")}, {"G": "g", "U": "u"},
                                  ["a", "b", "c"], dropna=dropna)
            exp = (agg.drop_null_keys(df, ["k"]) if dropna else df).groupBy("k").agg(
                F.avg("v").alias("m"), F.count("v").alias("n"), agg.first_non_null("g", ["a", "b", "c"]).alias("G"),
                agg.first_non_null("u", ["a", "b", "c"]).alias("U"))
            assert got.columns == exp.columns
            assert sorted(map(repr, got.collect())) == sorted(map(repr, exp.collect()))
    assert plans and not any("SortAggregate" in p for p in plans)
