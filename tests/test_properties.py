"""Property tests: seeded random data against pandas / numpy / difflib."""

import difflib

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cosecha import adapters as A
from cosecha.functions.text import normalize_text
from cosecha.operators.fuzzy import candidate_pairs, fuzzy_best_match
from cosecha.operators.quantile import exact_quantiles, linspace_fractions, qcut
from cosecha.operators.stats import ols_fit, whatif_delta


@settings(max_examples=6, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=12), min_size=2, max_size=60), st.sampled_from([3, 4, 5, 10]))
def test_qcut_bins_equal_pandas(spark, values, q):
    _check_qcut(spark, values, q)


def test_qcut_known_tie_case(spark):
    # pandas' percent round trip makes 2/3 -> 0.6666666666666665: two bins here
    _check_qcut(spark, [0, 0, 0, 0, 0, 0, 1, 1, 1, 1], 3)


def _check_qcut(spark, values, q):
    data = [float(v) / 2 for v in values]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i int, v double")
    got = [r["b"] for r in qcut(df, "v", q, bin_col="b").orderBy("i").collect()]
    if len(set(data)) == 1:
        assert got == [None] * len(data)
        return
    exp = pd.qcut(pd.Series(data), q, labels=False, duplicates="drop")
    assert got == [None if pd.isna(x) else int(x) + 1 for x in exp]


@pytest.mark.parametrize("buckets", [4, 64])
def test_bucketed_quantiles_equal_numpy(spark, buckets):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"g": rng.integers(0, 4, 3000), "v": np.round(rng.lognormal(2, 1, 3000), 1)})
    df = spark.createDataFrame(pdf)
    fr = linspace_fractions(4) + [0.1, 0.99]
    got = {r["g"]: list(r["quantiles"]) for r in
           exact_quantiles(df, "v", fr, by=["g"], buckets=buckets).collect()}
    for g, vals in got.items():
        assert vals == list(np.quantile(pdf[pdf.g == g].v.to_numpy(), fr))


def test_fuzzy_equals_get_close_matches_on_fixture(spark, sf0001):
    prods = A.fuzzy_products(spark, sf0001).select(normalize_text("producto").alias("p"))
    foods = A.food(spark, sf0001).select("fdc_id", F.lower("description").alias("d"))
    got = {r["p"]: r["match_text"] for r in fuzzy_best_match(prods, "p", foods, "d", "fdc_id").collect()}
    words = [r["p"] for r in prods.distinct().collect()]
    poss = [r["d"] for r in foods.orderBy("fdc_id").collect()]
    for w in words:
        m = difflib.get_close_matches(w, poss, n=1, cutoff=0.5)
        assert got.get(w) == (m[0] if m else None), w


@pytest.mark.parametrize("method", ["difflib", "levenshtein"])
@pytest.mark.parametrize("cutoff", [0.0, 0.3, 0.5, 0.8, 1.0])
def test_candidates_lose_no_pair(spark, method, cutoff):
    rng = np.random.default_rng(5)
    words = ["", "a", "aa"] + ["".join(rng.choice(list("abcd é"), rng.integers(1, 9))) for _ in range(60)]
    left = spark.createDataFrame([(w,) for w in sorted(set(words[:40]))], "_l string")
    right = spark.createDataFrame([(w,) for w in sorted(set(words[20:]) | {"", "a"})], "_r string")
    got = [(r["_l"], r["_r"]) for r in candidate_pairs(left, right, method, cutoff).collect()]
    assert len(got) == len(set(got))

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return 1 - row[-1] / max(len(a), len(b)) if a or b else 1.0
    score = lev if method == "levenshtein" else lambda a, b: difflib.SequenceMatcher(None, b, a).ratio()
    need = {(a, b) for a in set(words[:40]) for b in set(words[20:]) | {"", "a"} if score(a, b) >= cutoff}
    assert need <= set(got)


@pytest.mark.parametrize("method", ["difflib", "levenshtein"])
def test_cutoff_zero_keeps_long_texts(spark, method):
    left = spark.createDataFrame([("a",)], "l string")
    right = spark.createDataFrame([("x" * 2500 + "a", 7)], "r string, i long")
    assert fuzzy_best_match(left, "l", right, "r", "i", cutoff=0.0, method=method).count() == 1


def test_few_of_the_possible_pairs_are_scored(spark):
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 5))
    names = [f"{word()} {word()} {word()}" for _ in range(5000)]
    left = spark.createDataFrame([(n,) for n in names], "_l string").repartition(4)
    right = spark.createDataFrame([(n[:7] + "x" + n[8:],) for n in names], "_r string").repartition(4)
    pairs = candidate_pairs(left, right, "difflib", 0.9)
    n = pairs.agg(F.count("*"), F.count_if(F.substring("_l", 1, 6) == F.substring("_r", 1, 6))).first()
    assert 5000 <= n[1] and n[0] < 5000 * 5000 / 1000


def test_length_band_is_lossless():
    # every pair that reaches the cutoff satisfies the length bound used to join
    rng = np.random.default_rng(3)
    alphabet = "abcde "
    for _ in range(3000):
        a = "".join(rng.choice(list(alphabet), rng.integers(1, 12)))
        b = "".join(rng.choice(list(alphabet), rng.integers(1, 12)))
        if difflib.SequenceMatcher(None, a, b).ratio() >= 0.5:
            la, lb = len(a), len(b)
            assert lb >= la * 0.5 / 1.5 - 1e-9 and lb <= la * 1.5 / 0.5 + 1e-9


def test_whatif_delta_is_slope_times_mean_shift(spark):
    rng = np.random.default_rng(11)
    x = rng.uniform(100, 1000, 200)
    y = 3 - 0.002 * x + rng.normal(0, 0.1, 200)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    slope = ols_fit(df, "x", "y").first()["slope"]
    delta = whatif_delta(df, "x", "y", 1.2).first()["delta"]
    assert delta == pytest.approx(slope * 0.2 * x.mean(), rel=1e-9)
    assert slope == pytest.approx(np.polyfit(x, y, 1)[0], rel=1e-9)


def test_mixed_small_and_wide_groups(spark):
    rng = np.random.default_rng(13)
    wide = pd.DataFrame({"g": "wide", "v": np.round(rng.normal(0, 50, 4000), 2)})
    small = pd.DataFrame({"g": rng.choice(["a", "b", "c"], 300), "v": rng.integers(0, 15, 300).astype(float)})
    pdf = pd.concat([wide, small], ignore_index=True)
    df = spark.createDataFrame(pdf)
    fr = linspace_fractions(5)
    got = {r["g"]: list(r["quantiles"]) for r in
           exact_quantiles(df, "v", fr, by=["g"], buckets=16).collect()}
    assert set(got) == {"wide", "a", "b", "c"}
    for g, vals in got.items():
        assert vals == list(np.quantile(pdf[pdf.g == g].v.to_numpy(), fr)), g
