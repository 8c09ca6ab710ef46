"""Semantics rules M1-M16 on hand-made edge rows (expected values from pandas
or difflib, computed in the test)."""

import difflib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cosecha.functions import recode_map, recode_replace, normalize_text, round_half_even, safe_div
from cosecha.operators import aggregate as agg
from cosecha.operators import relational as rel
from cosecha.operators.fuzzy import fuzzy_best_match
from cosecha.operators.quantile import qcut, quantile_edges
from cosecha.operators.stats import pearson, welch_ttest, t_two_sided_p
from cosecha.operators.survey import completeness, prevalence
from cosecha.plans import food as fd


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_pivot_first_skips_nulls_and_drops_all_null_ids(spark):
    # (fdc_id, nutrient, amount, ord)
    df = spark.createDataFrame([(1, 10, None, 1), (1, 10, 5.0, 2), (1, 11, 7.0, 3), (2, 10, None, 4), (3, 10, 1.0, 5)],
                               "fdc_id long, nutrient_id int, amount double, o long")
    out = agg.pivot_first(df, "fdc_id", "nutrient_id", "amount", [10, 11], {10: "a", 11: "b"}, ["o"])
    assert rows(out, "fdc_id", "a", "b") == [(1, 5.0, 7.0), (3, 1.0, None)]
    pdf = df.toPandas().pivot_table(index="fdc_id", columns="nutrient_id", values="amount", aggfunc="first")
    assert sorted(pdf.index) == [1, 3]


def test_pivot_composite_order_equals_struct_order(spark):
    df = spark.createDataFrame([(1, 10, 1.0, 5, 2.0), (1, 10, 2.0, 5, 1.0), (1, 10, 3.0, 4, 9.0),
                                (1, 11, 4.0, 1, 1.0), (1, 11, 5.0, 1, 0.5)],
                               "fdc_id long, nutrient_id int, amount double, o1 long, o2 double")
    out = agg.pivot_first(df, "fdc_id", "nutrient_id", "amount", [10, 11], {10: "a", 11: "b"}, ["o1", "o2"])
    assert rows(out, "a", "b") == [(3.0, 5.0)]


def test_first_non_null_with_order(spark):
    df = spark.createDataFrame([("p", None, 1), ("p", "x", 2), ("p", "y", 3), ("q", None, 1)],
                               "k string, g string, o int")
    out = df.groupBy("k").agg(agg.first_non_null("g", ["o"]).alias("g"))
    assert rows(out, "k", "g") == [("p", "x"), ("q", None)]


def test_group_stats_null_keys_std_and_all_null_sum(spark):
    # M2, M3, M4, M5
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("b", None), ("c", 3.0), ("c", 5.0)], "k string, v double")
    out = agg.group_stats(df, ["k"], {"m": ("mean", "v"), "s": ("std", "v"), "n": ("count", "v"), "t": ("sum", "v")})
    got = {r["k"]: (r["m"], r["s"], r["n"], r["t"]) for r in out.collect()}
    assert set(got) == {"a", "b", "c"}
    assert got["a"][1] is None and got["b"] == (None, None, 0, 0)
    assert got["c"][0] == 4.0 and got["c"][1] == pytest.approx(math.sqrt(2))


def test_prevalence_pct_zero_when_no_flags(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", None), (None, 1)], "g string, f int")
    out = {r["g"]: (r["total"], r["con_diabetes"], r["prevalencia_pct"]) for r in prevalence(df, "g", "f").collect()}
    assert out == {"a": (2, 1, 50.0), "b": (0, 0, 0.0)}


def test_round_half_even_matches_pandas(spark):
    # M8
    vals = [0.125, 2.5, 33.335, 12.345, 1.005, 2.675]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(round_half_even("v", 2)).collect()]
    assert got[:4] == [0.12, 2.5, 33.34, 12.34]
    assert got[:4] == list(pd.Series(vals[:4]).round(2))


def test_safe_division_gives_null(spark):
    # M7: zero energy, zero mean price, fibre = -1 (divisor 0)
    df = spark.createDataFrame([(1.0, 0.0, -1.0, 4.0)], "fib double, energy double, fibra double, carb double")
    out = fd.derived_measures(df.select(F.col("carb").alias("Carbohidratos"), F.col("fibra").alias("Fibra"),
                                        F.col("energy").alias("Energia"),
                                        F.lit(None).cast("double").alias("Acidos_Grasos_Monoinsaturados"),
                                        F.lit(None).cast("double").alias("Acidos_Grasos_Poliinsaturados"),
                                        F.lit(None).cast("double").alias("Acidos_Grasos_Saturados"))).first()
    assert out["Indice_Glicemico_Est"] is None and out["Densidad_Fibra"] is None
    assert out["Carb_Netos"] == 5.0 and out["Grasas_Saludables"] == 0.0
    assert df.select(safe_div(F.lit(1.0), F.lit(0.0))).first()[0] is None


def test_classification_nan_and_null_fall_through(spark):
    # M1: NaN -> NULL at the scan; NULL never fires a rule
    pdf = pd.DataFrame({"Azucares_Totales": [np.nan, 20.0, None], "Acidos_Grasos_Saturados": [6.0, None, None],
                        "Sodio": [np.nan, np.nan, np.nan], "Fibra": [None, None, 6.0]}, dtype="float64")
    schema = "Azucares_Totales double, Acidos_Grasos_Saturados double, Sodio double, Fibra double"
    df = spark.createDataFrame(pdf, schema).replace(float("nan"), None)
    out = [r[0] for r in fd.health_class(df).select("clasificacion_salud").collect()]
    assert out == ["Alto_Grasa_Sat", "Alto_Azucar", "Alto_Fibra"]


def test_normalize_text_unicode(spark):
    # M11
    raw = ["  Limón Ñuble, (1ª) 50%  ", "a\tb  c", "Brand#2"]
    df = spark.createDataFrame([(r,) for r in raw], "t string")
    got = [r[0] for r in df.select(normalize_text("t")).collect()]
    exp = list(pd.Series(raw).str.lower().str.strip().str.replace(r"[^\w\s]", "", regex=True)
               .str.replace(r"\s+", " ", regex=True))
    assert got == exp
    assert got[0] == "limón ñuble 1ª 50"


def test_recode_map_vs_replace(spark):
    # M13
    df = spark.createDataFrame([(0,), (1,), (2,)], "v int")
    m = [r[0] for r in df.select(recode_map("v", {0: "no", 1: "si"})).collect()]
    assert m == ["no", "si", None]
    s = spark.createDataFrame([("A",), ("B",)], "c string")
    r = [x[0] for x in s.select(recode_replace("c", {"A": "Z"})).collect()]
    assert r == ["Z", "B"]


def test_union_by_name_casts_keys(spark):
    # M15
    a = spark.createDataFrame([(1, 2)], "k int, n int")
    b = spark.createDataFrame([("x", 3, "t")], "k string, n int, extra string")
    out = rel.union_by_name([a, b], as_string=["k"])
    assert rows(out, "k", "n", "extra") == [("1", 2, None), ("x", 3, "t")]


def test_select_existing_keeps_list_order(spark):
    df = spark.createDataFrame([(1, 2, 3)], "seqn int, bmxbmi int, other int")
    assert rel.select_existing(df, ["BMXBMI", "missing", "SEQN"]).columns == ["bmxbmi", "seqn"]
    assert rel.select_existing(df, ["BMXBMI", "seqn"], case_sensitive=True).columns == ["seqn"]


def test_correlation_zero_variance_is_null(spark):
    # M12
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 4.0)], "x double, y double")
    assert pearson(df, "x", "y").first()[0] is None


def test_completeness(spark):
    df = spark.createDataFrame([(1, None), (2, 3), (None, None)], "a int, b int")
    got = {r["variable"]: r["completitud_pct"] for r in completeness(df, ["a", "b", "zz"]).collect()}
    assert got == pytest.approx({"a": 200 / 3, "b": 100 / 3})


def test_welch_matches_formula_and_pvalue(spark):
    a = [10.0, 12.0, 9.5, 11.0, 14.0]
    b = [7.0, 8.5, 6.0, 9.0]
    df = spark.createDataFrame([("s", v) for v in a] + [("n", v) for v in b], "c string, v double")
    r = welch_ttest(df, "v", F.col("c") == "s", F.col("c") == "n").first()
    va, vb = np.var(a, ddof=1), np.var(b, ddof=1)
    t = (np.mean(a) - np.mean(b)) / math.sqrt(va / len(a) + vb / len(b))
    assert r["t"] == pytest.approx(t)
    # known two-sided critical values
    assert t_two_sided_p(2.228, 10) == pytest.approx(0.05, abs=2e-4)
    assert t_two_sided_p(12.706, 1) == pytest.approx(0.05, abs=2e-4)
    assert 0 < r["p"] < 0.05


def test_welch_guard_small_groups(spark):
    df = spark.createDataFrame([("s", 1.0), ("s", 2.0), ("n", 3.0), ("n", 5.0), ("n", 4.0)], "c string, v double")
    r = welch_ttest(df, "v", F.col("c") == "s", F.col("c") == "n", min_n=2).first()
    assert r["t"] is None and r["p"] is None


@pytest.mark.parametrize("data,q", [([1.0, 1, 10, 10], 5), ([1.0, 1, 1, 1, 1, 2, 3, 4], 4),
                                    ([3.0, 3, 3], 4), ([0.0, 0, 0, 10, 10, 10], 4)])
def test_qcut_ties_like_pandas(spark, data, q):
    # M9, M10, D7, H4
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(data)], "i int, v double")
    got = [r["b"] for r in qcut(df, "v", q, out="lab", bin_col="b").orderBy("i").collect()]
    try:
        exp = pd.qcut(pd.Series(data), q, labels=False, duplicates="drop")
        exp = [None if pd.isna(x) else int(x) + 1 for x in exp]
    except ValueError:
        exp = [None] * len(data)
    if len(set(data)) == 1:
        exp = [None] * len(data)        # one distinct edge: no bin
    assert got == exp


def test_quantile_edges_drop_duplicates(spark):
    df = spark.createDataFrame([(float(v),) for v in [1.0, 1, 1, 1, 1, 2, 3, 4]], "v double")
    e = quantile_edges(df, "v", 4).first()["edges"]
    _, bins = pd.qcut(pd.Series([1.0, 1, 1, 1, 1, 2, 3, 4]), 4, retbins=True, duplicates="drop")
    assert list(e) == list(bins)


def test_fuzzy_ties_and_cutoff(spark):
    # Ties go to the larger text; order of sequences matters; cutoff; first id
    right = spark.createDataFrame([(1, "abx"), (2, "aby"), (3, "tide"), (4, "aby"), (5, None), (6, "zzzz")],
                                  "fdc_id long, d string")
    left = spark.createDataFrame([("ab",), ("diet",), ("qqqq",)], "p string")
    got = {r["p"]: (r["match_text"], r["fdc_id"]) for r in
           fuzzy_best_match(left, "p", right, "d", "fdc_id", cutoff=0.5).collect()}
    poss = ["abx", "aby", "tide", "aby", "zzzz"]
    for w in ("ab", "diet", "qqqq"):
        m = difflib.get_close_matches(w, poss, n=1, cutoff=0.5)
        assert got.get(w, (None,))[0] == (m[0] if m else None)
    assert got["ab"] == ("aby", 2)


def test_text_classes_are_pythons(spark):
    import re
    from cosecha.functions.text import normalize_text
    texts = ["m² agua", "½ kilo", "limón", "x‿y", "a\x1cb", "\x1f z \x1c", " Limón Ñuble, (1ª) 50% \t", "a\xa0b_c", "Ⅷ ①"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["n"] for r in df.select("t", normalize_text("t").alias("n")).collect()}
    for t in texts:
        assert got[t] == re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", t.lower().strip())), ascii(t)
