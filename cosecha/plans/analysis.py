"""The analyses run on the integrated tables: worst states, nutrition by
income quintile, a combined cost/health index, fibre-price correlation,
healthy-vs-unhealthy price tests and distributions, and a +20 % price
what-if."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.functions.arith import fill0, round_half_even
from cosecha.functions.recode import recode_replace
from cosecha.functions.text import space_to_underscore
from cosecha.operators.aggregate import share_case
from cosecha.operators.quantile import bin_labels, qcut, qcut_edges
from cosecha.operators.relational import filter_not_null, order_desc, with_flag
from cosecha.operators.stats import (box_stats, density_by_group, ols_fit, pearson, whatif_delta,
                                     whatif_predict, welch_ttest)
from cosecha.operators.survey import conditional_counts
from cosecha.session import materialize

# ---- fixed values (must equal the analysed pipeline's) -------------------
TOP_STATES = 15
TOP_GROUPS = 10
INCOME_QUANTILES = 5
# two-class recode, first form (labels with a space)
TWO_CLASS = {"Balanceado": "Saludable", "Alto_Fibra": "Saludable", "Alto_Azucar": "No saludable"}
TWO_CLASS_LABELS = ["Saludable", "No saludable"]
# two-class recode, second form (labels normalised to underscores first)
TWO_CLASS_U = {"Balanceado": "Saludable", "Alto_Fibra": "Saludable", "Alto_Azucar": "No_Saludable",
               "Bajo_Fibra": "No_Saludable"}
TWO_CLASS_U_LABELS = ["Saludable", "No_Saludable"]
PRICE_RISE = 1.2
INDEX_SCALE = 1000
CHOLESTEROL_DIVISOR = 10
MIN_N_FOR_TEST = 2
# -------------------------------------------------------------------------


def state_profile(b: DataFrame, state: str = "state") -> DataFrame:
    """Per state: participants, diabetes, unhealthy lifestyle, both; shares in %
    (2 decimals, half-even); sorted worst first."""
    d = filter_not_null(b, [state, "tiene_diabetes", "estilo_vida_saludable"])
    d = with_flag(d, "perfil_metabolico_malo", F.col("tiene_diabetes") == 1, F.col("estilo_vida_saludable") == 0)
    g = conditional_counts(d, [state], {"no_saludable": F.col("estilo_vida_saludable") == 0,
                                        "ambos": F.col("perfil_metabolico_malo")},
                           sums={"con_diabetes": "tiene_diabetes"}, n_name="total", n_of="tiene_diabetes")
    pct = lambda c: round_half_even(F.col(c) / F.col("total") * F.lit(100), 2)
    g = g.select(state, "total", "con_diabetes", "no_saludable", "ambos",
                 pct("con_diabetes").alias("pct_diabetes"), pct("no_saludable").alias("pct_no_saludable"),
                 pct("ambos").alias("pct_ambos"))
    return order_desc(g, "pct_ambos", state)


def top_states(b: DataFrame, k: int = TOP_STATES, state: str = "state") -> DataFrame:
    return state_profile(b, state).limit(k)


def income_gap(a: DataFrame, income: str, measures: Sequence[str], q: int = INCOME_QUANTILES,
               label: str = "quintil_ingreso") -> DataFrame:
    """Means of ``measures`` per income quantile (labels Q1..Qk over the
    surviving bins; bins without rows still listed, with NULL means)."""
    d = filter_not_null(a, [income, *measures])
    edges = qcut_edges(d, income, q)
    binned = qcut(d, income, q, out=label, bin_col="_bin", edges=edges)
    means = binned.groupBy("_bin").agg(*[F.avg(m).alias(m) for m in measures])
    bins = bin_labels(d, income, q, label_col=label, bin_col="_bin", edges=edges)
    return (bins.join(means, "_bin", "left")
                .select(label, *[round_half_even(m, 2).alias(m) for m in measures]))


def avg_price_by_class(integrated: DataFrame, cls: str = "clasificacion_salud",
                       price: str = "precio_promedio_clp") -> DataFrame:
    """``SELECT cls, AVG(price) ... WHERE price > 0 GROUP BY cls`` (SQL keeps the
    NULL group)."""
    return (integrated.where(F.col(price) > 0).groupBy(cls)
            .agg(F.avg(price).alias("precio_prom")))


def combined_index(b: DataFrame, integrated: DataFrame) -> DataFrame:
    """share(medcost1 == 1) * mean(per-class mean price) / 1000, one row.
    The share is a one-row aggregate used as a scalar subquery."""
    share = share_case(b, F.col("medcost1") == 1, "dificultad_salud")
    per_class = avg_price_by_class(integrated)
    return per_class.agg(
        (share.select("dificultad_salud").scalar() * F.avg("precio_prom") / F.lit(INDEX_SCALE)).alias("indice"))


def fibre_price(integrated: DataFrame) -> DataFrame:
    return integrated.where(F.col("Fibra").isNotNull() & (F.col("precio_promedio_clp") > 0)).select(
        "Fibra", "precio_promedio_clp", "grupo_odepa")


def fibre_price_corr(integrated: DataFrame) -> DataFrame:
    return pearson(fibre_price(integrated), "Fibra", "precio_promedio_clp", "corr")


def two_class(integrated: DataFrame, cls: str = "clasificacion_salud",
              price: str = "precio_promedio_clp") -> DataFrame:
    """First form: recode with ``replace`` (unmapped classes kept), then keep
    the two target labels."""
    d = integrated.where(F.col(cls).isNotNull() & (F.col(price) > 0)).select(cls, price)
    d = d.withColumn(cls, recode_replace(cls, TWO_CLASS))
    return d.where(F.col(cls).isin(TWO_CLASS_LABELS))


def two_class_u(integrated: DataFrame, cls: str = "clasificacion_salud",
                price: str = "precio_promedio_clp") -> DataFrame:
    """Second form: strip, spaces -> underscores, recode (no filter)."""
    d = integrated.where(F.col(cls).isNotNull() & (F.col(price) > 0)).select(cls, price)
    return d.withColumn(cls, recode_replace(space_to_underscore(cls), TWO_CLASS_U))


def price_ttest(integrated: DataFrame) -> DataFrame:
    """Welch t-test of price, healthy vs unhealthy (first form)."""
    d = two_class(integrated)
    c = F.col("clasificacion_salud")
    return welch_ttest(d, "precio_promedio_clp", c == TWO_CLASS_LABELS[0], c == TWO_CLASS_LABELS[1])


def price_ttest_u(integrated: DataFrame, overlapping: bool = False) -> DataFrame:
    """Second form, guarded by n > 2 on both sides. Groups are disjoint by
    default; ``overlapping=True`` reproduces the case-insensitive substring
    groups, where "Saludable" also matches "No_Saludable"."""
    d = two_class_u(integrated)
    c = F.col("clasificacion_salud")
    if overlapping:
        ca, cb = F.lower(c).contains("saludable"), F.lower(c).contains("no_saludable")
    else:
        ca, cb = c == TWO_CLASS_U_LABELS[0], c == TWO_CLASS_U_LABELS[1]
    return welch_ttest(d, "precio_promedio_clp", ca, cb, min_n=MIN_N_FOR_TEST)


def _class_prices(integrated: DataFrame) -> DataFrame:
    """Two columns of the join, stored: what follows scans them two or three times."""
    return materialize(two_class_u(integrated).select("clasificacion_salud", "precio_promedio_clp"), "class-prices")


def price_box(integrated: DataFrame) -> DataFrame:
    return box_stats(_class_prices(integrated), "clasificacion_salud", "precio_promedio_clp")


def price_density(integrated: DataFrame, grid: int = 100) -> DataFrame:
    return density_by_group(_class_prices(integrated), "clasificacion_salud", "precio_promedio_clp", grid=grid)


def quality_index(integrated: DataFrame) -> DataFrame:
    """Rows with a price and fibre value, with the nutrition quality index."""
    d = integrated.where((F.col("precio_promedio_clp") > 0) & F.col("Fibra").isNotNull()).select(
        "precio_promedio_clp", "Fibra", "Colesterol_Dietetico", "Grasas_Saludables", "grupo_odepa")
    return d.withColumn("indice_calidad", fill0("Fibra") + fill0("Grasas_Saludables")
                        - fill0("Colesterol_Dietetico") / F.lit(CHOLESTEROL_DIVISOR))


def quality_model(integrated: DataFrame) -> DataFrame:
    return ols_fit(quality_index(integrated), "precio_promedio_clp", "indice_calidad")


def quality_whatif(integrated: DataFrame) -> DataFrame:
    return whatif_predict(quality_index(integrated), "precio_promedio_clp", "indice_calidad", PRICE_RISE,
                          "precio_simulado", "calidad_esperada")


def quality_delta(integrated: DataFrame) -> DataFrame:
    return whatif_delta(quality_index(integrated), "precio_promedio_clp", "indice_calidad", PRICE_RISE, "delta")
