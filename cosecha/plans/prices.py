"""Products with price statistics (ODEPA_AGREGADO) and products matched to
foods (ODEPA_FDC_INTEGRADO)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.functions.arith import round_half_even, safe_div
from cosecha.functions.text import normalize_text
from cosecha.operators.aggregate import group_stats
from cosecha.operators.fuzzy import fuzzy_best_match
from cosecha.operators.quantile import qcut
from cosecha.operators.relational import join_left
from cosecha.session import materialize

# ---- fixed values (must equal the analysed pipeline's) -------------------
PRICE_LABELS = ["Bajo", "Medio-Bajo", "Medio-Alto", "Alto"]
PRICE_QUANTILES = 4
MATCH_CUTOFF = 0.5
GOOD_MATCH_SCORE = 80
# -------------------------------------------------------------------------

PRICE_ORDER = ("ord1", "ord2", "ord3", "ord4")


def price_stats(prices: DataFrame, product: str = "producto", price: str = "precio",
                group: str = "grupo", unit: str = "unidad", order: Sequence[str] = PRICE_ORDER) -> DataFrame:
    """mean/min/max/std/count of the price per product, first non-null group
    and unit."""
    out = group_stats(
        prices, [product],
        {"Precio_Promedio_CLP": ("mean", price), "Precio_Min_CLP": ("min", price),
         "Precio_Max_CLP": ("max", price), "Precio_Std_CLP": ("std", price),
         "N_Observaciones": ("count", price)},
        firsts={"Grupo": group, "Unidad": unit}, order=list(order))
    return out.withColumnRenamed(product, "Producto")


def price_products(prices: DataFrame, **kw) -> DataFrame:
    """ODEPA_AGREGADO: stats + normalised name + price quartile + volatility."""
    # one row per product, read by the quartile edges and by the binning pass
    agg = materialize(price_stats(prices, **kw).withColumn("producto_normalizado", normalize_text("Producto")),
                      "price-stats")
    agg = qcut(agg, "Precio_Promedio_CLP", PRICE_QUANTILES, labels=PRICE_LABELS, out="categoria_precio")
    return agg.withColumn("volatilidad_precio",
                          safe_div("Precio_Std_CLP", "Precio_Promedio_CLP") * F.lit(100))


def match_products(products: DataFrame, foods: DataFrame, cutoff: float = MATCH_CUTOFF,
                   method: str = "difflib", how: str = "inner") -> DataFrame:
    """Correspondences: every product whose normalised name reaches the cutoff
    against a lower-cased food description, with the first food id of the
    best description. Unmatched products are dropped, or kept with NULL food
    columns by ``how="left"``."""
    right = foods.select("fdc_id", F.lower("description").alias("_desc"))
    best = fuzzy_best_match(products, "producto_normalizado", right, "_desc", "fdc_id",
                            cutoff=cutoff, method=method)
    p = products.select(F.col("Producto").alias("producto_odepa"),
                        F.col("producto_normalizado").alias("producto_odepa_norm"),
                        F.col("Precio_Promedio_CLP").alias("precio_promedio_clp"),
                        F.col("Grupo").alias("grupo_odepa"), "categoria_precio")
    b = best.select(F.col("producto_normalizado").alias("producto_odepa_norm"), "fdc_id",
                    F.col("match_text").alias("fdc_description"), "match_score")
    j = p.join(b, "producto_odepa_norm", how)
    return j.select("producto_odepa", "producto_odepa_norm", "fdc_id", "fdc_description", "match_score",
                    "precio_promedio_clp", "grupo_odepa", "categoria_precio")


def price_food(products: DataFrame, foods_integrated: DataFrame, stored: bool = False, **kw) -> DataFrame:
    """ODEPA_FDC_INTEGRADO: correspondences left-joined to the food table.

    Both inputs feed two branches (the match and the join back), so each is
    materialised once in the shared checkpoint folder, unless both are tables
    already (``stored``); the result is lazy."""
    if not stored:
        products = materialize(products, "products")
        foods_integrated = materialize(foods_integrated, "foods")
    return join_left(match_products(products, foods_integrated, **kw), foods_integrated, "fdc_id")


def priced_foods(prices: DataFrame, foods_integrated: DataFrame, food_id: str = "ord4") -> DataFrame:
    """Every price observation joined to the food it was taken for: the analyses'
    input, which grows with the observations."""
    p = prices.select(F.col(food_id).alias("fdc_id"), F.col("producto").alias("producto_odepa"),
                      F.col("precio").alias("precio_promedio_clp"), F.col("grupo").alias("grupo_odepa"))
    return p.join(foods_integrated, "fdc_id")


def match_quality(matches: DataFrame, good: float = GOOD_MATCH_SCORE) -> DataFrame:
    """Number of matches, mean score and matches above ``good``."""
    s = F.col("match_score")
    return matches.agg(F.count(F.lit(1)).alias("n_matches"), F.avg(s).alias("score_promedio"),
                       F.count_if(s > F.lit(good)).alias("n_score_alto"))


def price_by_class(integrated: DataFrame, cls: str = "clasificacion_salud",
                   price: str = "precio_promedio_clp") -> DataFrame:
    """Mean, exact median and count of the price per health class, rounded."""
    from cosecha.operators.quantile import exact_quantiles
    # two columns of the join, stored: they are scanned three times
    d = materialize(integrated.where(F.col(cls).isNotNull()).select(cls, price), "class-prices")
    agg = d.groupBy(cls).agg(F.avg(price).alias("precio_mean"), F.count(F.col(price)).alias("precio_count"))
    med = exact_quantiles(d, price, [0.5], by=[cls], out="_q").select(cls, F.col("_q")[0].alias("precio_median"))
    return (agg.join(med, cls, "left")
               .select(cls, round_half_even("precio_mean", 2).alias("precio_mean"),
                       round_half_even("precio_median", 2).alias("precio_median"), "precio_count"))
