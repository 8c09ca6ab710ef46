"""Foods with key nutrients, derived measures and a health class
(FDC_NUTRIENTES_INTEGRADO)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cosecha.functions.arith import fill, fill0, safe_div
from cosecha.operators.aggregate import pivot_first
from cosecha.operators.relational import join_inner

# ---- fixed values (must equal the analysed pipeline's) -------------------
# key nutrients: nutrient id -> column name
KEY_NUTRIENTS = {
    1003: "Proteina",
    1004: "Grasa_Total",
    1005: "Carbohidratos",
    1079: "Fibra",
    1087: "Calcio",
    1089: "Hierro",
    1095: "Zinc",
    1253: "Colesterol_Dietetico",
    1258: "Acidos_Grasos_Saturados",
    1292: "Acidos_Grasos_Monoinsaturados",
    1293: "Acidos_Grasos_Poliinsaturados",
    2000: "Azucares_Totales",
    1008: "Energia",
    1093: "Sodio",
}
# health classes, tested in this order: (column, threshold, label); else default
CLASS_RULES = [
    ("Azucares_Totales", 15, "Alto_Azucar"),
    ("Acidos_Grasos_Saturados", 5, "Alto_Grasa_Sat"),
    ("Sodio", 400, "Alto_Sodio"),
    ("Fibra", 5, "Alto_Fibra"),
]
CLASS_DEFAULT = "Balanceado"
# fill values used by the derived measures
FIBRE_FILL_DIVISOR = 0.1
SATURATED_FILL_DIVISOR = 0.1
# -------------------------------------------------------------------------

# pivot columns come out ordered by nutrient id (pandas sorts pivot columns)
PIVOT_IDS = sorted(KEY_NUTRIENTS)
PIVOT_COLUMNS = [KEY_NUTRIENTS[i] for i in PIVOT_IDS]
DERIVED_COLUMNS = ["Carb_Netos", "Indice_Glicemico_Est", "Grasas_Saludables",
                   "Ratio_Grasas_Saludables", "Densidad_Fibra"]


def nutrient_pivot(food_nutrient: DataFrame, order: Sequence[str] = ("ord1", "ord2"),
                   nutrients: dict | None = None) -> DataFrame:
    """Long (fdc_id, nutrient_id, amount) -> one row per food, one column per
    key nutrient, first non-null amount under ``order``."""
    nutrients = nutrients or KEY_NUTRIENTS
    ids = sorted(nutrients)
    return pivot_first(food_nutrient, "fdc_id", "nutrient_id", "amount", ids, nutrients, list(order))


def derived_measures(df: DataFrame) -> DataFrame:
    """The five derived nutrition measures (NULL where pandas gives inf/NaN)."""
    carb_netos = F.col("Carbohidratos") - fill0("Fibra")
    grasas = fill0("Acidos_Grasos_Monoinsaturados") + fill0("Acidos_Grasos_Poliinsaturados")
    return df.withColumns({
        "Carb_Netos": carb_netos,
        "Indice_Glicemico_Est": safe_div(carb_netos, fill("Fibra", FIBRE_FILL_DIVISOR) + F.lit(1)),
        "Grasas_Saludables": grasas,
        "Ratio_Grasas_Saludables": safe_div(grasas, fill("Acidos_Grasos_Saturados", SATURATED_FILL_DIVISOR) + F.lit(1)),
        "Densidad_Fibra": safe_div(fill0("Fibra"), F.nullif(F.col("Energia"), F.lit(0))) * F.lit(100),
    })


def health_class(df: DataFrame, name: str = "clasificacion_salud") -> DataFrame:
    """Ordered CASE; a NULL (or absent) measure never fires its rule."""
    expr = None
    for c, threshold, label in CLASS_RULES:
        cond = (F.col(c) > F.lit(threshold)) if c in df.columns else F.lit(False)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return df.withColumn(name, expr.otherwise(F.lit(CLASS_DEFAULT)))


def food_integrated(food: DataFrame, food_nutrient: DataFrame,
                    order: Sequence[str] = ("ord1", "ord2")) -> DataFrame:
    """FDC_NUTRIENTES_INTEGRADO: foods x pivoted nutrients (inner), derived
    measures and class. Both join inputs are keyed by fdc_id; the pivot's
    aggregate already hash-partitions on it."""
    piv = nutrient_pivot(food_nutrient, order)
    base = food.select("fdc_id", "description", "food_category_id")
    return health_class(derived_measures(join_inner(base, piv, "fdc_id")))
