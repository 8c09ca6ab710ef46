"""The integration run: every integrated table written to a store with replace
semantics, then the inventory of what was produced.

Each output is one distributed write. Tables that later steps read (the
foods with nutrients, the products) are read back from the store rather than
recomputed. The secondary indexes of the source pipeline become
``cluster_by``: laid out along a space-filling curve over all indexed columns, so
Parquet min/max statistics serve filters on each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cosecha._util import resolve_existing
from cosecha.operators.survey import table_inventory
from cosecha.plans import food as fd
from cosecha.plans import prices as pr
from cosecha.plans import surveys as sv
from cosecha.sources.tables import concurrently, scan_table, write_replace

# ---- fixed values (must equal the analysed pipeline's) -------------------
# the integrated tables, in report order
INTEGRATED_TABLES = [
    "FDC_NUTRIENTES_INTEGRADO",
    "ODEPA_AGREGADO",
    "ODEPA_FDC_INTEGRADO",
    "COMPARACION_DIABETES_EDAD",
    "COMPARACION_DIABETES_IMC",
    "NHANES_DIABETES_FIBRA",
    "NHANES_DIABETES_AZUCAR",
    "RESUMEN_COMPARATIVO_NHANES_BRFSS",
    "DATOS_ANALISIS_FINAL",
]
# indexed columns per table
INDEXES = {
    "FDC_NUTRIENTES_INTEGRADO": ["fdc_id", "clasificacion_salud"],
    "ODEPA_AGREGADO": ["Producto", "Grupo"],
    "ODEPA_FDC_INTEGRADO": ["producto_odepa", "fdc_id"],
    "DATOS_ANALISIS_FINAL": ["SEQN", "tiene_diabetes", "grupo_edad"],
}
# -------------------------------------------------------------------------


def _cluster_columns(df: DataFrame, table: str) -> list[str]:
    """The indexed columns that exist (case-insensitive)."""
    return resolve_existing(df.columns, INDEXES.get(table, []))


def integrate(spark: SparkSession, food: DataFrame, food_nutrient: DataFrame, prices: DataFrame,
              survey_a: DataFrame, survey_b: DataFrame, store: str) -> DataFrame:
    """Write the integrated tables into ``store`` and return the inventory
    (table_name, status ok/missing, n_rows). A table whose inputs lack the
    needed columns is not produced and shows as missing."""
    def put(name: str, df: DataFrame | None) -> DataFrame | None:
        if df is None:
            return None
        write_replace(df, store, name, cluster_by=_cluster_columns(df, name))
        return scan_table(spark, store, name)

    def foods() -> DataFrame:
        return put("FDC_NUTRIENTES_INTEGRADO", fd.food_integrated(food, food_nutrient))

    def products() -> DataFrame:
        return put("ODEPA_AGREGADO", pr.price_products(prices))

    def surveys() -> None:
        put("COMPARACION_DIABETES_EDAD", sv.prevalence_by_age(survey_a, survey_b))
        put("COMPARACION_DIABETES_IMC", sv.prevalence_by_bmi(survey_a, survey_b))
        put("NHANES_DIABETES_FIBRA", sv.prevalence_by(survey_a, "categoria_fibra"))
        put("NHANES_DIABETES_AZUCAR", sv.prevalence_by(survey_a, "categoria_azucar"))
        put("RESUMEN_COMPARATIVO_NHANES_BRFSS", sv.survey_summary(survey_a, survey_b))
        put("DATOS_ANALISIS_FINAL", sv.final_analysis(survey_a))

    # the three lean on nothing of each other: one's small jobs run beside another's large ones
    food_table, product_table, _ = concurrently(lambda job: job(), [foods, products, surveys])
    put("ODEPA_FDC_INTEGRADO", pr.price_food(product_table, food_table, stored=True))
    return table_inventory(spark, {t: (lambda t=t: scan_table(spark, store, t)) for t in INTEGRATED_TABLES})
