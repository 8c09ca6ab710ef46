"""Two-survey comparison tables (COMPARACION_*, NHANES_DIABETES_*,
RESUMEN_COMPARATIVO_*, DATOS_ANALISIS_FINAL)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cosecha.functions.recode import recode_map
from cosecha.operators.relational import (column_or_null, has_columns, select_existing, union_by_name,
                                          with_literal)
from cosecha.operators.survey import completeness, dataset_summary, prevalence

# ---- fixed values (must equal the analysed pipeline's) -------------------
LIFESTYLE_LABELS = {0: "No Saludable", 1: "Saludable"}
SOURCE_A = "NHANES"
SOURCE_B = "BRFSS"
# variables kept in the final analysis table, in this order
FINAL_VARS = [
    "SEQN", "RIDAGEYR", "RIAGENDR", "RIDRETH3", "DMDEDUC2", "INDFMPIR",
    "BMXBMI", "BMXWAIST", "categoria_imc", "ratio_cintura_cadera",
    "LBXGH", "LBXGLU", "LBXTC", "LBDHDD", "LBDLDL_calc",
    "tiene_diabetes", "diabetes_hba1c", "diabetes_glucosa",
    "colesterol_alto", "hdl_bajo", "trigliceridos_altos",
    "sindrome_metabolico", "sm_score", "riesgo_cardiovascular", "categoria_riesgo_cv",
    "promedio_tkcal", "promedio_tcarb", "promedio_tsugr", "promedio_tfibe",
    "promedio_ttfat", "promedio_tsfat", "promedio_tchol", "promedio_tsodi",
    "pct_calorias_azucar", "categoria_azucar", "categoria_fibra",
    "grupo_edad", "categoria_ingreso", "edad_grupo_brfss",
]
# variables whose completeness is reported
CRITICAL_VARS = ["tiene_diabetes", "colesterol_alto", "BMXBMI", "LBXGH", "promedio_tkcal", "sindrome_metabolico"]
# -------------------------------------------------------------------------

FLAG = "tiene_diabetes"


def _prev_or_none(df, group, group_as=None):
    if not has_columns(df, group, FLAG):
        return None
    return prevalence(df, group, FLAG, group_as=group_as)


def prevalence_compare(a: DataFrame, b: DataFrame, group_a: str, group_b: str, key: str) -> DataFrame | None:
    """Prevalence by one key in both surveys, stacked with a source tag
    (keys as strings so int and string codes union). NULL if either side
    lacks the columns (the table is then not produced)."""
    pa = _prev_or_none(a, group_a, key)
    pb = _prev_or_none(b, group_b, key)
    if pa is None or pb is None:
        return None
    return union_by_name([with_literal(pa, "fuente", SOURCE_A), with_literal(pb, "fuente", SOURCE_B)],
                         as_string=[key])


def prevalence_by_age(a: DataFrame, b: DataFrame) -> DataFrame | None:
    """COMPARACION_DIABETES_EDAD."""
    return prevalence_compare(a, b, "edad_grupo_brfss", "age_g", "edad_grupo_brfss")


def prevalence_by_bmi(a: DataFrame, b: DataFrame) -> DataFrame | None:
    """COMPARACION_DIABETES_IMC."""
    return prevalence_compare(a, b, "categoria_imc", "categoria_imc", "categoria_imc")


def prevalence_by_lifestyle(b: DataFrame, group: str = "estilo_vida_saludable") -> DataFrame | None:
    p = _prev_or_none(b, group)
    if p is None:
        return None
    return p.withColumn(group, recode_map(group, LIFESTYLE_LABELS))


def prevalence_by(a: DataFrame, group: str) -> DataFrame | None:
    """NHANES_DIABETES_FIBRA / _AZUCAR."""
    return _prev_or_none(a, group)


def survey_summary(a: DataFrame, b: DataFrame) -> DataFrame:
    """RESUMEN_COMPARATIVO_NHANES_BRFSS: two one-row aggregates stacked."""
    def flag(df):
        return column_or_null(df, FLAG) if has_columns(df, FLAG) else None
    sa = dataset_summary(a, SOURCE_A, flag(a), {"imc_promedio": column_or_null(a, "BMXBMI"),
                                                "edad_promedio": column_or_null(a, "RIDAGEYR")})
    sb = dataset_summary(b, SOURCE_B, flag(b), {"imc_promedio": column_or_null(b, "IMC_REAL"),
                                                "edad_promedio": None})
    return sa.unionByName(sb)


def final_analysis(a: DataFrame) -> DataFrame:
    """DATOS_ANALISIS_FINAL: existing listed variables + source tag."""
    return with_literal(select_existing(a, FINAL_VARS), "fuente_datos", SOURCE_A)


def final_completeness(final: DataFrame) -> DataFrame:
    present = [c for c in final.columns if c.lower() in {v.lower() for v in CRITICAL_VARS}]
    ordered = sorted(present, key=lambda c: [v.lower() for v in CRITICAL_VARS].index(c.lower()))
    return completeness(final, ordered)
