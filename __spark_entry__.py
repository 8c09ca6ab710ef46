"""

``entry(spark)`` runs the flagship query (diabetes prevalence by age group
in both surveys) on sf0.001; ``queries()`` holds one callable per operator /
give the same rows (adapter views inlined as CTEs from the very same SQL text
the Spark side uses).

Float aggregates whose last bits depend on summation order are rounded here
(6 or 9 decimals) on both sides; the library itself returns full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cosecha import adapters as A
from cosecha.functions.text import normalize_text
from cosecha.operators import aggregate as agg
from cosecha.operators import relational as rel
from cosecha.operators.fuzzy import fuzzy_best_match
from cosecha.operators.quantile import qcut, quantile_edges
from cosecha.operators.survey import table_inventory
from cosecha.plans import analysis as an
from cosecha.plans import food as fd
from cosecha.plans import prices as pr
from cosecha.plans import surveys as sv
from cosecha.session import checkpoint_dir, tune

SF0001 = "/root/testdata/sf0.001"


# --------------------------------------------------------------------- helpers

def _round(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


def _doubles(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if f.dataType.typeName() == "double"]


def _round_all(df: DataFrame, digits: int, keep: tuple = ()) -> DataFrame:
    return _round(df, digits, *[c for c in _doubles(df) if c not in keep])


def _prep(spark: SparkSession) -> SparkSession:
    tune(spark)
    checkpoint_dir(spark)
    return spark


def _food_integrated(spark, d):
    return fd.food_integrated(A.food(spark, d), A.food_nutrient(spark, d))


def _products(spark, d):
    return pr.price_products(A.prices(spark, d))


def _integrated(spark, d):
    """The input of the analyses: every price observation with its food, as many
    rows as there are prices; computed from the tables on every call."""
    return pr.priced_foods(A.prices(spark, d), _food_integrated(spark, d))


def _pivot(spark, d):
    return fd.nutrient_pivot(A.food_nutrient(spark, d))


# ------------------------------------------------------------------ queries

def q_select_cols(spark, d):
    return rel.select_cols(A.food(spark, d), ["fdc_id", "description", "food_category_id"])


def q_select_existing(spark, d):
    return rel.select_existing(A.survey_a(spark, d), sv.FINAL_VARS)


FILTER_IDS = [1005, 1079, 1008, 1258, 1292, 1293]


def q_filter_in(spark, d):
    return rel.filter_in(A.food_nutrient(spark, d), "nutrient_id", FILTER_IDS)


def q_filter_not_null(spark, d):
    return rel.filter_not_null(A.survey_b(spark, d), ["state", "tiene_diabetes", "estilo_vida_saludable"])


def q_filter_compare(spark, d):
    return rel.filter_where(A.survey_b(spark, d), F.col("tiene_diabetes") == 1,
                            F.col("estilo_vida_saludable") == 0)


def q_filter_contains(spark, d):
    return rel.filter_contains(A.food(spark, d), "description", "RING", case=False)


def q_distinct_values(spark, d):
    return rel.distinct_values(A.survey_b(spark, d), "categoria_imc")


def q_scan_table(spark, d):
    return A.prices(spark, d)


SCAN_SQL = """
SELECT grupo, AVG(precio) AS precio_prom, COUNT(*) AS n
FROM {prices}
WHERE precio > 1000
GROUP BY grupo
"""


def q_scan_sql(spark, d):
    from cosecha.sources.tables import scan_sql
    return _round(scan_sql(spark, SCAN_SQL, prices=A.prices(spark, d)), 6, "precio_prom")


def q_join_inner(spark, d):
    base = A.food(spark, d).select("fdc_id", "description", "food_category_id")
    return rel.join_inner(base, _pivot(spark, d), "fdc_id")


# foods with their fibre and sugar values; foods with neither measured keep NULLs
FIBRE_SUGAR = {1079: "Fibra", 2000: "Azucares_Totales"}


def q_join_left(spark, d):
    base = A.food(spark, d).select("fdc_id", "description", "food_category_id")
    right = fd.nutrient_pivot(A.food_nutrient(spark, d), nutrients=FIBRE_SUGAR)
    return rel.join_left(base, right, "fdc_id")


def q_nutrient_pivot(spark, d):
    return _pivot(spark, d)


def q_derived_nutrients(spark, d):
    return fd.derived_measures(_pivot(spark, d))


def q_classify_food(spark, d):
    return fd.health_class(fd.derived_measures(_pivot(spark, d))).select("fdc_id", "clasificacion_salud")


def q_price_agg(spark, d):
    return _round_all(pr.price_stats(A.prices(spark, d)), 6)


def q_volatility(spark, d):
    s = pr.price_stats(A.prices(spark, d))
    v = s.select("Producto", (F.try_divide(F.col("Precio_Std_CLP"), F.col("Precio_Promedio_CLP")) * 100)
                 .alias("volatilidad_precio"))
    return _round(v, 6, "volatilidad_precio")


def q_normalize_text(spark, d):
    p = A.prices(spark, d).select("producto", "grupo").distinct()
    return p.select("producto", "grupo", normalize_text("producto").alias("producto_normalizado"),
                    normalize_text("grupo").alias("grupo_normalizado"))


def q_quantile_edges(spark, d):
    s = pr.price_stats(A.prices(spark, d))
    e = quantile_edges(s, "Precio_Promedio_CLP", pr.PRICE_QUANTILES)
    return _round(e.select(F.posexplode("edges").alias("edge_no", "edge"))
                  .withColumn("edge_no", F.col("edge_no") + 1), 6, "edge")


def q_quartile_bin(spark, d):
    s = pr.price_stats(A.prices(spark, d))
    b = qcut(s, "Precio_Promedio_CLP", pr.PRICE_QUANTILES, labels=pr.PRICE_LABELS, out="categoria_precio",
             bin_col="bin_no")
    return b.select("Producto", "categoria_precio", "bin_no")


def q_quintile_bin(spark, d):
    a = rel.filter_not_null(A.survey_a(spark, d), ["indfmpir"])
    b = qcut(a, "indfmpir", an.INCOME_QUANTILES, out="quintil_ingreso", bin_col="bin_no")
    return b.select("seqn", "quintil_ingreso", "bin_no")


def q_nutrient_gap_by_income(spark, d):
    return an.income_gap(A.survey_a(spark, d), "indfmpir", ["promedio_tfibe", "promedio_tchol"])


def q_prevalence_age(spark, d):
    p = sv.prevalence_by(A.survey_a(spark, d), "edad_grupo_brfss")
    return _round(rel.with_literal(p, "fuente", sv.SOURCE_A), 9, "prevalencia_pct")


def q_prevalence_union(spark, d):
    return _round(sv.prevalence_by_age(A.survey_a(spark, d), A.survey_b(spark, d)), 9, "prevalencia_pct")


def q_prevalence_bmi(spark, d):
    return _round(sv.prevalence_by_bmi(A.survey_a(spark, d), A.survey_b(spark, d)), 9, "prevalencia_pct")


def q_prevalence_lifestyle(spark, d):
    return _round(sv.prevalence_by_lifestyle(A.survey_b(spark, d)), 9, "prevalencia_pct")


def q_prevalence_fiber(spark, d):
    return _round(sv.prevalence_by(A.survey_a(spark, d), "categoria_fibra"), 9, "prevalencia_pct")


def q_prevalence_sugar(spark, d):
    return _round(sv.prevalence_by(A.survey_a(spark, d), "categoria_azucar"), 9, "prevalencia_pct")


def q_state_profile(spark, d):
    return an.state_profile(A.survey_b(spark, d))


def q_top_k_states(spark, d):
    return an.top_states(A.survey_b(spark, d))


def q_top_k_groups(spark, d):
    vc = agg.value_counts(pr.price_stats(A.prices(spark, d)), "Grupo")
    return rel.top_k(vc, an.TOP_GROUPS, F.col("count").desc(), F.col("Grupo").asc())


def q_value_counts(spark, d):
    return agg.value_counts(_food_integrated(spark, d), "clasificacion_salud")


def q_share_case(spark, d):
    return agg.share_case(A.survey_b(spark, d), F.col("medcost1") == 1, "dificultad_salud")


def q_avg_by_class(spark, d):
    return _round(an.avg_price_by_class(_integrated(spark, d)), 6, "precio_prom")


def q_combined_index(spark, d):
    return _round(an.combined_index(A.survey_b(spark, d), _integrated(spark, d)), 9, "indice")


def q_price_by_class(spark, d):
    return pr.price_by_class(_integrated(spark, d))


def q_pearson_corr(spark, d):
    return _round(an.fibre_price_corr(_integrated(spark, d)), 9, "corr")


def q_ols_fit(spark, d):
    return _round(an.quality_model(_integrated(spark, d)), 9, "slope", "intercept", "r2")


def q_whatif_predict(spark, d):
    w = an.quality_whatif(_integrated(spark, d))
    return _round(w.select("precio_promedio_clp", "indice_calidad", "precio_simulado", "calidad_esperada",
                           "grupo_odepa"), 6, "calidad_esperada")


def q_whatif_delta(spark, d):
    return _round(an.quality_delta(_integrated(spark, d)), 6, "delta")


def q_quality_index(spark, d):
    return an.quality_index(_integrated(spark, d))


def q_welch_ttest(spark, d):
    t = an.price_ttest(_integrated(spark, d)).drop("p")
    return _round(_round_all(t, 6, keep=("var_a", "var_b")), 3, "var_a", "var_b")


def q_welch_pvalue(spark, d):
    t = an.price_ttest_u(_integrated(spark, d))
    return _round(_round_all(t, 6, keep=("var_a", "var_b")), 3, "var_a", "var_b")


def q_box_stats(spark, d):
    return _round_all(an.price_box(_integrated(spark, d)), 6)


def q_density_by_class(spark, d):
    return _round(_round(an.price_density(_integrated(spark, d)), 6, "x"), 12, "density")


def _fuzzy_inputs(spark, d):
    left = A.fuzzy_products(spark, d).select(normalize_text("producto").alias("producto_normalizado"))
    right = A.food(spark, d).select("fdc_id", F.lower("description").alias("descripcion"))
    return left, right


def q_fuzzy_best_match(spark, d):
    left, right = _fuzzy_inputs(spark, d)
    return fuzzy_best_match(left, "producto_normalizado", right, "descripcion", "fdc_id",
                            cutoff=pr.MATCH_CUTOFF, method="difflib")


def q_fuzzy_lev(spark, d):
    left, right = _fuzzy_inputs(spark, d)
    m = fuzzy_best_match(left, "producto_normalizado", right, "descripcion", "fdc_id",
                         cutoff=pr.MATCH_CUTOFF, method="levenshtein")
    return _round(m, 9, "match_score")


def q_match_quality(spark, d):
    left, right = _fuzzy_inputs(spark, d)
    m = fuzzy_best_match(left, "producto_normalizado", right, "descripcion", "fdc_id",
                         cutoff=pr.MATCH_CUTOFF, method="levenshtein")
    return _round(pr.match_quality(m), 9, "score_promedio")


def q_recode_map(spark, d):
    from cosecha.functions.recode import recode_map
    b = A.survey_b(spark, d)
    return b.select("seqno", recode_map("estilo_vida_saludable", sv.LIFESTYLE_LABELS).alias("estilo_label"))


def q_recode_replace(spark, d):
    from cosecha.functions.recode import recode_replace
    c = q_classify_food(spark, d)
    return c.select("fdc_id", recode_replace("clasificacion_salud", an.TWO_CLASS).alias("clase"))


def q_survey_summary(spark, d):
    return _round_all(sv.survey_summary(A.survey_a(spark, d), A.survey_b(spark, d)), 9)


def q_completeness(spark, d):
    return _round(sv.final_completeness(sv.final_analysis(A.survey_a(spark, d))), 9, "completitud_pct")


INVENTORY = [*A.BASE_TABLES, "no_such_table"]


def q_table_inventory(spark, d):
    loaders = {t: (lambda t=t: A.table(spark, d, t)) for t in INVENTORY}
    return table_inventory(spark, loaders)


def q_flow_food_integrated(spark, d):
    return _food_integrated(spark, d)


def q_flow_price_products(spark, d):
    return _round(_products(spark, d), 6, "Precio_Promedio_CLP", "Precio_Std_CLP", "volatilidad_precio")


def q_flow_price_food(spark, d):
    """The integration flow itself (always computed)."""
    integrated = pr.price_food(_products(spark, d), _food_integrated(spark, d))
    return _round(integrated, 6, "precio_promedio_clp", "match_score")


def q_flow_final_analysis(spark, d):
    return sv.final_analysis(A.survey_a(spark, d))


def q_flow_integration(spark, d):
    """The integration run: all integrated tables written to a fresh store
    (replace, clustered on their index columns), reported by inventory."""
    from cosecha.plans.integration import integrate
    from cosecha.session import scratch_path
    return integrate(spark, A.food(spark, d), A.food_nutrient(spark, d), A.prices(spark, d),
                     A.survey_a(spark, d), A.survey_b(spark, d), scratch_path(spark, "integration"))


def _source_queries():
    try:
        from cosecha.sources import fixtures as fx
    except ImportError:
        return {}
    return {
        "src_csv": fx.q_src_csv,
        "src_zip_csv": fx.q_src_zip_csv,
        "src_xport": fx.q_src_xport,
        "src_zip_xport": fx.q_src_zip_xport,
        "sink_replace": fx.q_sink_replace,
        "list_tables": fx.q_list_tables,
        "copy_all": fx.q_copy_all,
        "ingest_report": fx.q_ingest_report,
    }


def _llm_queries():
    """Queries and oracles of the training-data operators, when present."""
    try:
        import corpus_pipeline
        from cosecha.llm import queries as lq
    except ImportError:
        return {}, {}
    return ({**lq.QUERIES, "pipeline": corpus_pipeline.run},
            {**lq.ORACLE, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})})


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    qs = {
        "select_cols": q_select_cols,
        "select_existing": q_select_existing,
        "filter_in": q_filter_in,
        "filter_not_null": q_filter_not_null,
        "filter_compare": q_filter_compare,
        "filter_contains": q_filter_contains,
        "distinct_values": q_distinct_values,
        "scan_table": q_scan_table,
        "scan_sql": q_scan_sql,
        "join_inner": q_join_inner,
        "join_left": q_join_left,
        "nutrient_pivot": q_nutrient_pivot,
        "derived_nutrients": q_derived_nutrients,
        "classify_food": q_classify_food,
        "price_agg": q_price_agg,
        "volatility": q_volatility,
        "normalize_text": q_normalize_text,
        "quantile_edges": q_quantile_edges,
        "quartile_bin": q_quartile_bin,
        "quintile_bin": q_quintile_bin,
        "nutrient_gap_by_income": q_nutrient_gap_by_income,
        "prevalence_age": q_prevalence_age,
        "prevalence_bmi": q_prevalence_bmi,
        "prevalence_lifestyle": q_prevalence_lifestyle,
        "prevalence_fiber": q_prevalence_fiber,
        "prevalence_sugar": q_prevalence_sugar,
        "prevalence_union": q_prevalence_union,
        "state_profile": q_state_profile,
        "top_k_states": q_top_k_states,
        "top_k_groups": q_top_k_groups,
        "value_counts": q_value_counts,
        "share_case": q_share_case,
        "avg_by_class": q_avg_by_class,
        "combined_index": q_combined_index,
        "price_by_class": q_price_by_class,
        "pearson_corr": q_pearson_corr,
        "ols_fit": q_ols_fit,
        "whatif_predict": q_whatif_predict,
        "whatif_delta": q_whatif_delta,
        "quality_index": q_quality_index,
        "welch_ttest": q_welch_ttest,
        "welch_pvalue": q_welch_pvalue,
        "box_stats": q_box_stats,
        "density_by_class": q_density_by_class,
        "fuzzy_best_match": q_fuzzy_best_match,
        "fuzzy_lev": q_fuzzy_lev,
        "match_quality": q_match_quality,
        "recode_map": q_recode_map,
        "recode_replace": q_recode_replace,
        "survey_summary": q_survey_summary,
        "completeness": q_completeness,
        "table_inventory": q_table_inventory,
        "flow_food_integrated": q_flow_food_integrated,
        "flow_price_products": q_flow_price_products,
        "flow_price_food": q_flow_price_food,
        "flow_final_analysis": q_flow_final_analysis,
        "flow_integration": q_flow_integration,
    }
    qs.update(_source_queries())
    qs.update(_llm_queries()[0])

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(_prep(spark), sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        return run

    return {k: wrap(v) for k, v in qs.items()}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: diabetes prevalence by age group, both surveys stacked."""
    return queries()["prevalence_union"](spark, SF0001)


def oracle_sql() -> dict[str, str]:
    from cosecha.oracle import ORACLE
    return {**ORACLE, **_llm_queries()[1]}
