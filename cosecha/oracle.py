"""DuckDB statements that must return the same rows as the Spark queries of
``__spark_entry__.queries()`` (the correctness oracle).

The adapter views are inlined from the very SQL text the Spark side runs;
the flow tables (pivot, integrated foods, products, matched products) are
re-derived here in plain SQL, independently of the Spark operators.

Fuzzy matches are scored here too, pair by pair: difflib's ratio by a recursive
statement, Levenshtein's by DuckDB's function."""

from __future__ import annotations

from cosecha.adapters import BASE_TABLES, duckdb_view
from cosecha.plans import analysis as an
from cosecha.plans import food as fd
from cosecha.plans import prices as pr


def _q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def _with(*ctes: tuple[str, str], body: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{sql.strip()}\n)" for n, sql in ctes) + "\n" + body.strip()


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def V(name: str) -> tuple[str, str]:
    return name, duckdb_view(name)


def NORM(x: str) -> str:
    return (r"regexp_replace(regexp_replace(regexp_replace(lower(" + x + r"), '^\s+|\s+$', '', 'g'), "
            r"'[^\p{L}\p{N}_\s]', '', 'g'), '\s+', ' ', 'g')")


def _dlist(values) -> str:
    return "[" + ", ".join(f"CAST('{float(v)!r}' AS DOUBLE)" for v in values) + "]"


def difflib_ratio(left: str, left_col: str, right: str, right_col: str) -> list[tuple[str, str]]:
    """CTEs up to ``ratios`` (a, b, ratio): difflib's ratio of every pair of short
    texts, b as its first sequence. A common run is numbered along its diagonal; a
    range takes its longest run (cut to the range; the earliest end in b, then in
    a) and leaves the ranges before and behind it. (Texts below 200 characters:
    difflib leaves frequent ones out of longer texts.)"""
    return [
        ("cells", f"""
SELECT a, b, i, j, row_number() OVER (PARTITION BY a, b, i - j, i - nth ORDER BY i) AS run FROM (
  SELECT a, b, i, j, row_number() OVER (PARTITION BY a, b, i - j ORDER BY i) AS nth FROM (
    SELECT DISTINCT {left_col} AS a, {right_col} AS b FROM {left}, {right}),
    LATERAL (SELECT unnest(range(1, length(b) + 1)) AS i), LATERAL (SELECT unnest(range(1, length(a) + 1)) AS j)
  WHERE substr(b, i, 1) = substr(a, j, 1))"""),
        ("runs", """
SELECT a, b, list({'run': run, 'i': i, 'j': j}) AS runs FROM cells GROUP BY a, b"""),
        ("blocks", """
SELECT a, b, CAST(0 AS BIGINT) AS i0, CAST(length(b) AS BIGINT) AS i1, CAST(0 AS BIGINT) AS j0, CAST(length(a) AS BIGINT) AS j1,
  CAST(0 AS BIGINT) AS size FROM runs
UNION ALL
SELECT a, b, nxt.i0, nxt.i1, nxt.j0, nxt.j1, nxt.size FROM (
  SELECT a, b, unnest([{'i0': i0, 'i1': e - size, 'j0': j0, 'j1': f - size, 'size': size},
                       {'i0': e, 'i1': i1, 'j0': f, 'j1': j1, 'size': CAST(0 AS BIGINT)}]) AS nxt
  FROM (SELECT a, b, i0, i1, j0, j1, best // 1000000 AS size, 999 - best // 1000 % 1000 AS e, 999 - best % 1000 AS f FROM (
    SELECT t.*, list_max(list_transform(
        list_filter(r.runs, lambda c: c.i > i0 AND c.i <= i1 AND c.j > j0 AND c.j <= j1),
        lambda c: least(c.run, c.i - i0, c.j - j0) * 1000000 + (999 - c.i) * 1000 + 999 - c.j)) AS best
    FROM blocks t JOIN runs r USING (a, b) WHERE i1 > i0 AND j1 > j0) WHERE best IS NOT NULL))"""),
        ("ratios", """
SELECT a, b, 2.0 * sum(size) / (length(a) + length(b)) AS ratio FROM blocks GROUP BY a, b"""),
    ]


# --------------------------------------------------------------- flow CTEs

_ids = sorted(fd.KEY_NUTRIENTS)
PIVOT = ("piv", "SELECT fdc_id,\n" + ",\n".join(
    f"  arg_min(amount, (ord1, ord2)) FILTER (WHERE nutrient_id = {i}) AS {fd.KEY_NUTRIENTS[i]}" for i in _ids)
    + "\nFROM food_nutrient WHERE amount IS NOT NULL AND nutrient_id IN ("
    + ", ".join(map(str, _ids)) + ")\nGROUP BY fdc_id")

DERIVED_COLS = """
  Carbohidratos - coalesce(Fibra, 0) AS Carb_Netos,
  (Carbohidratos - coalesce(Fibra, 0)) / nullif(coalesce(Fibra, CAST(0.1 AS DOUBLE)) + 1, 0) AS Indice_Glicemico_Est,
  coalesce(Acidos_Grasos_Monoinsaturados, 0) + coalesce(Acidos_Grasos_Poliinsaturados, 0) AS Grasas_Saludables,
  (coalesce(Acidos_Grasos_Monoinsaturados, 0) + coalesce(Acidos_Grasos_Poliinsaturados, 0))
     / nullif(coalesce(Acidos_Grasos_Saturados, CAST(0.1 AS DOUBLE)) + 1, 0) AS Ratio_Grasas_Saludables,
  coalesce(Fibra, 0) / nullif(Energia, 0) * 100 AS Densidad_Fibra
"""
CLASS_CASE = ("CASE " + " ".join(f"WHEN {c} > {t} THEN {_q(lbl)}" for c, t, lbl in fd.CLASS_RULES)
              + f" ELSE {_q(fd.CLASS_DEFAULT)} END")

DERIVED = ("derived", f"SELECT *, {DERIVED_COLS} FROM piv")
CLASSIFIED = ("classified", f"SELECT *, {CLASS_CASE} AS clasificacion_salud FROM derived")
FOOD_INTEGRATED = ("food_integrated", f"""
SELECT *, {CLASS_CASE} AS clasificacion_salud FROM (
  SELECT *, {DERIVED_COLS} FROM (
    SELECT f.fdc_id, f.description, f.food_category_id, p.* EXCLUDE (fdc_id)
    FROM food f JOIN piv p ON f.fdc_id = p.fdc_id))
""")

PRICE_STATS = ("price_stats", """
SELECT producto AS Producto, avg(precio) AS Precio_Promedio_CLP, min(precio) AS Precio_Min_CLP,
       max(precio) AS Precio_Max_CLP, stddev_samp(precio) AS Precio_Std_CLP, count(precio) AS N_Observaciones,
       arg_min(grupo, (ord1, ord2, ord3, ord4)) FILTER (WHERE grupo IS NOT NULL) AS Grupo,
       arg_min(unidad, (ord1, ord2, ord3, ord4)) FILTER (WHERE unidad IS NOT NULL) AS Unidad
FROM prices WHERE producto IS NOT NULL GROUP BY producto
""")


def _bin_expr(v: str, e: str = "e") -> str:
    return (f"CASE WHEN {v} IS NULL OR len({e}) < 2 THEN NULL "
            f"WHEN {v} < {e}[1] OR {v} > {e}[len({e})] THEN NULL "
            f"ELSE CAST(1 + len(list_filter({e}[2:len({e})-1], lambda x: x < {v})) AS INTEGER) END")


def _label_expr(b: str, labels, e: str = "e") -> str:
    gen = f"'Q' || CAST({b} AS VARCHAR)"
    if not labels:
        return f"CASE WHEN {b} IS NULL THEN NULL ELSE {gen} END"
    arr = "[" + ", ".join(_q(x) for x in labels) + "]"
    return (f"CASE WHEN {b} IS NULL THEN NULL WHEN len({e}) - 1 = {len(labels)} THEN {arr}[{b}] "
            f"ELSE {gen} END")


def _edges(src: str, v: str, q: int) -> str:
    from cosecha.operators.quantile import linspace_fractions
    return (f"SELECT list_sort(list_distinct(quantile_cont({v}, {_dlist(linspace_fractions(q))}))) AS e "
            f"FROM {src} WHERE {v} IS NOT NULL")


PRICE_EDGES = ("price_edges", _edges("price_stats", "Precio_Promedio_CLP", pr.PRICE_QUANTILES))
PRODUCTS = ("products", f"""
SELECT * EXCLUDE (e, b), {_label_expr('b', pr.PRICE_LABELS)} AS categoria_precio,
       Precio_Std_CLP / nullif(Precio_Promedio_CLP, 0) * 100 AS volatilidad_precio
FROM (SELECT s.*, {NORM('Producto')} AS producto_normalizado, e,
             {_bin_expr('Precio_Promedio_CLP')} AS b
      FROM price_stats s, price_edges)
""")
FI_DESC = ("fi_desc", """
SELECT lower(description) AS d, min(fdc_id) AS fdc_id FROM food_integrated
WHERE description IS NOT NULL GROUP BY lower(description)
""")
MATCHES = [*difflib_ratio("products", "producto_normalizado", "fi_desc", "d"), ("matches", f"""
SELECT p.Producto AS producto_odepa, p.producto_normalizado AS producto_odepa_norm, m.fdc_id,
       m.d AS fdc_description, ratio * 100.0 AS match_score,
       p.Precio_Promedio_CLP AS precio_promedio_clp, p.Grupo AS grupo_odepa, p.categoria_precio
FROM products p JOIN (
  SELECT * FROM ratios WHERE ratio >= {pr.MATCH_CUTOFF}
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY ratio DESC, b DESC) = 1) ON p.producto_normalizado = a
JOIN fi_desc m ON b = m.d
""")]
MATCHED = ("matched", """
SELECT c.*, f.* EXCLUDE (fdc_id) FROM matches c LEFT JOIN food_integrated f ON c.fdc_id = f.fdc_id
""")
INTEGRATED = ("integrated", """
SELECT p.producto AS producto_odepa, p.precio AS precio_promedio_clp, p.grupo AS grupo_odepa, f.*
FROM prices p JOIN food_integrated f ON p.ord4 = f.fdc_id
""")

FOOD_CHAIN = [V("food"), V("food_nutrient"), PIVOT, FOOD_INTEGRATED]
PRICE_CHAIN = [V("prices"), PRICE_STATS, PRICE_EDGES, PRODUCTS]
MATCHED_CHAIN = FOOD_CHAIN + PRICE_CHAIN + [FI_DESC, *MATCHES, MATCHED]
INTEGRATED_CHAIN = FOOD_CHAIN + [V("prices"), INTEGRATED]


def _prev(src: str, group: str, alias: str | None = None, digits: int = 9) -> str:
    a = alias or group
    return (f"SELECT {group} AS {a}, count(tiene_diabetes) AS total, "
            f"CAST(coalesce(sum(tiene_diabetes), 0) AS BIGINT) AS con_diabetes, "
            f"round(CASE WHEN count(tiene_diabetes) > 0 THEN CAST(coalesce(sum(tiene_diabetes), 0) AS BIGINT) "
            f"/ count(tiene_diabetes) * 100 ELSE CAST(0.0 AS DOUBLE) END, {digits}) AS prevalencia_pct "
            f"FROM {src} WHERE {group} IS NOT NULL GROUP BY {group}")


TWO_CLASS_CASE = ("CASE clasificacion_salud " + " ".join(
    f"WHEN {_q(k)} THEN {_q(v)}" for k, v in an.TWO_CLASS.items()) + " ELSE clasificacion_salud END")
TWO_CLASS_U_CASE = ("CASE replace(regexp_replace(clasificacion_salud, '^\\s+|\\s+$', '', 'g'), ' ', '_') "
                    + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in an.TWO_CLASS_U.items())
                    + " ELSE replace(regexp_replace(clasificacion_salud, '^\\s+|\\s+$', '', 'g'), ' ', '_') END")

QUALITY = ("qi", """
SELECT precio_promedio_clp, Fibra, Colesterol_Dietetico, Grasas_Saludables, grupo_odepa,
       coalesce(Fibra, 0) + coalesce(Grasas_Saludables, 0) - coalesce(Colesterol_Dietetico, 0) / 10 AS indice_calidad
FROM integrated WHERE precio_promedio_clp > 0 AND Fibra IS NOT NULL
""")
MODEL = ("model", """
SELECT regr_slope(indice_calidad, precio_promedio_clp) AS slope,
       regr_intercept(indice_calidad, precio_promedio_clp) AS intercept
FROM qi WHERE indice_calidad IS NOT NULL AND precio_promedio_clp IS NOT NULL
""")
WHATIF = ("whatif", """
SELECT precio_promedio_clp, indice_calidad, grupo_odepa, precio_promedio_clp * CAST(1.2 AS DOUBLE) AS precio_simulado,
       intercept + slope * (precio_promedio_clp * CAST(1.2 AS DOUBLE)) AS calidad_esperada
FROM qi, model
""")
TWO_U = ("tu", f"""
SELECT {TWO_CLASS_U_CASE} AS clasificacion_salud, precio_promedio_clp
FROM integrated WHERE clasificacion_salud IS NOT NULL AND precio_promedio_clp > 0
""")

FUZZY_L = ("fl", f"SELECT DISTINCT {NORM('producto')} AS producto_normalizado FROM fuzzy_products "
                 "WHERE producto IS NOT NULL")
FUZZY_R = ("fr", "SELECT lower(description) AS descripcion, min(fdc_id) AS fdc_id FROM food "
                 "WHERE description IS NOT NULL GROUP BY lower(description)")
FUZZY_LEV = ("lev", f"""
SELECT producto_normalizado, match_text, fdc_id, sc * 100.0 AS match_score FROM (
  SELECT *, row_number() OVER (PARTITION BY producto_normalizado ORDER BY sc DESC, match_text DESC) AS rn
  FROM (SELECT fl.producto_normalizado, fr.descripcion AS match_text, fr.fdc_id,
               1.0 - levenshtein(fl.producto_normalizado, fr.descripcion)
                     / greatest(length(fl.producto_normalizado), length(fr.descripcion)) AS sc
        FROM fl, fr)
  WHERE sc >= {pr.MATCH_CUTOFF})
WHERE rn = 1
""")

FUZZY_DIF = [*difflib_ratio("fl", "producto_normalizado", "fr", "descripcion"), ("dif", f"""
SELECT a AS producto_normalizado, b AS match_text, fr.fdc_id, ratio * 100.0 AS match_score
FROM ratios JOIN fr ON b = fr.descripcion WHERE ratio >= {pr.MATCH_CUTOFF}
QUALIFY row_number() OVER (PARTITION BY a ORDER BY ratio DESC, b DESC) = 1
""")]

FINAL_COLS = ["seqn", "ridageyr", "indfmpir", "bmxbmi", "categoria_imc", "tiene_diabetes",
              "categoria_azucar", "categoria_fibra", "edad_grupo_brfss", "riagendr", "lbxgh", "colesterol_alto",
              "sindrome_metabolico", "promedio_tkcal", "promedio_tfibe", "promedio_tchol", "promedio_tsugr", "grupo_edad"]

_p = ", ".join
_q5 = _dlist([0.25, 0.5, 0.75])

ORACLE: dict[str, str] = {
    "select_cols": _with(V("food"), body="SELECT fdc_id, description, food_category_id FROM food"),
    "select_existing": _with(V("survey_a"), body=f"SELECT {_p(FINAL_COLS)} FROM survey_a"),
    "filter_in": _with(V("food_nutrient"), body="SELECT * FROM food_nutrient WHERE nutrient_id IN "
                       "(1005, 1079, 1008, 1258, 1292, 1293)"),
    "filter_not_null": _with(V("survey_b"), body="SELECT * FROM survey_b WHERE state IS NOT NULL AND "
                             "tiene_diabetes IS NOT NULL AND estilo_vida_saludable IS NOT NULL"),
    "filter_compare": _with(V("survey_b"), body="SELECT * FROM survey_b WHERE tiene_diabetes = 1 AND "
                            "estilo_vida_saludable = 0"),
    "filter_contains": _with(V("food"), body="SELECT * FROM food WHERE contains(lower(description), 'ring')"),
    "distinct_values": _with(V("survey_b"), body="SELECT DISTINCT categoria_imc FROM survey_b"),
    "scan_table": _with(V("prices"), body="SELECT * FROM prices"),
    "scan_sql": _with(V("prices"), body="SELECT grupo, round(AVG(precio), 6) AS precio_prom, COUNT(*) AS n "
                      "FROM prices WHERE precio > 1000 GROUP BY grupo"),
    "join_inner": _with(V("food"), V("food_nutrient"), PIVOT,
                        body="SELECT f.fdc_id, f.description, f.food_category_id, p.* EXCLUDE (fdc_id) "
                             "FROM food f JOIN piv p ON f.fdc_id = p.fdc_id"),
    "join_left": _with(V("food"), V("food_nutrient"), ("fs", """
        SELECT fdc_id,
               arg_min(amount, (ord1, ord2)) FILTER (WHERE nutrient_id = 1079) AS Fibra,
               arg_min(amount, (ord1, ord2)) FILTER (WHERE nutrient_id = 2000) AS Azucares_Totales
        FROM food_nutrient WHERE amount IS NOT NULL AND nutrient_id IN (1079, 2000) GROUP BY fdc_id"""),
                       body="SELECT f.fdc_id, f.description, f.food_category_id, p.Fibra, p.Azucares_Totales "
                            "FROM food f LEFT JOIN fs p ON f.fdc_id = p.fdc_id"),
    "nutrient_pivot": _with(V("food_nutrient"), PIVOT, body="SELECT * FROM piv"),
    "derived_nutrients": _with(V("food_nutrient"), PIVOT, DERIVED, body="SELECT * FROM derived"),
    "classify_food": _with(V("food_nutrient"), PIVOT, DERIVED, CLASSIFIED,
                           body="SELECT fdc_id, clasificacion_salud FROM classified"),
    "price_agg": _with(V("prices"), PRICE_STATS, body="""
        SELECT Producto, round(Precio_Promedio_CLP, 6) AS Precio_Promedio_CLP, round(Precio_Min_CLP, 6) AS Precio_Min_CLP,
               round(Precio_Max_CLP, 6) AS Precio_Max_CLP, round(Precio_Std_CLP, 6) AS Precio_Std_CLP,
               N_Observaciones, Grupo, Unidad FROM price_stats"""),
    "volatility": _with(V("prices"), PRICE_STATS, body="SELECT Producto, round(Precio_Std_CLP / "
                        "nullif(Precio_Promedio_CLP, 0) * 100, 6) AS volatilidad_precio FROM price_stats"),
    "normalize_text": _with(V("prices"), body=f"SELECT producto, grupo, {NORM('producto')} AS producto_normalizado, "
                            f"{NORM('grupo')} AS grupo_normalizado FROM (SELECT DISTINCT producto, grupo FROM prices)"),
    "quantile_edges": _with(V("prices"), PRICE_STATS, PRICE_EDGES, body="""
        SELECT CAST(edge_no AS INTEGER) AS edge_no, round(e[edge_no], 6) AS edge
        FROM price_edges, range(1, len(e) + 1) t(edge_no)"""),
    "quartile_bin": _with(V("prices"), PRICE_STATS, PRICE_EDGES, body=f"""
        SELECT Producto, {_label_expr('bin_no', pr.PRICE_LABELS)} AS categoria_precio, bin_no
        FROM (SELECT Producto, e, {_bin_expr('Precio_Promedio_CLP')} AS bin_no FROM price_stats, price_edges)"""),
    "quintile_bin": _with(V("survey_a"), ("inc", "SELECT * FROM survey_a WHERE indfmpir IS NOT NULL"),
                          ("ie", _edges("inc", "indfmpir", an.INCOME_QUANTILES)), body=f"""
        SELECT seqn, {_label_expr('bin_no', None)} AS quintil_ingreso, bin_no
        FROM (SELECT seqn, e, {_bin_expr('indfmpir')} AS bin_no FROM inc, ie)"""),
    "nutrient_gap_by_income": _with(
        V("survey_a"),
        ("inc", "SELECT * FROM survey_a WHERE indfmpir IS NOT NULL AND promedio_tfibe IS NOT NULL "
                "AND promedio_tchol IS NOT NULL"),
        ("ie", _edges("inc", "indfmpir", an.INCOME_QUANTILES)),
        ("binned", f"SELECT promedio_tfibe, promedio_tchol, {_bin_expr('indfmpir')} AS bin_no FROM inc, ie"),
        ("bins", "SELECT CAST(b AS INTEGER) AS bin_no FROM ie, range(1, len(e)) t(b) WHERE len(e) >= 2"),
        body="""
        SELECT 'Q' || CAST(bins.bin_no AS VARCHAR) AS quintil_ingreso,
               round_even(avg(promedio_tfibe), 2) AS promedio_tfibe,
               round_even(avg(promedio_tchol), 2) AS promedio_tchol
        FROM bins LEFT JOIN binned ON bins.bin_no = binned.bin_no GROUP BY bins.bin_no"""),
    "prevalence_age": _with(V("survey_a"), body=f"SELECT *, 'NHANES' AS fuente FROM ({_prev('survey_a', 'edad_grupo_brfss')})"),
    "prevalence_union": _with(V("survey_a"), V("survey_b"), body=f"""
        SELECT CAST(edad_grupo_brfss AS VARCHAR) AS edad_grupo_brfss, total, con_diabetes, prevalencia_pct, 'NHANES' AS fuente
        FROM ({_prev('survey_a', 'edad_grupo_brfss')})
        UNION ALL
        SELECT CAST(edad_grupo_brfss AS VARCHAR), total, con_diabetes, prevalencia_pct, 'BRFSS'
        FROM ({_prev('survey_b', 'age_g', 'edad_grupo_brfss')})"""),
    "prevalence_bmi": _with(V("survey_a"), V("survey_b"), body=f"""
        SELECT *, 'NHANES' AS fuente FROM ({_prev('survey_a', 'categoria_imc')})
        UNION ALL SELECT *, 'BRFSS' FROM ({_prev('survey_b', 'categoria_imc')})"""),
    "prevalence_lifestyle": _with(V("survey_b"), body=f"""
        SELECT CASE estilo_vida_saludable WHEN 0 THEN 'No Saludable' WHEN 1 THEN 'Saludable' END AS estilo_vida_saludable,
               total, con_diabetes, prevalencia_pct FROM ({_prev('survey_b', 'estilo_vida_saludable')})"""),
    "prevalence_fiber": _with(V("survey_a"), body=_prev("survey_a", "categoria_fibra")),
    "prevalence_sugar": _with(V("survey_a"), body=_prev("survey_a", "categoria_azucar")),
    "state_profile": _with(V("survey_b"), body="""
        SELECT state, count(tiene_diabetes) AS total, CAST(coalesce(sum(tiene_diabetes), 0) AS BIGINT) AS con_diabetes,
               count(*) FILTER (WHERE estilo_vida_saludable = 0) AS no_saludable,
               count(*) FILTER (WHERE tiene_diabetes = 1 AND estilo_vida_saludable = 0) AS ambos,
               round_even(CAST(coalesce(sum(tiene_diabetes), 0) AS BIGINT) / count(tiene_diabetes) * 100, 2) AS pct_diabetes,
               round_even(count(*) FILTER (WHERE estilo_vida_saludable = 0) / count(tiene_diabetes) * 100, 2) AS pct_no_saludable,
               round_even(count(*) FILTER (WHERE tiene_diabetes = 1 AND estilo_vida_saludable = 0) / count(tiene_diabetes) * 100, 2) AS pct_ambos
        FROM survey_b WHERE state IS NOT NULL AND tiene_diabetes IS NOT NULL AND estilo_vida_saludable IS NOT NULL
        GROUP BY state ORDER BY pct_ambos DESC, state"""),
    "value_counts": _with(*FOOD_CHAIN, body="SELECT clasificacion_salud, count(*) AS count FROM food_integrated "
                          "WHERE clasificacion_salud IS NOT NULL GROUP BY clasificacion_salud"),
    "top_k_groups": _with(V("prices"), PRICE_STATS, body=f"""
        SELECT Grupo, count(*) AS count FROM price_stats WHERE Grupo IS NOT NULL GROUP BY Grupo
        ORDER BY count DESC, Grupo LIMIT {an.TOP_GROUPS}"""),
    "share_case": _with(V("survey_b"), body="SELECT AVG(CASE WHEN medcost1 = 1 THEN 1 ELSE 0 END) AS dificultad_salud FROM survey_b"),
    "avg_by_class": _with(*INTEGRATED_CHAIN, body="""
        SELECT clasificacion_salud, round(AVG(precio_promedio_clp), 6) AS precio_prom FROM integrated
        WHERE precio_promedio_clp > 0 GROUP BY clasificacion_salud"""),
    "combined_index": _with(V("survey_b"), *INTEGRATED_CHAIN, body="""
        SELECT round((SELECT AVG(CASE WHEN medcost1 = 1 THEN 1 ELSE 0 END) FROM survey_b) * avg(precio_prom) / 1000, 9) AS indice
        FROM (SELECT clasificacion_salud, AVG(precio_promedio_clp) AS precio_prom FROM integrated
              WHERE precio_promedio_clp > 0 GROUP BY clasificacion_salud)"""),
    "price_by_class": _with(*INTEGRATED_CHAIN, body="""
        SELECT clasificacion_salud, round_even(avg(precio_promedio_clp), 2) AS precio_mean,
               round_even(quantile_cont(precio_promedio_clp, 0.5), 2) AS precio_median,
               count(precio_promedio_clp) AS precio_count
        FROM integrated WHERE clasificacion_salud IS NOT NULL GROUP BY clasificacion_salud"""),
    "pearson_corr": _with(*INTEGRATED_CHAIN, body="""
        SELECT round(covar_samp(Fibra, precio_promedio_clp) / nullif(stddev_samp(Fibra) * stddev_samp(precio_promedio_clp), 0), 9) AS corr
        FROM integrated WHERE Fibra IS NOT NULL AND precio_promedio_clp > 0"""),
    "quality_index": _with(*INTEGRATED_CHAIN, QUALITY, body="""
        SELECT precio_promedio_clp, Fibra, Colesterol_Dietetico, Grasas_Saludables, grupo_odepa, indice_calidad
        FROM qi"""),
    "ols_fit": _with(*INTEGRATED_CHAIN, QUALITY, body="""
        SELECT round(regr_slope(indice_calidad, precio_promedio_clp), 9) AS slope,
               round(regr_intercept(indice_calidad, precio_promedio_clp), 9) AS intercept,
               round(regr_r2(indice_calidad, precio_promedio_clp), 9) AS r2,
               CAST(regr_count(indice_calidad, precio_promedio_clp) AS BIGINT) AS n
        FROM qi WHERE indice_calidad IS NOT NULL"""),
    "whatif_predict": _with(*INTEGRATED_CHAIN, QUALITY, MODEL, WHATIF, body="""
        SELECT precio_promedio_clp, indice_calidad, precio_simulado, round(calidad_esperada, 6) AS calidad_esperada,
               grupo_odepa
        FROM whatif"""),
    "whatif_delta": _with(*INTEGRATED_CHAIN, QUALITY, MODEL, WHATIF,
                          body="SELECT round(avg(calidad_esperada) - avg(indice_calidad), 6) AS delta FROM whatif"),
    "welch_ttest": _with(*INTEGRATED_CHAIN, ("tc", f"""
        SELECT {TWO_CLASS_CASE} AS c, precio_promedio_clp AS v FROM integrated
        WHERE clasificacion_salud IS NOT NULL AND precio_promedio_clp > 0"""), ("ws", """
        SELECT count(*) FILTER (WHERE c = 'Saludable') AS n_a, count(*) FILTER (WHERE c = 'No saludable') AS n_b,
               avg(v) FILTER (WHERE c = 'Saludable') AS mean_a, avg(v) FILTER (WHERE c = 'No saludable') AS mean_b,
               var_samp(v) FILTER (WHERE c = 'Saludable') AS var_a, var_samp(v) FILTER (WHERE c = 'No saludable') AS var_b
        FROM tc WHERE c IN ('Saludable', 'No saludable') AND v IS NOT NULL"""), body="""
        SELECT n_a, n_b, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b, round(var_a, 3) AS var_a,
               round(var_b, 3) AS var_b,
               round(CASE WHEN n_a > 0 AND n_b > 0 THEN (mean_a - mean_b) / nullif(sqrt(var_a / n_a + var_b / n_b), 0) END, 6) AS t,
               round(CASE WHEN n_a > 0 AND n_b > 0 THEN (var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b)
                     / nullif((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1), 0) END, 6) AS dof
        FROM ws"""),
    "box_stats": _with(*INTEGRATED_CHAIN, TWO_U, ("bq", f"""
        SELECT clasificacion_salud, quantile_cont(precio_promedio_clp, {_q5}) AS q FROM tu
        WHERE precio_promedio_clp IS NOT NULL GROUP BY clasificacion_salud"""), body="""
        SELECT clasificacion_salud, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
               round(q3 - q1, 6) AS iqr, count(*) AS n,
               round(min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
               round(max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
               count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers
        FROM (SELECT tu.clasificacion_salud, tu.precio_promedio_clp AS v, q[1] AS q1, q[2] AS median, q[3] AS q3
              FROM tu JOIN bq ON tu.clasificacion_salud = bq.clasificacion_salud)
        GROUP BY clasificacion_salud, q1, median, q3"""),
    "density_by_class": _with(*INTEGRATED_CHAIN, TWO_U, ("ds", """
        SELECT clasificacion_salud, count(*) AS n, stddev_samp(precio_promedio_clp) * pow(CAST(count(*) AS DOUBLE), -0.2) AS h,
               min(precio_promedio_clp) AS mn, max(precio_promedio_clp) AS mx
        FROM tu GROUP BY clasificacion_salud"""), ("dg", """
        SELECT clasificacion_salud, n, h, mn - 2.0 * h AS lo, (mx + 2.0 * h - (mn - 2.0 * h)) / 99 AS step
        FROM ds WHERE h > 0"""), body="""
        SELECT dg.clasificacion_salud, CAST(i AS INTEGER) AS i, round(lo + i * step, 6) AS x,
               round(sum(exp(-0.5 * ((lo + i * step - v) / h) * ((lo + i * step - v) / h))) / (n * h * sqrt(2 * pi())), 12) AS density
        FROM dg JOIN (SELECT clasificacion_salud, precio_promedio_clp AS v FROM tu) t
             ON dg.clasificacion_salud = t.clasificacion_salud, range(0, 100) r(i)
        GROUP BY dg.clasificacion_salud, i, n, h, lo, step"""),
    "fuzzy_lev": _with(V("fuzzy_products"), V("food"), FUZZY_L, FUZZY_R, FUZZY_LEV, body="""
        SELECT producto_normalizado, match_text, fdc_id, round(match_score, 9) AS match_score FROM lev"""),
    "match_quality": _with(V("fuzzy_products"), V("food"), FUZZY_L, FUZZY_R, FUZZY_LEV, body="""
        SELECT count(*) AS n_matches, round(avg(match_score), 9) AS score_promedio,
               count(*) FILTER (WHERE match_score > 80) AS n_score_alto FROM lev"""),
    "recode_map": _with(V("survey_b"), body="""
        SELECT seqno, CASE estilo_vida_saludable WHEN 0 THEN 'No Saludable' WHEN 1 THEN 'Saludable' END AS estilo_label
        FROM survey_b"""),
    "recode_replace": _with(V("food_nutrient"), PIVOT, DERIVED, CLASSIFIED,
                            body=f"SELECT fdc_id, {TWO_CLASS_CASE} AS clase FROM classified"),
    "survey_summary": _with(V("survey_a"), V("survey_b"), body="""
        SELECT 'NHANES' AS dataset, count(*) AS n_participantes,
               round(sum(tiene_diabetes) / count(tiene_diabetes) * 100, 9) AS prevalencia_diabetes_pct,
               round(avg(bmxbmi), 9) AS imc_promedio, round(avg(ridageyr), 9) AS edad_promedio FROM survey_a
        UNION ALL
        SELECT 'BRFSS', count(*), round(sum(tiene_diabetes) / count(tiene_diabetes) * 100, 9),
               round(avg(imc_real), 9), CAST(NULL AS DOUBLE) FROM survey_b"""),
    "completeness": _with(V("survey_a"), body=" UNION ALL ".join(
        f"SELECT '{c}' AS variable, round(count({c}) / count(*) * 100, 9) AS completitud_pct FROM survey_a"
        for c in ("tiene_diabetes", "colesterol_alto", "bmxbmi", "lbxgh", "promedio_tkcal", "sindrome_metabolico"))),
    "table_inventory": " UNION ALL ".join(
        [f"SELECT '{t}' AS table_name, 'ok' AS status, count(*) AS n_rows FROM {t}"
         for t in BASE_TABLES]
        + ["SELECT 'no_such_table', 'missing', CAST(NULL AS BIGINT)"]),
    "flow_food_integrated": _with(*FOOD_CHAIN, body="SELECT * FROM food_integrated"),
    "flow_price_products": _with(*PRICE_CHAIN, body="""
        SELECT * REPLACE (round(Precio_Promedio_CLP, 6) AS Precio_Promedio_CLP, round(Precio_Std_CLP, 6) AS Precio_Std_CLP,
                          round(volatilidad_precio, 6) AS volatilidad_precio) FROM products"""),
    "flow_price_food": _recursive(_with(*MATCHED_CHAIN, body="""
        SELECT * REPLACE (round(precio_promedio_clp, 6) AS precio_promedio_clp, round(match_score, 6) AS match_score)
        FROM matched""")),
    "flow_final_analysis": _with(V("survey_a"), body=f"SELECT {_p(FINAL_COLS)}, 'NHANES' AS fuente_datos FROM survey_a"),
}

ORACLE["fuzzy_best_match"] = _recursive(_with(V("fuzzy_products"), V("food"), FUZZY_L, FUZZY_R, *FUZZY_DIF,
                                              body="SELECT * FROM dif"))

ORACLE["top_k_states"] = ORACLE["state_profile"] + f" LIMIT {an.TOP_STATES}"

# the two-sided p is one minus the t density's integral over (-|t|, |t|), by Simpson's rule
ORACLE["welch_pvalue"] = _with(*INTEGRATED_CHAIN, TWO_U, ("ws", """
    SELECT count(*) FILTER (WHERE c = 'Saludable') AS n_a, count(*) FILTER (WHERE c = 'No_Saludable') AS n_b,
           avg(v) FILTER (WHERE c = 'Saludable') AS mean_a, avg(v) FILTER (WHERE c = 'No_Saludable') AS mean_b,
           var_samp(v) FILTER (WHERE c = 'Saludable') AS var_a, var_samp(v) FILTER (WHERE c = 'No_Saludable') AS var_b
    FROM (SELECT clasificacion_salud AS c, precio_promedio_clp AS v FROM tu)"""), ("wt", """
    SELECT *, (mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b) AS t,
           (var_a / n_a + var_b / n_b) * (var_a / n_a + var_b / n_b)
             / ((var_a / n_a) * (var_a / n_a) / (n_a - 1) + (var_b / n_b) * (var_b / n_b) / (n_b - 1)) AS dof
    FROM ws WHERE n_a > 2 AND n_b > 2"""), ("wp", """
    SELECT 1 - 2 * sum(CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                       * pow(1 + (abs(t) * i / 20000) * (abs(t) * i / 20000) / dof, -(dof + 1) / 2))
               * any_value(exp(lgamma((dof + 1) / 2) - lgamma(dof / 2)) / sqrt(dof * pi()) * abs(t) / 60000) AS p
    FROM wt, range(0, 20001) r(i)"""), body="""
    SELECT n_a, n_b, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b, round(var_a, 3) AS var_a,
           round(var_b, 3) AS var_b, round(t, 6) AS t, round(dof, 6) AS dof, abs(round(p, 6)) AS p FROM wt, wp""")

ORACLE["flow_integration"] = _recursive(_with(V("survey_a"), V("survey_b"), *MATCHED_CHAIN, body="""
    SELECT 'FDC_NUTRIENTES_INTEGRADO' AS table_name, 'ok' AS status, count(*) AS n_rows FROM food_integrated
    UNION ALL SELECT 'ODEPA_AGREGADO', 'ok', count(*) FROM products
    UNION ALL SELECT 'ODEPA_FDC_INTEGRADO', 'ok', count(*) FROM matched
    UNION ALL SELECT 'COMPARACION_DIABETES_EDAD', 'ok',
        (SELECT count(DISTINCT edad_grupo_brfss) FROM survey_a) + (SELECT count(DISTINCT age_g) FROM survey_b)
    UNION ALL SELECT 'COMPARACION_DIABETES_IMC', 'ok',
        (SELECT count(DISTINCT categoria_imc) FROM survey_a) + (SELECT count(DISTINCT categoria_imc) FROM survey_b)
    UNION ALL SELECT 'NHANES_DIABETES_FIBRA', 'ok', count(DISTINCT categoria_fibra) FROM survey_a
    UNION ALL SELECT 'NHANES_DIABETES_AZUCAR', 'ok', count(DISTINCT categoria_azucar) FROM survey_a
    UNION ALL SELECT 'RESUMEN_COMPARATIVO_NHANES_BRFSS', 'ok', CAST(2 AS BIGINT)
    UNION ALL SELECT 'DATOS_ANALISIS_FINAL', 'ok', count(*) FROM survey_a"""))


def _sources():
    from cosecha.sources.fixtures import ORACLE_SOURCES
    return ORACLE_SOURCES


try:
    ORACLE.update(_sources())
except ImportError:  # sources not built yet
    pass
