"""The integration run writes the same tables the flow queries compute."""

import tempfile

import __spark_entry__ as E
from cosecha import adapters as A
from cosecha.plans.integration import INTEGRATED_TABLES, integrate
from cosecha.sources.tables import scan_table


def _rows(df):
    return sorted(tuple("<NULL>" if v is None else repr(round(v, 9) if isinstance(v, float) else v)
                        for v in r) for r in df.select(sorted(df.columns)).collect())


def test_integration_writes_every_table(spark, sf0001):
    store = tempfile.mkdtemp(prefix="integration-")
    rep = integrate(spark, A.food(spark, sf0001), A.food_nutrient(spark, sf0001), A.prices(spark, sf0001),
                    A.survey_a(spark, sf0001), A.survey_b(spark, sf0001), store)
    got = {r.table_name: r.status for r in rep.collect()}
    assert got == {t: "ok" for t in INTEGRATED_TABLES}
    qs = E.queries()
    assert _rows(scan_table(spark, store, "FDC_NUTRIENTES_INTEGRADO")) == _rows(qs["flow_food_integrated"](spark, sf0001))
    assert _rows(scan_table(spark, store, "DATOS_ANALISIS_FINAL")) == _rows(qs["flow_final_analysis"](spark, sf0001))
    edad = scan_table(spark, store, "COMPARACION_DIABETES_EDAD")
    assert edad.count() == qs["prevalence_union"](spark, sf0001).count()


def test_stored_tables_are_not_copied_for_the_match(spark, sf0001, monkeypatch):
    from cosecha.plans import prices as pr
    from cosecha.session import materialize
    copies = []
    monkeypatch.setattr(pr, "materialize", lambda df, name="table": copies.append(name) or materialize(df, name))
    store = tempfile.mkdtemp(prefix="integration-")
    integrate(spark, A.food(spark, sf0001), A.food_nutrient(spark, sf0001), A.prices(spark, sf0001),
              A.survey_a(spark, sf0001), A.survey_b(spark, sf0001), store)
    assert "foods" not in copies and "products" not in copies
    assert _rows(scan_table(spark, store, "ODEPA_FDC_INTEGRADO").drop("match_score")) == _rows(
        pr.price_food(scan_table(spark, store, "ODEPA_AGREGADO"), scan_table(spark, store, "FDC_NUTRIENTES_INTEGRADO"))
        .drop("match_score"))
