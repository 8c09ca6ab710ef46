"""Plan shape: what the physical plans must (not) contain."""

import pytest

import __spark_entry__ as E


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def qs():
    return E.queries()


def test_no_cartesian_or_nested_loop_joins(spark, sf0001, qs):
    for k in ["fuzzy_best_match", "fuzzy_lev", "quartile_bin", "combined_index", "whatif_predict",
              "box_stats", "density_by_class", "nutrient_gap_by_income"]:
        p = plan(qs[k](spark, sf0001))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, k


def test_python_only_in_fuzzy_scorer(spark, sf0001, qs):
    for k in ["flow_food_integrated", "flow_price_products", "quartile_bin", "state_profile", "fuzzy_lev",
              "box_stats", "welch_ttest"]:
        p = plan(qs[k](spark, sf0001))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p, k
    assert "ArrowEvalPython" in plan(qs["fuzzy_best_match"](spark, sf0001))


def test_pivot_has_one_exchange_and_partial_aggregation(spark, sf0001, qs):
    p = plan(qs["nutrient_pivot"](spark, sf0001))
    assert "pivotfirst" not in p.lower()
    assert p.count("Exchange hashpartitioning") == 1
    assert "partial_min_by" in p


def test_single_column_order_pivot_is_hash_aggregated(spark):
    from cosecha.operators.aggregate import pivot_first
    df = spark.createDataFrame([(1, 10, 1.0, 3)], "i long, c int, v double, o long")
    p = plan(pivot_first(df, "i", "c", "v", [10], {10: "a"}, ["o"]))
    assert "SortAggregate" not in p and "HashAggregate" in p


def _scan_lines(df):
    txt = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return txt


def test_scan_sql_pushes_projection_and_filters(spark, sf0001, qs):
    txt = _scan_lines(qs["scan_sql"](spark, sf0001))
    # only the columns the view needs are read, and the inferred predicates reach the scan
    assert "l_shipdate" not in txt and "l_returnflag" not in txt and "p_retailprice" not in txt
    pushed = [ln for ln in txt.splitlines() if ln.startswith("PushedFilters")]
    assert any("IsNotNull(l_partkey)" in ln for ln in pushed)
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in txt
    fi = _scan_lines(qs["filter_in"](spark, sf0001))
    assert "l_shipdate" not in fi and "l_discount" not in fi


def test_filter_not_null_pushed_to_scan(spark, sf0001, qs):
    p = plan(qs["filter_compare"](spark, sf0001))
    assert "PushedFilters" in p
