"""The p-value of Student's t as a Spark expression."""

import math

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from cosecha.operators.stats import t_pvalue, t_two_sided_p


def test_expression_equals_the_function(spark):
    cases = [(t, d) for t in (0.0, 1e-9, 0.3, -1.0, 2.5, -7.0, 40.0, 1e4, math.inf)
             for d in (0.3, 1.0, 2.0, 3.7, 30.0, 1234.5, 4e5, 1e7)]
    df = spark.createDataFrame(cases, "t double, dof double").withColumn("p", t_pvalue(F.col("t"), F.col("dof")))
    for r in df.collect():
        # the function takes differences of large logarithms of Gamma at many degrees of freedom
        assert r.p == pytest.approx(t_two_sided_p(r.t, r.dof), rel=1e-12 if r.dof < 50 else 1e-14 * r.dof,
                                    abs=1e-12 if r.t != 1e-9 else 1e-9), r
    for r in df.where("dof = 1e7 and abs(t) < 10").collect():  # the normal tail and its first correction
        t = abs(r.t)
        tail = math.erfc(t / math.sqrt(2)) + math.exp(-t * t / 2) / math.sqrt(2 * math.pi) * (t ** 3 + t) / (2 * r.dof)
        assert r.p == pytest.approx(tail, rel=1e-9)
    none = spark.createDataFrame([(None, 1.0), (1.0, None), (1.0, 0.0), (math.nan, 2.0), (1.0, math.inf)], "t double, dof double")
    assert none.where(t_pvalue(F.col("t"), F.col("dof")).isNotNull()).count() == 0


def test_no_python_in_the_plan(spark, sf0001):
    plan = E.queries()["welch_pvalue"](spark, sf0001)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
