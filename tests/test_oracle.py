"""Every query with an oracle returns the DuckDB oracle's rows (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from cosecha.adapters import BASE_TABLES

SLOW = {"src_csv", "src_zip_csv", "src_xport", "src_zip_xport", "ingest_report", "copy_all"}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "<NULL>"
    if isinstance(v, float):
        return repr(round(v, 9))
    return repr(v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con(sf0001):
    c = duckdb.connect()
    for t in BASE_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf0001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, sf0001, con, key):
    df = E.queries()[key](spark, sf0001)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[key])
    exp = _rows([d[0] for d in res.description], res.fetchall())
    assert got == exp


def test_every_query_has_callable_and_entry_runs(spark):
    assert set(E.oracle_sql()) <= set(E.queries())
    out = E.entry(spark)
    assert out.count() > 0 and out.columns == ["edad_grupo_brfss", "total", "con_diabetes", "prevalencia_pct",
                                               "fuente"]
