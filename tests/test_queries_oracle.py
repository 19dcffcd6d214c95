"""Every registered key against its DuckDB oracle on the small tables (sf0.001)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

from core_helpers import SF_SMALL

import __spark_entry__ as E
from eventmill.plans import registry
from eventmill.sources.tables import TABLES, table_path


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: [(x is None, str(x)) for x in t])


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return c


ORACLE = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_key_matches_oracle(spark, con, name):
    df = registry.queries()[name](spark, SF_SMALL)
    s_rows = [tuple(r) for r in df.collect()]
    r = con.execute(ORACLE[name])
    d_cols = [x[0] for x in r.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, s_rows) == _rows(d_cols, r.fetchall())


def test_every_key_has_a_query_and_entry_runs(spark):
    q = E.queries()
    assert set(registry.queries()) <= set(q)
    assert len(q) >= 80
    assert set(ORACLE) <= set(q)
    out = E.entry(spark)
    assert out.count() > 0
