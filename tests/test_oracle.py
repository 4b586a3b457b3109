"""Every registered query with an oracle statement equals DuckDB on sf0.001
(row count, columns, order-insensitive values); the rest run and return rows."""

import datetime as dt
import math

import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

SQLS = E.oracle_sql()
QUERIES = E.queries()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "toArray"):
        return repr(list(v.toArray()))
    return repr(v)


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(SQLS))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(SQLS[name])
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in ocols)
    assert len(srows) == len(orows)
    assert _bag(df.columns, srows) == _bag(ocols, orows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQLS)))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF_SMALL).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_revenue" in df.columns
