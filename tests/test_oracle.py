"""Every registered query against its DuckDB oracle at sf0.01."""

import datetime
import math

import pytest

import __spark_entry__ as E
from livetables.plans.catalog import QUERIES
from tests.conftest import SF001, SF01

NAMES = sorted(QUERIES)
ORACLES = {k: v for k, v in E.oracle_sql().items() if k in QUERIES}


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    key = sorted(cols)
    return sorted((tuple(_norm(r[c]) for c in key) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF01)
    got = [r.asDict() for r in df.collect()]
    res = duck.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    want = [dict(zip(cols, r)) for r in res.fetchall()]
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, got) == _rows(cols, want)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_at_smallest_scale(spark, duck_small, name):
    df = E.queries()[name](spark, SF001)
    got = [r.asDict() for r in df.collect()]
    res = duck_small.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    want = [dict(zip(cols, r)) for r in res.fetchall()]
    assert _rows(df.columns, got) == _rows(cols, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["sym", "last_bid"]
    assert len(rows) > 0
    again = E.queries()["last_quote_by_symbol"](spark, SF001).collect()
    assert sorted(rows) == sorted(again)
