"""Driver contract and the oracle comparison at sf0.001 (every query against its DuckDB SQL)."""

import datetime as dt
import math
import os
from collections import Counter

import pytest

import __spark_entry__ as E
from tests.conftest import SF001

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year", "ticker", "avg_close", "avg_volatility"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 45
    own = {n for n in qs if not (n.startswith("op") or n == "pipeline")}
    assert own == own & set(sqls)


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF001)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(list(rel.columns), rel.fetchall())


def test_lag_regression_rows(spark):
    df = E.queries()["lag_regression"](spark, SF001)
    assert df.columns == ["ticker", "date", "label", "predicted"]
    assert df.count() > 0
