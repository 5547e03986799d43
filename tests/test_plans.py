"""Every registered plan of the engine itself against its oracle, on the smallest tables."""

import datetime
import decimal
import math
from pathlib import Path

import duckdb
import pytest

from caravel.plans import procedural, relational

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v.isoformat() if isinstance(v, (datetime.date, datetime.datetime)) else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in relational.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


ALL = {**relational.queries(), **procedural.QUERIES}
ORACLE = {**relational.oracle(), **procedural.ORACLE}


@pytest.mark.parametrize("name", sorted(ALL))
def test_plan(spark, con, name):
    df = ALL[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(value(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name not in ORACLE:
        assert got
        return
    r = con.execute(ORACLE[name])
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    assert got == sorted((tuple(value(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)
