import duckdb
import pytest

from corpusloom.plans.oracle import SQL
from corpusloom.plans.queries import QUERIES


def _norm(v):
    import math

    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.fixture(scope="module")
def con(small):
    import glob
    import os

    c = duckdb.connect()
    for f in glob.glob(small + "/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, small, con, name):
    df = QUERIES[name](spark, small)
    cur = con.execute(SQL[name])
    have = [d[0] for d in cur.description]
    cols = sorted(df.columns)
    assert sorted(have) == cols
    at = [have.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in at) for r in cur.fetchall()), key=repr)
    got = sorted((tuple(map(_norm, r)) for r in df.select(*cols).collect()), key=repr)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, small, name):
    QUERIES[name](spark, small).collect()


def test_entry_without_text_package(monkeypatch):
    import sys

    import __spark_entry__ as e

    monkeypatch.setitem(sys.modules, "corpusloom.llm", None)
    monkeypatch.setitem(sys.modules, "corpusloom.llm.queries", None)
    assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(SQL)
