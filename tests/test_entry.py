"""The driver contract: every query runs on the smallest tables, whole, and has the columns of its SQL."""

import os

import pytest

DATA = os.environ.get("TAMIS_TESTDATA", "/root/testdata/sf0.001")


def test_contract():
    import __spark_entry__ as e

    q, s = e.queries(), e.oracle_sql()
    assert set(s) <= set(q) and all(callable(f) for f in q.values()) and len(q) > 60


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_against_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as e

    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{DATA}/{f}')")
    q = e.queries()
    for name, sql in e.oracle_sql().items():
        cur = con.execute(sql)
        cols = [c[0] for c in cur.description]
        df = q[name](spark, DATA)
        assert sorted(cols) == sorted(df.columns), name
        tidy = lambda v: round(float(v), 5) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
        want = sorted((tuple(tidy(v) for v in r) for r in cur.fetchall()), key=repr)
        assert sorted((tuple(tidy(v) for v in r) for r in df.select(*cols).collect()), key=repr) == want, name
