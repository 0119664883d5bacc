"""Every query runs on the smallest test data, and gives what its SQL gives on another engine."""

import os

import pytest

from pagelode.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for f in sorted(os.listdir(DATA)):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from read_parquet('{DATA}/{f}')")
    return con


def plain(v):
    if v is None or v != v:
        return "∅"
    if hasattr(v, "__iter__") and not isinstance(v, str):
        return str([str(x) for x in v])
    return f"{float(v):.6g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, DATA)
    rows = df.collect()
    cols = sorted(df.columns)
    if name in catalogue.ORACLES:
        rel = duck.execute(catalogue.ORACLES[name])
        heads = [x[0] for x in rel.description]
        assert sorted(heads) == cols
        want = sorted(tuple(plain(r[heads.index(c)]) for c in cols) for r in rel.fetchall())
        assert sorted(tuple(plain(r[c]) for c in cols) for r in rows) == want
