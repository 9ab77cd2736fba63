import os

import pytest

from lumbung import queries as core

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.exists(ROOT):
        pytest.skip("no test data")
    c = duckdb.connect()
    for f in os.listdir(ROOT):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{ROOT}/{f}'")
    return c


def plain(rows):
    out = []
    for r in rows:
        out.append(tuple(None if v is None or v != v else round(float(v), 5) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r))
    return sorted(out, key=str)


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = core.queries()[name](spark, ROOT)
    cols = sorted(df.columns)
    got = plain(df.select(*cols).collect())
    cur = duck.execute(core.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    want = plain([[r[names.index(c)] for c in cols] for r in cur.fetchall()])
    assert got == want


@pytest.mark.parametrize("name", sorted(set(core.queries()) - set(core.oracle_sql())))
def test_query_runs(spark, duck, name):
    rows = [tuple(map(str, r)) for r in core.queries()[name](spark, ROOT).collect()]
    assert rows and len(set(rows)) == len(rows)
