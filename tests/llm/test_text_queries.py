import os

import pytest

from lumbung.llm import queries as text

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not os.path.exists(ROOT):
        pytest.skip("no test data")
    c = duckdb.connect()
    for f in os.listdir(ROOT):
        c.execute(f"create view {f.removesuffix('.parquet')} as select * from '{ROOT}/{f}{'/*.parquet' if os.path.isdir(f'{ROOT}/{f}') else ''}'")
    return c


def plain(rows):
    return sorted((tuple(None if v is None or v != v else round(float(v), 5) if isinstance(v, (int, float)) else str(v) for v in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(text.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    df = text.queries()[name](spark, ROOT)
    cols = sorted(df.columns)
    cur = duck.execute(text.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    assert plain(df.select(*cols).collect()) == plain([[r[names.index(c)] for c in cols] for r in cur.fetchall()])


@pytest.mark.parametrize("name", sorted(set(text.queries()) - set(text.oracle_sql())))
def test_query_gives_rows_without_repeats(spark, duck, name):
    rows = [tuple(map(str, r)) for r in text.queries()[name](spark, ROOT).collect()]
    assert rows and len(set(rows)) == len(rows)


def test_p7_found_weighs_its_terms(spark, duck):
    found = text.p7_found(spark, ROOT)
    staged = {f.rsplit("/", 1)[0] for f in found.inputFiles()}
    scored = {tuple(r) for f in staged for r in spark.read.parquet(f).select("record_kind", "record_key", "term", "score").collect()}
    every = {tuple(r) for r in text.p7_scores(spark, ROOT).select("record_kind", "record_key", "term", "score").collect()}
    assert scored and scored <= every
    assert {r[:3] for r in scored} == {tuple(r) for r in found.collect()}
