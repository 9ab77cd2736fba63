import math
from collections import Counter

from lumbung.llm.distinctive_terms import distinctive

ROWS = [(1, "Banjir banjir BANJIR di jalan"), (2, "banjir lagi di Kudus"), (3, "pasar di Kudus"), (4, None), (5, ""), (6, "123 !!"), (7, "kata " * 50_000 + "ujung"), (None, "banjir")]


def test_scores(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in ROWS], "key long, text string, tf int, term string")
    got = {(r.key, r.term): r for r in distinctive(df, "key", "text").collect()}
    docs = {i: Counter(t.lower().split()) for i, t in ROWS if i in (1, 2, 3, 7)}
    n, mean = len(docs), sum(c.total() for c in docs.values()) / len(docs)
    for i, c in docs.items():
        for t, tf in c.items():
            total = sum(d[t] for d in docs.values())
            tfn = tf * math.log2(1 + mean / c.total())
            rate = total / n
            want = (math.log2(1 + rate) + tfn * math.log2((1 + rate) / rate)) / (tfn + 1)
            r = got.pop((i, t))
            assert r.tf == tf and r.df == sum(t in d for d in docs.values()) and abs(r.score - want) < 1e-5
    assert not got


def test_filters_repeats_and_empty(spark):
    df = spark.createDataFrame(ROWS + ROWS[:1], "key long, text string")
    found = [tuple(r)[:4] for r in distinctive(df, "key", "text", least_tf=3, df_range=(2, 12)).collect()]
    assert found == [(1, "banjir", 3, 3)] * 2
    assert distinctive(df.where("false"), "key", "text").count() == 0
